"""The declared sources of the asset model: CSV files read by their headers, under canonical names and types.

Columns are found by name, whatever their order; text that does not fit its type is NULL, as NaN is. A declared column that
the file lacks is a NULL column of its type; columns that nobody declares stay under their own names, as text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Source:
    """Header, canonical name and type of each column, and headers that are left out."""

    columns: tuple[tuple[str, str, str], ...]
    dropped: tuple[str, ...] = ()


#: Headers, canonical names and what is left out.
GEOMETRY = Source(
    (
        ("ObjectId", "object_id", "string"), ("MinX", "bbox_min_x", "double"), ("MinY", "bbox_min_y", "double"), ("MinZ", "bbox_min_z", "double"), ("MaxX", "bbox_max_x", "double"), ("MaxY", "bbox_max_y", "double"),
        ("MaxZ", "bbox_max_z", "double"), ("CentroidX", "centroid_x", "double"), ("CentroidY", "centroid_y", "double"), ("CentroidZ", "centroid_z", "double"), ("Volume", "bbox_volume_m3", "double"),
        ("HasMesh", "has_mesh_geom", "boolean"), ("MeshUri", "mesh_uri", "string"), ("MeshQuality", "mesh_quality_geom", "string"), ("VertexCount", "vertex_count_geom", "bigint"), ("TriangleCount", "triangle_count_geom", "bigint"),
    ),
    ("DisplayName", "Category"),
)
VALIDATION = Source(
    (
        ("ObjectId", "object_id", "string"), ("ClassDisplayName", "nav_class_display_name", "string"), ("Level", "level_val", "bigint"), ("IsLeaf", "is_leaf", "boolean"), ("ChildCount", "child_count", "bigint"),
        ("HasGeometry", "has_geometry", "boolean"), ("IsHidden", "is_hidden", "boolean"), ("HasGeometryProperty", "has_geometry_property", "boolean"), ("GeoP_Primitives", "geop_primitives", "bigint"),
        ("GeoP_HasTriangles", "geop_has_triangles", "boolean"), ("GeoP_HasLines", "geop_has_lines", "boolean"), ("GeoP_Solid", "geop_solid", "boolean"), ("GeoP_HasText", "geop_has_text", "boolean"),
        ("GeoP_HasSnapPoints", "geop_has_snap_points", "boolean"), ("GeoP_HasPoints", "geop_has_points", "boolean"), ("GeoP_Fragments", "geop_fragments", "bigint"), ("HasBBox", "has_bbox", "boolean"),
        ("BBoxVolume", "bbox_volume_val", "double"), ("ContainerStatus", "container_status", "string"), ("TessResult", "tess_result", "string"), ("TessFailureReason", "tess_failure_reason", "string"),
        ("MeshQuality", "mesh_quality", "string"), ("VertexCount", "vertex_count", "bigint"), ("TriangleCount", "triangle_count", "bigint"), ("AdjacencyCount", "adjacency_count", "bigint"), ("GroupId", "group_id", "string"),
        ("GlbExists", "glb_exists", "boolean"), ("GlbSizeBytes", "glb_size_bytes", "bigint"), ("HasMesh", "has_mesh", "boolean"), ("HasRealMesh", "has_real_mesh", "boolean"), ("Verdict", "verdict", "string"),
    ),
    ("DisplayName", "ParentId"),
)
ADJACENCY = Source(
    (
        ("SourceObjectId", "source_object_id", "string"), ("TargetObjectId", "target_object_id", "string"), ("SourceName", "source_name", "string"), ("TargetName", "target_name", "string"), ("Distance", "distance_m", "double"),
        ("OverlapVolume", "overlap_volume_m3", "double"), ("RelationType", "relation_type", "string"), ("SourceCategory", "source_category", "string"), ("TargetCategory", "target_category", "string"), ("Tolerance", "tolerance_m", "double"),
    ),
)
GROUPS = Source(
    (
        ("GroupId", "group_id", "string"), ("ElementCount", "group_size", "bigint"), ("EdgeCount", "group_edge_count", "bigint"), ("TotalVolume", "group_total_volume", "double"), ("DominantCategory", "group_dominant_category", "string"),
        ("BBoxMinX", "group_bbox_min_x", "double"), ("BBoxMinY", "group_bbox_min_y", "double"), ("BBoxMinZ", "group_bbox_min_z", "double"), ("BBoxMaxX", "group_bbox_max_x", "double"), ("BBoxMaxY", "group_bbox_max_y", "double"),
        ("BBoxMaxZ", "group_bbox_max_z", "double"), ("CentroidX", "group_centroid_x", "double"), ("CentroidY", "group_centroid_y", "double"), ("CentroidZ", "group_centroid_z", "double"),
    ),
    ("MemberObjectIds",),
)


def read(spark: SparkSession, path: str, source: Source, multi_line: bool = False) -> DataFrame:
    """A CSV of the source; with multi_line quoted line breaks are allowed, and a file is one task's."""
    df = spark.read.csv(path, header=True, multiLine=multi_line, escape='"')
    names = {header for header, *_ in source.columns}
    made = []
    for header, name, kind in source.columns:
        c = df[f"`{header}`"] if header in df.columns else F.lit(None).cast("string")
        # whole numbers are written as decimals where a column has gaps
        value = c.try_cast("double").try_cast("bigint") if kind == "bigint" else c.try_cast(kind)
        made.append((F.when(~F.isnan(value), value) if kind == "double" else value).alias(name))
    rest = [df[f"`{c}`"] for c in df.columns if c not in names and c not in source.dropped]
    return df.select(*made, *rest)


def with_levels(objects: DataFrame, level: str = "level") -> DataFrame:
    """Objects with their level as a whole number; text that is none has no level."""
    return objects.withColumn(level, F.col(level).cast("string").try_cast("double").try_cast("bigint"))


def silver(geometry: DataFrame, validation: DataFrame, groups: DataFrame, hierarchy: DataFrame, objects: DataFrame) -> tuple[DataFrame, list[tuple[DataFrame, str]]]:
    """(objects, sides) for the build of the asset table: each side with the key that must be unique in it.

    The hierarchy is the one source of parents and levels. Groups are joined to the sides that name one, so a group is
    one row however many objects it has.
    """
    of = validation.select("object_id", "group_id").where("group_id IS NOT NULL").join(groups, "group_id", "left").drop("group_id")
    own = with_levels(objects).drop("parent_id")
    return own.drop("level"), [(hierarchy, "object_id"), (validation, "object_id"), (geometry, "object_id"), (of, "object_id")]
