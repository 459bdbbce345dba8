"""The declared sources there and back: objects written as the producers' CSV files, with headers in another order, and read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.operators.durable import new_folder
from gantry.plans.base import edges, query
from gantry.plans.gold import RAW, raw
from gantry.sources import silver

_RAW = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in RAW.items()) + " FROM part"


def _there_and_back(df: DataFrame, source: silver.Source) -> DataFrame:
    """df (columns by header) written as CSV, its columns reversed, and read as the source."""
    path = new_folder(df)
    df.select(*df.columns[::-1]).write.csv(path, header=True, escape='"')
    return silver.read(df.sparkSession, path, source)


def _numbers(*headers: str) -> list[Column]:
    """Coordinates by header, from the raw columns that bear their canonical names."""
    by = {h: n for h, n, _ in silver.GEOMETRY.columns}
    return [F.col(by[h]).alias(h) for h in headers]


_PLACES = ["MinX", "MinY", "MinZ", "MaxX", "MaxY", "MaxZ", "CentroidX", "CentroidY", "CentroidZ"]


@query("silver_geometry", f"""SELECT object_id, bbox_min_x, bbox_min_y, bbox_min_z, bbox_max_x, bbox_max_y, bbox_max_z, centroid_x, centroid_y, centroid_z, bbox_volume_m3, has_real_mesh AS has_mesh_geom, NULL::VARCHAR AS mesh_uri,
  mesh_quality AS mesh_quality_geom, CASE WHEN num % 3 = 0 THEN num END AS vertex_count_geom, NULL::BIGINT AS triangle_count_geom FROM ({_RAW})""")
def silver_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes with NaN for nothing, counts as decimals, a count that is no number, and the two columns that are left out."""
    r = raw(spark, sf_dir)
    volume = F.coalesce(F.col("bbox_volume_m3").cast("string"), F.lit("NaN")).alias("Volume")
    count = F.when(F.col("num") % 3 == 0, F.concat("num", F.lit(".0"))).alias("VertexCount")
    own = [F.col("object_id").alias("ObjectId"), F.col("display_name").alias("DisplayName"), F.lit("x").alias("Category"), F.col("has_real_mesh").alias("HasMesh"), F.col("mesh_quality").alias("MeshQuality"), F.lit("many").alias("TriangleCount")]
    return _there_and_back(r.select(*own, *_numbers(*_PLACES), volume, count), silver.GEOMETRY)


_HAS = {"object_id", "level_val", "mesh_quality", "adjacency_count", "group_id", "has_real_mesh", "verdict", "nav_class_display_name"}
_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@query("silver_validation", f"""SELECT object_id, level AS level_val, mesh_quality, adjacency_count, group_id, has_real_mesh, verdict, class_raw || ', "' || num || '"' AS nav_class_display_name, {', '.join(f'NULL::{_TYPES[t]} AS {n}' for _, n, t in silver.VALIDATION.columns if n not in _HAS)} FROM ({_RAW})""")
def silver_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most columns absent, one with commas and quotes, parents that are left out."""
    r = raw(spark, sf_dir)
    label = F.concat("class_raw", F.lit(', "'), "num", F.lit('"')).alias("ClassDisplayName")
    kept = {"ObjectId": "object_id", "Level": "level", "MeshQuality": "mesh_quality", "AdjacencyCount": "adjacency_count", "GroupId": "group_id", "HasRealMesh": "has_real_mesh", "Verdict": "verdict", "ParentId": "parent_id", "DisplayName": "display_name"}
    return _there_and_back(r.select(label, *[F.col(c).alias(h) for h, c in kept.items()]), silver.VALIDATION)


@query("silver_adjacency", """SELECT 'obj-' || src AS source_object_id, 'obj-' || dst AS target_object_id, NULL::VARCHAR AS source_name, NULL::VARCHAR AS target_name, times / 4 AS distance_m, overlap AS overlap_volume_m3, relation AS relation_type,
  NULL::VARCHAR AS source_category, NULL::VARCHAR AS target_category, 0.05::DOUBLE AS tolerance_m, (src + dst)::VARCHAR AS Checked FROM ({EDGES})""")
def silver_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges with a column that nobody declares, which stays as text."""
    e = edges(spark, sf_dir)
    own = {"SourceObjectId": F.concat(F.lit("obj-"), "src"), "TargetObjectId": F.concat(F.lit("obj-"), "dst"), "Distance": F.col("times") / 4, "OverlapVolume": F.col("overlap"), "RelationType": F.col("relation"), "Tolerance": F.lit(0.05), "Checked": F.col("src") + F.col("dst")}
    return _there_and_back(e.select(*[c.alias(h) for h, c in own.items()]), silver.ADJACENCY)


@query("silver_groups", f"""SELECT group_id, count(*) AS group_size, NULL::BIGINT AS group_edge_count, NULL::DOUBLE AS group_total_volume, min(class_raw) AS group_dominant_category, min(bbox_min_x) AS group_bbox_min_x, min(bbox_min_y) AS group_bbox_min_y, min(bbox_min_z) AS group_bbox_min_z,
  max(bbox_max_x) AS group_bbox_max_x, max(bbox_max_y) AS group_bbox_max_y, max(bbox_max_z) AS group_bbox_max_z, max(centroid_x) AS group_centroid_x, max(centroid_y) AS group_centroid_y, max(centroid_z) AS group_centroid_z FROM ({_RAW}) WHERE group_id IS NOT NULL GROUP BY group_id""")
def silver_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each group; the list of its members is left out."""
    r = raw(spark, sf_dir).where("group_id IS NOT NULL")
    ends = [f(f"bbox_{n}_{a}").alias(f"BBox{n.title()}{a.upper()}") for n, f in (("min", F.min), ("max", F.max)) for a in "xyz"]
    centres = [F.max(f"centroid_{a}").alias(f"Centroid{a.upper()}") for a in "xyz"]
    made = r.groupBy(F.col("group_id").alias("GroupId")).agg(F.count("*").alias("ElementCount"), F.min("class_raw").alias("DominantCategory"), F.concat(F.min("object_id"), F.lit(";"), F.max("object_id")).alias("MemberObjectIds"), *ends, *centres)
    return _there_and_back(made, silver.GROUPS)
