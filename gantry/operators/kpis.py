"""Figures of single objects that the zone, pipeline and plant KPIs rest on: criticality, accessibility, corrosion, isolation.

All are over the physical graph: the objects that take part in it (graph_participant) and the touching pairs between two of
them. Pairs are canonical (src < dst, each once) over the objects' column num.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.operators import graph
from gantry.operators import relational as rel
from gantry.operators.durable import written

#: How far corrosion goes by material, and the factor of all others.
MATERIAL_FACTORS, OTHER_FACTOR = {"Carbon Steel": 1.0, "Stainless Steel": 0.3}, 0.5
#: What the name of a device that closes off a section holds, in lower case.
ISOLATION_WORDS = ("valve", "blind flange", "blind", "spectacle")
#: Metres within which others stand in the way of maintenance.
RADIUS = 5.0


def between(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs both of whose ends are among nodes(num)."""
    one, other = nodes.select(F.col("num").alias("src")), nodes.select(F.col("num").alias("dst"))
    return pairs.select("src", "dst").join(one, "src", "left_semi").join(other, "dst", "left_semi").select("src", "dst")


def _by_greatest(raw: DataFrame, value: str, name: str) -> DataFrame:
    """With `name`: the value as a share of the greatest one, or the value itself where that is not above 0."""
    most = raw.agg(F.max(value)).scalar()
    return raw.withColumn(name, F.when(most > 0, F.col(value) / most).otherwise(F.col(value)))


def criticality(gold: DataFrame, pairs: DataFrame) -> DataFrame:
    """(num, equipment_criticality_score): touching objects times one more than the pipelines among them, as a share of the greatest."""
    nodes = gold.where("graph_participant").select("num", "sp3d_pipeline")
    one, other = (nodes.select(F.col("num").alias(c), F.col("sp3d_pipeline").alias(f"{c}_pipeline")) for c in ("src", "dst"))
    ends = [F.struct(F.col(a).alias("src"), F.col(f"{b}_pipeline").alias("pipeline")) for a, b in (("src", "dst"), ("dst", "src"))]
    both = pairs.select("src", "dst").join(one, "src").join(other, "dst").select(F.inline(F.array(*ends)))
    near = both.groupBy("src", "pipeline").agg(F.count("*").alias("n")).groupBy("src").agg(F.sum("n").alias("degree"), F.count("pipeline").alias("pipelines"))
    raw = nodes.join(near, F.col("num") == F.col("src"), "left").select("num", (F.coalesce("degree", F.lit(0)) * (1 + F.coalesce("pipelines", F.lit(0)))).cast("double").alias("raw"))
    return _by_greatest(written(raw), "raw", "equipment_criticality_score").drop("raw")  # the greatest needs all of it first


def accessibility(gold: DataFrame) -> DataFrame:
    """(num, maintenance_accessibility_index): 1 / (1 + others within RADIUS)."""
    nodes = gold.where("graph_participant").select("num", F.col("centroid_x").alias("x"), F.col("centroid_y").alias("y"), F.col("centroid_z").alias("z"))
    return rel.radius_counts(nodes, RADIUS, "num").select("num", (1.0 / (1.0 + F.col("near"))).alias("maintenance_accessibility_index"))


def corrosion(gold: DataFrame) -> DataFrame:
    """(num, corrosion_risk_index): pressure times temperature times the material's factor, none below 0, as a share of the greatest; 0 without both."""
    factor = F.lit(OTHER_FACTOR)
    for material, f in MATERIAL_FACTORS.items():
        factor = F.when(F.col("sp3d_material") == material, f).otherwise(factor)
    pressure, temperature = F.col("design_pressure_kpa"), F.col("design_temperature_c")
    score = F.when(pressure.isNotNull() & temperature.isNotNull(), F.greatest(pressure, F.lit(0.0)) * F.greatest(temperature, F.lit(0.0)) * factor)
    raw = gold.select("num", F.coalesce(score, F.lit(0.0)).alias("raw"))
    return _by_greatest(raw, "raw", "corrosion_risk_index").drop("raw")


def object_kpis(gold: DataFrame, pairs: DataFrame) -> DataFrame:
    """(object_id, corrosion_risk_index, maintenance_accessibility_index, equipment_criticality_score) of all objects; the last two are NULL outside the physical graph."""
    made = gold.select("object_id", "num").join(corrosion(gold), "num").join(accessibility(gold), "num", "left").join(criticality(gold, pairs), "num", "left")
    return made.drop("num")


def sections(devices: DataFrame, rest: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, section): how many of the rest (id) each device (id) closes off: sizes of the distinct parts, without devices, that it touches."""
    ends = lambda c: rest.select(F.col("id").alias(c))
    plain = pairs.select("src", "dst").join(ends("src"), "src", "left_semi").join(ends("dst"), "dst", "left_semi")
    of = written(graph.components(rest, plain))
    sizes = of.groupBy("component").agg(F.count("*").alias("n"))
    touch = rel.symmetric_closure(pairs.select("src", "dst"), "src", "dst").join(devices.select(F.col("id").alias("src")), "src").join(of.select(F.col("id").alias("dst"), "component"), "dst").select("src", "component").distinct()
    total = touch.join(sizes, "component").groupBy("src").agg(F.sum("n").alias("section"))
    return devices.select("id").join(total, F.col("id") == F.col("src"), "left").select("id", F.coalesce("section", F.lit(0)).alias("section"))


def valve_isolation(gold: DataFrame, pairs: DataFrame) -> DataFrame:
    """(object_id, is_isolation_valve, isolation_section_size) of each device among the piping of the physical graph."""
    name = F.lower(F.coalesce("display_name", F.lit("")))
    is_device = F.lit(False)
    for word in ISOLATION_WORDS:
        is_device = is_device | name.contains(word)
    piping = gold.where("graph_participant AND refined_class = 'Piping'").select("object_id", "num", F.col("num").alias("id"), is_device.alias("is_device"))
    found = sections(piping.where("is_device"), piping.where("NOT is_device"), written(between(pairs, piping)))
    return piping.join(found, "id").select("object_id", F.lit(True).alias("is_isolation_valve"), F.col("section").alias("isolation_section_size"))
