"""The build of the asset table, step by step: names, classes, flags, SI units, lineage columns, confidence, rollups and KPIs.

Every step is Column expressions over whatever else the frame carries; absent source columns give NULL columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.functions import text as names
from gantry.functions import units
from gantry.operators import relational as rel
from gantry.operators.durable import written

#: Names of volumes that exist for analysis only.
ANALYSIS_VOLUMES = ("Insulation Volume", "Obstruction Volume", "Fireproofing Volume", "Acoustic Volume")

#: The words that tell each class, in order of precedence, and the nouns that make "pipe ..." a structure.
CLASS_WORDS = {
    "Piping": ("pipe", "valve", "flange", "elbow", "tee", "reducer", "nozzle", "coupling"),
    "Equipment": ("equipment", "vessel", "pump", "tank", "compressor", "exchanger", "heater", "reactor"),
    "Structure": ("struct", "structural", "structure", "steel", "beam", "column", "brace", "foundation", "slab", "plate", "grating", "handrail", "ladder", "stair"),
    "Electrical": ("electrical", "cable", "conduit", "tray"),
    "HVAC": ("hvac", "duct", "ventilat"),
    "Instrumentation": ("instrument",),
}
NOT_PIPING = ("rack", "trench", "support", "way", "bridge", "shoe")

#: The reasons of a class's confidence.
REASONS = {
    "no piping": "xlsx_class_clean", "both": "piping_has_pipeline_and_metadata", "pipeline": "piping_pipeline_only", "metadata": "piping_metadata_only", "rack": "piping_no_metadata_pipe_rack_folder",
    "trench": "piping_no_metadata_pipe_trench_folder", "pipeline folder": "piping_no_metadata_pipeline_folder", "steel": "piping_no_metadata_steel_tee_substring", "nothing": "piping_no_metadata_unknown",
}

#: SI columns, the text each comes from, and its parser.
SI_COLUMNS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "dry_weight_kg": ("sp3d_dry_weight", units.weight_kg), "wet_weight_kg": ("sp3d_wet_weight", units.weight_kg), "length_m": ("sp3d_length", units.length_m), "width_m": ("sp3d_width", units.length_m),
    "depth_m": ("sp3d_depth", units.length_m), "height_m": ("sp3d_height", units.length_m), "bend_radius_m": ("sp3d_bend_radius", units.length_m),
    "design_pressure_kpa": ("sp3d_design_max_pressure", units.pressure_kpa), "design_temperature_c": ("sp3d_design_max_temperature", units.temperature_c),
    "npd_end1_m": ("sp3d_npd", lambda c: units.npd_m(c)["end1"]), "npd_end2_m": ("sp3d_npd", lambda c: units.npd_m(c)["end2"]),
}


def word_pattern(label: str) -> str:
    """Any of the class's words as a whole word; pipe only where no structural noun follows."""
    words = [w + (rf"(?!\s+({'|'.join(NOT_PIPING)}))" if w == "pipe" else "") for w in CLASS_WORDS[label]]
    return rf"(?i)\b({'|'.join(words)})\b"


def infer_class(properties: Column, path: Column, name: Column) -> Column:
    """The class of an object from its properties (an array of (key, value) in their order), path and name.

    First an explicit class among the properties, then what their keys tell, then words in path, name and keys. Keys
    that begin with __ do not count; Other if nothing tells.
    """
    own = F.filter(F.coalesce(properties, F.array().cast("array<struct<key:string,value:string>>")), lambda p: ~p["key"].startswith("__"))
    explicit = F.filter(
        F.transform(F.filter(own, lambda p: F.lower(names.after_bar(p["key"])).isin("classdisplayname", "class")), lambda p: names.clean_prefix(p["value"])),
        lambda v: v != "",
    )
    keys = F.transform(own, lambda p: F.lower(p["key"]))
    piping = F.exists(keys, lambda k: k.contains("pipeline") | k.contains("piperun") | k.contains("piping"))
    equipment = F.exists(keys, lambda k: k.contains("equipment") | k.contains("eqp type"))
    line = F.concat_ws(" ", F.coalesce(path, F.lit("")), F.coalesce(name, F.lit("")), keys)
    by_word = names.first_rule(line, [(word_pattern(c), c) for c in CLASS_WORDS], "Other")
    return F.when(F.size(explicit) > 0, F.try_element_at(explicit, F.lit(1))).when(piping, "Piping").when(equipment, "Equipment").otherwise(by_word)


def add_flags(df: DataFrame) -> DataFrame:
    """Six booleans from mesh_quality, adjacency_count, display_name, has_real_mesh and bbox_volume_m3.

    A parent box has no mesh and a box larger than 99 % of those with one (0 if there are none).
    """
    meshed, box = F.coalesce("has_real_mesh", F.lit(False)), F.coalesce("bbox_volume_m3", F.lit(0.0))
    bound = rel.exact_quantile(df.where(meshed).select(box.alias("box")), "box", 0.99) or 0.0
    quality = lambda q: F.coalesce(F.col("mesh_quality") == q, F.lit(False))
    made = df.withColumns(
        {
            "is_container": quality("skipped_container") & (F.coalesce("adjacency_count", F.lit(0)) == 0),
            "is_bbox_placeholder": quality("box_placeholder"),
            "is_analysis_volume": F.coalesce(F.col("display_name").rlike("(?i)" + "|".join(ANALYSIS_VOLUMES)), F.lit(False)),
            "has_own_geometry": meshed,
            "is_parent_box": ~meshed & (box > bound),
        }
    )
    return made.withColumn("graph_participant", ~(F.col("is_container") | F.col("is_bbox_placeholder") | F.col("is_analysis_volume") | F.col("is_parent_box")))


def add_si_units(df: DataFrame) -> DataFrame:
    """Eleven SI columns; text that does not parse, and a source that is absent, give NULL."""
    return df.withColumns({to: parse(F.col(source)) if source in df.columns else F.lit(None).cast("double") for to, (source, parse) in SI_COLUMNS.items()})


def add_lineage(df: DataFrame, rule: str, version: str, now: str) -> DataFrame:
    """The class as it came and as it is refined, the rule that did so, and the time of ingestion (given, in ISO seconds)."""
    return df.withColumns({"original_class": F.col("class_raw"), "refined_class": F.col("class_raw"), "refining_rule": F.lit(rule), "refining_rule_version": F.lit(version), "ingested_at_utc": F.lit(now)})


def add_confidence(df: DataFrame) -> DataFrame:
    """classification_confidence and its reason. Three levels and nine reasons, under the names that users know."""
    piping = F.coalesce(F.col("refined_class") == "Piping", F.lit(False))
    line = F.coalesce(F.col("sp3d_pipeline") != "", F.lit(False))
    meta = reduce(Column.__or__, [F.col(c).isNotNull() for c in ("sp3d_commodity_code", "sp3d_short_code", "sp3d_spec_name", "sp3d_npd")])
    path = F.coalesce("system_path", F.lit(""))
    level = F.when(~piping | (line & meta), "HIGH").when(line | meta, "LOW").otherwise("LIKELY_BUG")
    # of two folders in one path the trench tells
    folder = F.when(path.rlike(r"(?i)Pipe\s*Trench"), REASONS["trench"]).when(path.rlike(r"(?i)Pipe\s*Rack"), REASONS["rack"]).when(path.rlike("(?i)Pipeline"), REASONS["pipeline folder"]).when(path.rlike("(?i)steel"), REASONS["steel"]).otherwise(REASONS["nothing"])
    reason = F.when(~piping, REASONS["no piping"]).when(line & meta, REASONS["both"]).when(line, REASONS["pipeline"]).when(meta, REASONS["metadata"]).otherwise(folder)
    return df.withColumns({"classification_confidence": level, "classification_confidence_reason": reason})


def one_row_each(df: DataFrame, key: str, what: str) -> DataFrame:
    """df, if no key occurs twice; raises otherwise. The check is one aggregation of the key."""
    again = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(3).collect()
    if again:
        raise ValueError(f"{what}: {key} is not unique, e.g. {[r[key] for r in again]}")
    return df


def build(objects: DataFrame, sides: list[tuple[DataFrame, str]], rule: str, version: str, now: str, key: str = "object_id") -> DataFrame:
    """The asset table: objects left-joined with each (side, key of the side), then every step above.

    A side whose key occurs twice raises, and so do objects whose own key does: no join multiplies rows.
    """
    made = one_row_each(objects, key, "objects")
    for side, at in sides:
        made = made.join(one_row_each(side, at, "a side"), at, "left")
    made = add_lineage(add_si_units(add_flags(made)), rule, version, now)
    return add_confidence(made.withColumn("title", names.title_or_id(F.col("display_name"), F.col(key))))


def _named(word: str) -> Column:
    return F.count_if(F.coalesce(F.col("display_name").rlike(rf"(?i)\b{word}\b"), F.lit(False)))


def _rollup(now: str, words: tuple[str, ...]) -> dict[str, Column]:
    """Aggregates that pipelines and runs share."""
    weight = F.coalesce("dry_weight_kg", F.lit(0.0))
    out = {"component_count": F.count("*"), "total_dry_weight_kg": rel.positive_sum(weight), "mean_pressure_kpa": F.avg("design_pressure_kpa"), "max_pressure_kpa": F.max("design_pressure_kpa"), "mean_temperature_c": F.avg("design_temperature_c"), "max_temperature_c": F.max("design_temperature_c")}
    out |= {f"centroid_{a}": rel.weighted_mean(F.col(f"centroid_{a}"), weight) for a in "xyz"}
    out |= {f"bbox_{f.__name__}_{a}": f(f"bbox_{f.__name__}_{a}") for f in (F.min, F.max) for a in "xyz"}
    out |= {"bbox_volume_total_m3": F.coalesce(F.sum("bbox_volume_m3"), F.lit(0.0)), "mesh_coverage_pct": F.avg(F.coalesce("has_real_mesh", F.lit(False)).cast("int")) * 100}
    out |= {f"{w}_count": _named(w) for w in words}
    return out | {"fbx_supplemented_count": F.count_if(F.col("mesh_quality") == "fbx_supplemented"), "ingested_at_utc": F.lit(now)}


def pipelines(gold: DataFrame, now: str, order: str) -> DataFrame:
    """One row of 29 columns for each named pipeline; its first object by `order` represents it."""
    aggregates = _rollup(now, ("valve", "flange", "elbow", "tee", "reducer")) | {
        "pipe_run_count": F.count_distinct("sp3d_pipe_run"), "min_pressure_kpa": F.min("design_pressure_kpa"), "likely_bug_count": F.count_if(F.col("classification_confidence") == "LIKELY_BUG"),
        "representative_system_path": F.min_by(F.struct("system_path"), order)["system_path"],
    }
    return gold.where("sp3d_pipeline <> ''").groupBy(F.col("sp3d_pipeline").alias("pipeline_name")).agg(*[c.alias(n) for n, c in aggregates.items()])


def piperuns(gold: DataFrame, now: str) -> DataFrame:
    """One row of 26 columns for each named run of a named pipeline."""
    by = [F.col("sp3d_pipeline").alias("pipeline_name"), F.col("sp3d_pipe_run").alias("pipe_run_name")]
    made = gold.where("sp3d_pipeline <> '' AND sp3d_pipe_run <> ''").groupBy(*by).agg(*[c.alias(n) for n, c in _rollup(now, ("valve", "flange", "elbow", "tee")).items()])
    return made.withColumn("piperun_id", F.concat_ws("::", "pipeline_name", "pipe_run_name"))


def zone_kpis(gold: DataFrame, zones: DataFrame, kpis: DataFrame) -> DataFrame:
    """Seven figures for each zone over participants: zones (object_id, zone_id), kpis (object_id, corrosion_risk_index, maintenance_accessibility_index, equipment_criticality_score)."""
    inside = gold.where("graph_participant").select("object_id", "dry_weight_kg", "refined_class", "sp3d_pipeline").join(kpis, "object_id", "left").join(zones, "object_id", "left")
    inside = written(inside)  # rounds of histograms for the quantile, which are not to make the figures anew
    bound = rel.exact_quantile(inside, "equipment_criticality_score", 0.9)
    critical = F.count_if(F.col("equipment_criticality_score") > bound) if bound is not None else F.lit(0).cast("bigint")
    return inside.where("zone_id IS NOT NULL").groupBy("zone_id").agg(
        F.count("*").alias("zone_object_count"), F.coalesce(F.sum("dry_weight_kg"), F.lit(0.0)).alias("zone_total_weight_kg"), F.count_if(F.col("refined_class") == "Equipment").alias("zone_equipment_count"),
        F.avg("corrosion_risk_index").alias("zone_mean_corrosion_risk"), F.avg("maintenance_accessibility_index").alias("zone_mean_accessibility"),
        critical.alias("zone_critical_equipment_count"), F.count_distinct("sp3d_pipeline").alias("zone_shutdown_impact"),
    )


def pipeline_kpis(gold: DataFrame, zones: DataFrame, valves: DataFrame) -> DataFrame:
    """Eight figures for each pipeline: valves (object_id, isolation_section_size)."""
    cut_off = valves.groupBy("object_id").agg(F.count("*").alias("valves"), F.count("isolation_section_size").alias("sections"))
    inside = gold.where("sp3d_pipeline IS NOT NULL").join(zones, "object_id", "left").join(cut_off, "object_id", "left")
    pressure, temperature = F.coalesce(F.avg("design_pressure_kpa"), F.lit(0.0)), F.coalesce(F.avg("design_temperature_c"), F.lit(0.0))
    made = inside.groupBy("sp3d_pipeline").agg(
        F.count("*").alias("pipeline_object_count"), F.coalesce(F.sum("dry_weight_kg"), F.lit(0.0)).alias("pipeline_total_weight_kg"), F.avg("design_pressure_kpa").alias("pipeline_mean_pressure_kpa"),
        F.avg("design_temperature_c").alias("pipeline_mean_temperature_c"), F.count_distinct("zone_id").alias("pipeline_zone_span"), F.count("valves").alias("pipeline_valve_count"),
        F.coalesce(F.sum("sections"), F.lit(0)).alias("pipeline_isolation_sections"), (pressure * temperature).alias("raw"),
    )
    most = made.agg(F.max("raw")).scalar()
    return made.withColumn("pipeline_corrosion_risk", F.when(most > 0, F.col("raw") / most).otherwise(F.col("raw"))).drop("raw")


def plant_kpis(gold: DataFrame, by_zone: DataFrame, by_pipeline: DataFrame, chain: int) -> DataFrame:
    """Eight figures in one row."""
    plant = gold.agg(F.count("*").alias("total_objects"), F.count_if("graph_participant").alias("total_physical_objects"), (F.coalesce(F.sum(F.when(F.col("graph_participant"), F.col("dry_weight_kg"))), F.lit(0.0)) / 1000).alias("total_weight_tonnes"))
    zone = by_zone.agg(F.count("*").alias("max_parallel_zones"), F.coalesce(F.sum("zone_critical_equipment_count"), F.lit(0)).alias("high_criticality_equipment"), F.count_if(F.col("zone_mean_accessibility") < 0.2).alias("low_accessibility_zones"))
    pipe = by_pipeline.agg(F.count_if(F.col("pipeline_corrosion_risk") > 0.7).alias("high_corrosion_pipelines"))
    one = [df.withColumn("one", F.lit(1)) for df in (plant, zone, pipe)]  # a row each
    return one[0].join(F.broadcast(one[1]), "one").join(F.broadcast(one[2]), "one").drop("one").withColumn("critical_chain_length", F.lit(chain).cast("bigint"))
