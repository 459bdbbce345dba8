"""The asset table built from raw columns, its rollups, KPIs, dimensions and exports; the parts play the raw objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.functions import text as names
from gantry.operators import gold, kpis, ontology
from gantry.operators import relational as rel
from gantry.operators.durable import written
from gantry.plans import graphs
from gantry.plans.base import edges, query, table

#: Columns of the raw objects over part, in SQL that both engines read alike.
RAW = {
    "num": "p_partkey",
    "object_id": "concat('obj-', CAST(p_partkey AS STRING))",
    "parent_id": "CASE p_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'obj-none' ELSE concat('obj-', CAST(p_partkey - p_partkey % 10 + 10 AS STRING)) END",
    "display_name": """CASE p_partkey % 11 WHEN 0 THEN concat('Gate Valve ', CAST(p_partkey AS STRING)) WHEN 1 THEN 'FLANGE' WHEN 2 THEN 'elbow 90' WHEN 3 THEN 'Tee-branch' WHEN 4 THEN 'reducers' WHEN 5 THEN 'Valves'
        WHEN 6 THEN 'pipe insulation volume' WHEN 7 THEN NULL WHEN 8 THEN '  ' WHEN 9 THEN 'Fireproofing Volume B' ELSE p_name END""",
    "class_raw": "CASE p_partkey % 7 WHEN 0 THEN 'Piping' WHEN 1 THEN 'Piping' WHEN 2 THEN 'Structure' WHEN 3 THEN 'Equipment' WHEN 4 THEN 'Electrical' WHEN 5 THEN 'Piping' ELSE 'Other' END",
    "system_path": "CASE p_size % 7 WHEN 0 THEN 'TRAINING > A1 > Pipe Rack 3' WHEN 1 THEN 'TRAINING > A1 > pipetrench' WHEN 2 THEN 'A2 > Pipelines' WHEN 3 THEN 'A2 > Steel Work' WHEN 4 THEN 'Pipe  Rack > Pipe Trench' WHEN 5 THEN NULL ELSE 'A3 > Misc' END",
    "sp3d_pipeline": "CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('P-', p_brand) END",
    "sp3d_pipe_run": "CASE p_partkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('R', CAST(p_size % 4 AS STRING)) END",
    "sp3d_commodity_code": "CASE WHEN p_partkey % 12 = 0 THEN 'CC' END",
    "sp3d_short_code": "CASE WHEN p_partkey % 8 = 1 THEN '' END",
    "sp3d_spec_name": "CASE p_partkey % 6 WHEN 2 THEN '' WHEN 3 THEN '1C 0031' END",
    "sp3d_npd": "CASE p_size % 9 WHEN 0 THEN concat(CAST(p_size AS STRING), 'in x 6in') WHEN 1 THEN concat(CAST(p_size AS STRING), 'mm x 0') WHEN 2 THEN 'n/a' END",
    "sp3d_material": "CASE p_size % 3 WHEN 0 THEN 'ASTM-A105' WHEN 1 THEN ' ' END",
    "sp3d_dry_weight": "CASE p_size % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat(CAST(p_size AS STRING), '.5 lbm') END",
    "sp3d_wet_weight": "concat(CAST(p_size AS STRING), ' kg')",
    "sp3d_length": "concat(CAST(p_size AS STRING), ' ft  4.00 in')",
    "sp3d_width": "concat(CAST(p_size AS STRING), ' mm')",
    "sp3d_depth": "concat(CAST(p_size AS STRING), ' 1/2 in')",
    "sp3d_height": "CASE WHEN p_size % 2 = 0 THEN 'garbage' END",
    "sp3d_design_max_pressure": "CASE WHEN p_size % 8 <> 0 THEN concat(CAST(p_size AS STRING), '.00 psi') END",
    "sp3d_design_max_temperature": "CASE WHEN p_size % 5 <> 0 THEN concat(CAST(p_size * 10 AS STRING), ' F') ELSE '20 f' END",
    "mesh_quality": "CASE p_partkey % 13 WHEN 0 THEN 'box_placeholder' WHEN 1 THEN 'skipped_container' WHEN 2 THEN 'skipped_container' WHEN 3 THEN 'fbx_supplemented' WHEN 4 THEN NULL WHEN 5 THEN 'line_mesh' ELSE 'full_mesh' END",
    "verdict": "CASE p_partkey % 13 WHEN 0 THEN 'SKIP_NO_GEOMETRY' WHEN 1 THEN 'SKIP_CONTAINER' WHEN 2 THEN 'SKIP_CONTAINER' WHEN 3 THEN 'OK_FBX' WHEN 4 THEN NULL WHEN 5 THEN 'OK_LINE_MESH' ELSE 'OK_MESH' END",
    "adjacency_count": "CAST(CASE p_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN p_size END AS BIGINT)",
    "has_real_mesh": "CASE p_partkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN FALSE END",
    "bbox_volume_m3": "CASE WHEN p_partkey % 23 <> 0 THEN p_retailprice * CAST(p_partkey % 50 AS DOUBLE) END",
    "level": "CAST(p_size % 10 AS BIGINT)",
    "group_id": "CASE WHEN p_partkey % 6 <> 0 THEN concat('g', CAST(p_partkey % 37 AS STRING)) END",
    "centroid_x": "CAST(p_partkey % 40 AS DOUBLE)", "centroid_y": "CAST(p_partkey % 70 AS DOUBLE)", "centroid_z": "CAST(p_size AS DOUBLE) / 2",
    "bbox_min_x": "CAST(p_partkey % 40 - 1 AS DOUBLE)", "bbox_min_y": "CAST(p_partkey % 70 - 2 AS DOUBLE)", "bbox_min_z": "CAST(p_size - 3 AS DOUBLE)",
    "bbox_max_x": "CAST(p_partkey % 40 + 1 AS DOUBLE)", "bbox_max_y": "CAST(p_partkey % 70 + 2 AS DOUBLE)", "bbox_max_z": "CAST(p_size + 3 AS DOUBLE)",
}
RULE, VERSION, NOW = "by_header", "1", "2026-01-01T00:00:00+00:00"
_RAW = "SELECT p_size AS s, " + ", ".join(f"{v} AS {k}" for k, v in RAW.items()) + " FROM part"

# the twin, from the rules of each step
_GOLD = f"""SELECT r.*, coalesce(mesh_quality = 'skipped_container', false) AND coalesce(adjacency_count, 0) = 0 AS is_container, coalesce(mesh_quality = 'box_placeholder', false) AS is_bbox_placeholder,
  coalesce(display_name ILIKE '%insulation volume%' OR display_name ILIKE '%obstruction volume%' OR display_name ILIKE '%fireproofing volume%' OR display_name ILIKE '%acoustic volume%', false) AS is_analysis_volume,
  coalesce(has_real_mesh, false) AS has_own_geometry, NOT coalesce(has_real_mesh, false) AND coalesce(bbox_volume_m3, 0) > p99 AS is_parent_box,
  NOT (coalesce(mesh_quality IN ('box_placeholder'), false) OR is_container OR is_analysis_volume OR is_parent_box) AS graph_participant,
  CASE WHEN s % 6 > 1 THEN (s + 0.5::DOUBLE) * 0.45359237::DOUBLE END AS dry_weight_kg, NULL::DOUBLE AS wet_weight_kg, s * 0.3048::DOUBLE + 4 * 0.0254::DOUBLE AS length_m, s / 1000 AS width_m,
  (s + 0.5::DOUBLE) * 0.0254::DOUBLE AS depth_m, NULL::DOUBLE AS height_m, NULL::DOUBLE AS bend_radius_m, CASE WHEN s % 8 <> 0 THEN s * 6.894757::DOUBLE END AS design_pressure_kpa,
  CASE WHEN s % 5 <> 0 THEN (s * 10.0::DOUBLE - 32) * 5 / 9 END AS design_temperature_c, CASE s % 9 WHEN 0 THEN s * 0.0254::DOUBLE WHEN 1 THEN s * 0.001::DOUBLE END AS npd_end1_m,
  CASE s % 9 WHEN 0 THEN 6 * 0.0254::DOUBLE WHEN 1 THEN 0.0::DOUBLE END AS npd_end2_m,
  class_raw AS original_class, class_raw AS refined_class, '{RULE}' AS refining_rule, '{VERSION}' AS refining_rule_version, '{NOW}' AS ingested_at_utc,
  CASE WHEN trim(coalesce(display_name, '')) = '' THEN object_id ELSE trim(display_name) END AS title,
  coalesce(sp3d_pipeline, '') <> '' AS q_line, coalesce(sp3d_commodity_code, sp3d_short_code, sp3d_spec_name, sp3d_npd) IS NOT NULL AS q_meta,
  CASE WHEN class_raw <> 'Piping' OR (q_line AND q_meta) THEN 'HIGH' WHEN q_line OR q_meta THEN 'LOW' ELSE 'LIKELY_BUG' END AS classification_confidence,
  CASE WHEN class_raw <> 'Piping' THEN 'xlsx_class_clean' WHEN q_line AND q_meta THEN 'piping_has_pipeline_and_metadata' WHEN q_line THEN 'piping_pipeline_only' WHEN q_meta THEN 'piping_metadata_only'
    WHEN s % 7 IN (1, 4) THEN 'piping_no_metadata_pipe_trench_folder' WHEN s % 7 = 0 THEN 'piping_no_metadata_pipe_rack_folder' WHEN s % 7 = 2 THEN 'piping_no_metadata_pipeline_folder'
    WHEN s % 7 = 3 THEN 'piping_no_metadata_steel_tee_substring' ELSE 'piping_no_metadata_unknown' END AS classification_confidence_reason
FROM ({_RAW}) r, (SELECT coalesce(quantile_cont(coalesce(bbox_volume_m3, 0), 0.99), 0) AS p99 FROM ({_RAW}) WHERE has_real_mesh) t"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*[f"{v} AS {k}" for k, v in RAW.items()])


def built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The asset table, its places joined from a side of their own."""
    r = raw(spark, sf_dir)
    places = [c for c in r.columns if c.startswith(("centroid", "bbox_m"))]
    return gold.build(r.drop(*places), [(r.select("object_id", *places), "object_id")], RULE, VERSION, NOW)


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places. Ties in decimal come out of binary sums either way, so a nudge settles them, in the twins too."""
    return df.select(*[F.round(F.col(c) + 1e-9, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


FLAGS = ["is_container", "is_bbox_placeholder", "is_analysis_volume", "has_own_geometry", "is_parent_box", "graph_participant"]


@query("gold_flags", f"SELECT object_id, {', '.join(FLAGS)} FROM ({_GOLD})")
def gold_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir).select("object_id", *FLAGS)


@query("gold_si_units", f"SELECT object_id, {', '.join(f'round({c} + 1e-9, 6) AS {c}' for c in gold.SI_COLUMNS)} FROM ({_GOLD})")
def gold_si_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(built(spark, sf_dir).select("object_id", *gold.SI_COLUMNS))


@query("gold_lineage", f"SELECT object_id, original_class, refined_class, refining_rule, refining_rule_version, ingested_at_utc, title FROM ({_GOLD})")
def gold_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir).select("object_id", "original_class", "refined_class", "refining_rule", "refining_rule_version", "ingested_at_utc", "title")


@query("gold_confidence", f"SELECT object_id, classification_confidence, classification_confidence_reason FROM ({_GOLD})")
def gold_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir).select("object_id", "classification_confidence", "classification_confidence_reason")


_HEADER = "CASE p_size % 6 WHEN 0 THEN concat('SmartPlant 3D|', p_type) WHEN 1 THEN concat('Nav Item|', p_name) WHEN 2 THEN 'ObjectId(GUID)' WHEN 3 THEN concat('PipeRun', CAST(p_size AS STRING)) WHEN 4 THEN 'DryCGX' ELSE concat('Eqp_ ', p_name) END"
_LOW = r"trim(regexp_replace(lower({}), '[^a-z0-9]+', '_', 'g'), '_')"


@query("header_names", f"""SELECT p_partkey AS id, CASE p_size % 6 WHEN 0 THEN 'sp3d_' || {_LOW.format('p_type')} WHEN 1 THEN 'nav_item_' || {_LOW.format('p_name')} WHEN 2 THEN 'object_id'
WHEN 3 THEN 'pipe_run' || p_size WHEN 4 THEN 'dry_cgx' ELSE 'eqp_' || {_LOW.format('p_name')} END AS name FROM part""")
def header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), names.header_column(F.expr(_HEADER)).alias("name"))


def _told(label: str) -> str:
    """DuckDB's view of a class's words; what is no pipe is taken out of the line before."""
    return rf"regexp_matches(line, '\b({'|'.join(gold.CLASS_WORDS[label])})\b') THEN '{label}'"


@query("infer_class", rf"""SELECT object_id, CASE WHEN num % 12 = 0 THEN 'Skid' WHEN num % 12 = 1 THEN 'Piping' WHEN num % 12 = 2 THEN 'Equipment' {' '.join(f'WHEN {_told(c)}' for c in gold.CLASS_WORDS)} ELSE 'Other' END AS class
FROM (SELECT object_id, num, regexp_replace(lower(coalesce(system_path, '') || ' ' || coalesce(display_name, '') || ' ' || CASE num % 12 WHEN 3 THEN 'an instrument' WHEN 4 THEN 'air duct' WHEN 5 THEN 'a tray' WHEN 6 THEN '' ELSE 'item|__class item|name' END),
  '\bpipe\s+({'|'.join(gold.NOT_PIPING)})', '', 'g') AS line FROM ({{_RAW_}}))""".replace("{_RAW_}", _RAW))
def infer_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [("Item|__class", "no"), ("Item|Name", "x")]
    case = {0: [("__x", "y"), ("Item|Class", "DisplayString: "), ("Item|ClassDisplayName", "DISPLAYSTRING: Skid")], 1: [("SmartPlant 3D|Piping Spec", "a"), ("Eqp Type 0", "b")], 2: [("A|Eqp Type 0", "b")], 3: [("An Instrument", "")], 4: [("air duct", "")], 5: [("a tray", "")]}

    def made(pairs: list[tuple[str, str]]):
        return F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in pairs])

    k = F.col("num") % 12
    properties = F.when(k == 6, F.lit(None))
    for n, pairs in case.items():
        properties = properties.when(k == n, made(pairs))
    r = raw(spark, sf_dir)
    return r.select("object_id", gold.infer_class(properties.otherwise(made(keys)), F.col("system_path"), F.col("display_name")).alias("class"))


def _wmean(c: str) -> str:
    return f"round(CASE WHEN sum(coalesce(dry_weight_kg, 0)) > 0 THEN sum({c} * coalesce(dry_weight_kg, 0)) / sum(coalesce(dry_weight_kg, 0)) ELSE avg({c}) END + 1e-9, 6) AS {c}"


_AGG = f"""count(*) AS component_count, round(CASE WHEN sum(dry_weight_kg) > 0 THEN sum(dry_weight_kg) END + 1e-9, 6) AS total_dry_weight_kg, round(avg(design_pressure_kpa) + 1e-9, 6) AS mean_pressure_kpa,
  round(max(design_pressure_kpa) + 1e-9, 6) AS max_pressure_kpa, round(avg(design_temperature_c) + 1e-9, 6) AS mean_temperature_c, round(max(design_temperature_c) + 1e-9, 6) AS max_temperature_c, {_wmean('centroid_x')}, {_wmean('centroid_y')}, {_wmean('centroid_z')},
  min(bbox_min_x) AS bbox_min_x, min(bbox_min_y) AS bbox_min_y, min(bbox_min_z) AS bbox_min_z, max(bbox_max_x) AS bbox_max_x, max(bbox_max_y) AS bbox_max_y, max(bbox_max_z) AS bbox_max_z,
  round(coalesce(sum(bbox_volume_m3), 0), 4) AS bbox_volume_total_m3, round(100 * avg(CASE WHEN has_real_mesh THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) + 1e-9, 6) AS mesh_coverage_pct,
  count(*) FILTER (num % 11 = 0) AS valve_count, count(*) FILTER (num % 11 = 1) AS flange_count, count(*) FILTER (num % 11 = 2) AS elbow_count, count(*) FILTER (num % 11 = 3) AS tee_count,
  count(*) FILTER (mesh_quality = 'fbx_supplemented') AS fbx_supplemented_count, '{NOW}' AS ingested_at_utc"""


@query("pipelines_full", f"""SELECT sp3d_pipeline AS pipeline_name, count(DISTINCT sp3d_pipe_run) AS pipe_run_count, round(min(design_pressure_kpa) + 1e-9, 6) AS min_pressure_kpa, 0::BIGINT AS reducer_count,
  count(*) FILTER (classification_confidence = 'LIKELY_BUG') AS likely_bug_count, first(system_path ORDER BY num) AS representative_system_path, {_AGG} FROM ({_GOLD}) WHERE sp3d_pipeline <> '' GROUP BY sp3d_pipeline""")
def pipelines_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = gold.pipelines(built(spark, sf_dir), NOW, "num")
    return _rounded(made).withColumn("bbox_volume_total_m3", F.round("bbox_volume_total_m3", 4))


@query("piperuns_full", f"""SELECT sp3d_pipeline || '::' || sp3d_pipe_run AS piperun_id, sp3d_pipeline AS pipeline_name, sp3d_pipe_run AS pipe_run_name, {_AGG}
FROM ({_GOLD}) WHERE sp3d_pipeline <> '' AND sp3d_pipe_run <> '' GROUP BY sp3d_pipeline, sp3d_pipe_run""")
def piperuns_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(gold.piperuns(built(spark, sf_dir), NOW)).withColumn("bbox_volume_total_m3", F.round("bbox_volume_total_m3", 4))


# the figures that the KPIs rest on, over the participants and the touching pairs between them
_ZONES = "SELECT object_id, floor(centroid_x / 15) * 100 + floor(centroid_y / 15) AS zone_id"
_P = f"(SELECT * FROM ({_GOLD}) WHERE graph_participant)"
_E = f"(SELECT e.src, e.dst FROM ({{EDGES}}) e JOIN {_P} a ON a.num = e.src JOIN {_P} b ON b.num = e.dst)"
_CRITICAL = f"""(SELECT num, CASE WHEN max(raw) OVER () > 0 THEN raw / max(raw) OVER () ELSE raw END AS equipment_criticality_score FROM (
SELECT p.num, (count(n.num) * (1 + count(DISTINCT n.sp3d_pipeline)))::DOUBLE AS raw FROM {_P} p LEFT JOIN (SELECT src, dst FROM {_E} UNION ALL SELECT dst, src FROM {_E}) e ON e.src = p.num LEFT JOIN {_P} n ON n.num = e.dst GROUP BY p.num))"""
_ACCESS = f"""(SELECT p.num, 1 / (1.0::DOUBLE + count(o.num)) AS maintenance_accessibility_index FROM {_P} p LEFT JOIN {_P} o
ON o.num <> p.num AND sqrt((o.centroid_x - p.centroid_x) ** 2 + (o.centroid_y - p.centroid_y) ** 2 + (o.centroid_z - p.centroid_z) ** 2) <= 5 GROUP BY p.num)"""
_CORROSION = f"""(SELECT num, CASE WHEN max(raw) OVER () > 0 THEN raw / max(raw) OVER () ELSE raw END AS corrosion_risk_index FROM (SELECT num, coalesce(greatest(design_pressure_kpa, 0) * greatest(design_temperature_c, 0) *
  CASE sp3d_material WHEN 'Carbon Steel' THEN 1.0 WHEN 'Stainless Steel' THEN 0.3 ELSE 0.5 END, 0)::DOUBLE AS raw FROM (SELECT num, sp3d_material, CASE WHEN design_temperature_c IS NOT NULL THEN design_pressure_kpa END AS design_pressure_kpa, CASE WHEN design_pressure_kpa IS NOT NULL THEN design_temperature_c END AS design_temperature_c FROM ({_GOLD}))))"""
_KPIS = f"(SELECT g.object_id, c.corrosion_risk_index, a.maintenance_accessibility_index, k.equipment_criticality_score FROM ({_GOLD}) g JOIN {_CORROSION} c USING (num) LEFT JOIN {_ACCESS} a USING (num) LEFT JOIN {_CRITICAL} k USING (num))"
_VALVES = f"""(WITH RECURSIVE p AS MATERIALIZED (SELECT num, object_id, coalesce(lower(display_name) LIKE '%valve%' OR lower(display_name) LIKE '%blind%' OR lower(display_name) LIKE '%spectacle%', false) AS device FROM {_P} WHERE refined_class = 'Piping'),
  b AS MATERIALIZED (SELECT e.src, e.dst, y.device AS to_device FROM (SELECT src, dst FROM {_E} UNION ALL SELECT dst, src FROM {_E}) e JOIN p x ON x.num = e.src JOIN p y ON y.num = e.dst),
  w(device, num) AS (SELECT p.num, b.dst FROM p JOIN b ON b.src = p.num WHERE p.device AND NOT b.to_device UNION SELECT w.device, b.dst FROM w JOIN b ON b.src = w.num WHERE NOT b.to_device)
  SELECT p.object_id, true AS is_isolation_valve, count(w.num) AS isolation_section_size FROM p LEFT JOIN w ON w.device = p.num WHERE p.device GROUP BY p.object_id)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges(spark, sf_dir).select("src", "dst")


@query("object_kpis", f"SELECT object_id, round(corrosion_risk_index + 1e-9, 6) AS corrosion_risk_index, round(maintenance_accessibility_index + 1e-9, 6) AS maintenance_accessibility_index, round(equipment_criticality_score + 1e-9, 6) AS equipment_criticality_score FROM {_KPIS}")
def object_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(kpis.object_kpis(built(spark, sf_dir), _pairs(spark, sf_dir)))


@query("valve_isolation", f"SELECT * FROM {_VALVES}")
def valve_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.valve_isolation(built(spark, sf_dir), _pairs(spark, sf_dir))


def _zones(g: DataFrame) -> DataFrame:
    return g.selectExpr(*_ZONES.removeprefix("SELECT ").split(", "))


_ZONE_KPIS = f"""SELECT zone_id, count(*) AS zone_object_count, coalesce(sum(dry_weight_kg), 0) AS zone_total_weight_kg, count(*) FILTER (refined_class = 'Equipment') AS zone_equipment_count, avg(corrosion_risk_index) AS zone_mean_corrosion_risk,
  avg(maintenance_accessibility_index) AS zone_mean_accessibility, count(*) FILTER (equipment_criticality_score > p) AS zone_critical_equipment_count, count(DISTINCT sp3d_pipeline) AS zone_shutdown_impact
FROM (SELECT * FROM {_P} JOIN ({_ZONES} FROM ({_GOLD})) USING (object_id) JOIN {_KPIS} USING (object_id)), (SELECT quantile_cont(equipment_criticality_score, 0.9) AS p FROM {_CRITICAL}) GROUP BY zone_id"""
_PIPE_KPIS = f"""SELECT * EXCLUDE raw, CASE WHEN max(raw) OVER () > 0 THEN raw / max(raw) OVER () ELSE raw END AS pipeline_corrosion_risk FROM (
SELECT sp3d_pipeline, count(*) AS pipeline_object_count, coalesce(sum(dry_weight_kg), 0) AS pipeline_total_weight_kg, avg(design_pressure_kpa) AS pipeline_mean_pressure_kpa, avg(design_temperature_c) AS pipeline_mean_temperature_c,
  count(DISTINCT floor(centroid_x / 15) * 100 + floor(centroid_y / 15)) AS pipeline_zone_span, count(v.object_id) AS pipeline_valve_count, count(v.isolation_section_size) AS pipeline_isolation_sections,
  coalesce(avg(design_pressure_kpa), 0) * coalesce(avg(design_temperature_c), 0) AS raw FROM ({_GOLD}) LEFT JOIN {_VALVES} v USING (object_id) WHERE sp3d_pipeline IS NOT NULL GROUP BY sp3d_pipeline)"""


def _six(sql: str, doubles: list[str]) -> str:
    """The twin with these columns to six places."""
    return f"SELECT * REPLACE ({', '.join(f'round({c} + 1e-9, 6) AS {c}' for c in doubles)}) FROM ({sql})"


@query("zone_kpis_full", _six(_ZONE_KPIS, ["zone_total_weight_kg", "zone_mean_corrosion_risk", "zone_mean_accessibility"]).replace("round(zone_mean_accessibility + 1e-9, 6)", "round(zone_mean_accessibility::DOUBLE + 1e-9, 6)").replace("zone_id, count", "zone_id::BIGINT AS zone_id, count", 1))
def zone_kpis_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = written(built(spark, sf_dir))
    return _rounded(gold.zone_kpis(g, _zones(g), kpis.object_kpis(g, _pairs(spark, sf_dir))))


_PIPE_DOUBLES = ["pipeline_total_weight_kg", "pipeline_mean_pressure_kpa", "pipeline_mean_temperature_c", "pipeline_corrosion_risk"]


@query("pipeline_kpis_full", _six(_PIPE_KPIS, _PIPE_DOUBLES))
def pipeline_kpis_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = written(built(spark, sf_dir))
    return _rounded(gold.pipeline_kpis(g, _zones(g), kpis.valve_isolation(g, _pairs(spark, sf_dir))))


@query("plant_kpis_full", f"""SELECT (SELECT count(*) FROM part) AS total_objects, (SELECT count(*) FROM ({_GOLD}) WHERE graph_participant) AS total_physical_objects,
  (SELECT round(sum(dry_weight_kg) / 1000 + 1e-9, 6) FROM ({_GOLD}) WHERE graph_participant) AS total_weight_tonnes, ({graphs.DEPTHS} SELECT max(depth) + 1 FROM l)::BIGINT AS critical_chain_length, (SELECT count(*) FROM ({_ZONE_KPIS})) AS max_parallel_zones,
  (SELECT sum(zone_critical_equipment_count)::BIGINT FROM ({_ZONE_KPIS})) AS high_criticality_equipment, (SELECT count(*) FROM ({_PIPE_KPIS}) WHERE pipeline_corrosion_risk > 0.7) AS high_corrosion_pipelines,
  (SELECT count(*) FROM ({_ZONE_KPIS}) WHERE zone_mean_accessibility < 0.2) AS low_accessibility_zones""")
def plant_kpis_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, pairs = written(built(spark, sf_dir)), written(_pairs(spark, sf_dir))
    chain = graphs.longest_chain(spark, sf_dir).agg(F.coalesce(F.max("depth") + 1, F.lit(0))).first()[0]
    by_zone, by_pipeline = gold.zone_kpis(g, _zones(g), kpis.object_kpis(g, pairs)), gold.pipeline_kpis(g, _zones(g), kpis.valve_isolation(g, pairs))
    return _rounded(gold.plant_kpis(g, by_zone, by_pipeline, chain))


@query("verdict_dim", f"SELECT verdict, count(*) AS object_count, coalesce(verdict IN ('OK_MESH', 'OK_FBX'), false) AS is_ok FROM ({_RAW}) GROUP BY verdict")
def verdict_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).groupBy("verdict").agg(F.count("*").alias("object_count")).withColumn("is_ok", F.coalesce(F.col("verdict").isin("OK_MESH", "OK_FBX"), F.lit(False)))


@query("class_flag_means", f"SELECT refined_class, {', '.join(f'round(avg({c}::INT), 6) AS {c}' for c in FLAGS)} FROM ({_GOLD}) GROUP BY refined_class")
def class_flag_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir).groupBy("refined_class").agg(*[F.round(F.avg(F.col(c).cast("int")), 6).alias(c) for c in FLAGS])


@query("class_singletons", f"""SELECT class_raw, count(*) FILTER (n = 1) AS singletons, count(*) FILTER (has_real_mesh) AS with_mesh, count(*) FILTER (NOT coalesce(has_real_mesh, false)) AS without_mesh
FROM ({_RAW}) r LEFT JOIN (SELECT group_id, count(*) AS n FROM ({_RAW}) GROUP BY 1) g ON r.group_id = g.group_id GROUP BY class_raw""")
def class_singletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw(spark, sf_dir)
    sizes = r.groupBy("group_id").agg(F.count("*").alias("n"))
    meshed = F.coalesce("has_real_mesh", F.lit(False))
    return r.join(sizes, "group_id", "left").groupBy("class_raw").agg(F.count_if(F.col("n") == 1).alias("singletons"), F.count_if(meshed).alias("with_mesh"), F.count_if(~meshed).alias("without_mesh"))


@query("clash_pressure", f"""WITH p AS (SELECT sp3d_pipeline, round(max(design_pressure_kpa) + 1e-9, 6) AS pressure FROM ({_GOLD}) WHERE sp3d_pipeline <> '' GROUP BY 1), o AS (SELECT num, g.sp3d_pipeline, pressure FROM ({_GOLD}) g JOIN p ON g.sp3d_pipeline = p.sp3d_pipeline WHERE NOT is_parent_box AND NOT is_bbox_placeholder AND NOT is_analysis_volume)
SELECT src, dst, a.sp3d_pipeline AS src_pipeline, b.sp3d_pipeline AS dst_pipeline, overlap, round(overlap * greatest(coalesce(a.pressure, 0), coalesce(b.pressure, 0)), 6) AS score
FROM ({{EDGES}}) e JOIN o a ON e.src = a.num JOIN o b ON e.dst = b.num WHERE relation = 'overlap' AND a.sp3d_pipeline <> b.sp3d_pipeline ORDER BY score DESC, src, dst LIMIT 100""")
def clash_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = built(spark, sf_dir)
    lines = g.where("sp3d_pipeline <> ''").groupBy("sp3d_pipeline").agg(F.round(F.max("design_pressure_kpa") + 1e-9, 6).alias("pressure"))
    o = g.where("NOT is_parent_box AND NOT is_bbox_placeholder AND NOT is_analysis_volume").join(lines, "sp3d_pipeline").select("num", "sp3d_pipeline", "pressure")
    ends = [o.withColumnsRenamed({"num": n, "sp3d_pipeline": f"{n}_pipeline", "pressure": f"{n}_pressure"}) for n in ("src", "dst")]
    e = edges(spark, sf_dir).where("relation = 'overlap'").join(ends[0], "src").join(ends[1], "dst").where("src_pipeline <> dst_pipeline")
    most = F.greatest(F.coalesce("src_pressure", F.lit(0.0)), F.coalesce("dst_pressure", F.lit(0.0)))
    return e.select("src", "dst", "src_pipeline", "dst_pipeline", "overlap", F.round(F.col("overlap") * most, 6).alias("score")).orderBy(F.desc("score"), "src", "dst").limit(100)


@query("neighbour_max_overlap", f"""WITH o AS ({_RAW}), m AS (SELECT a.sp3d_pipeline AS pipeline, e.other, max(overlap) AS overlap FROM (SELECT src AS one, dst AS other, overlap FROM ({{EDGES}}) UNION ALL SELECT dst, src, overlap FROM ({{EDGES}})) e
JOIN o a ON e.one = a.num JOIN o b ON e.other = b.num WHERE a.sp3d_pipeline <> '' AND coalesce(b.sp3d_pipeline, '') <> a.sp3d_pipeline GROUP BY 1, 2)
SELECT pipeline, other, overlap FROM (SELECT *, row_number() OVER (PARTITION BY pipeline ORDER BY overlap DESC, other) AS n FROM m) WHERE n <= 10""")
def neighbour_max_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each pipeline the ten objects outside it that overlap it most."""
    line = raw(spark, sf_dir).select("num", "sp3d_pipeline")
    both = rel.symmetric_closure(edges(spark, sf_dir).select("src", "dst", "overlap"), "src", "dst").withColumnsRenamed({"src": "one", "dst": "other"})
    met = both.join(line.withColumnsRenamed({"num": "one", "sp3d_pipeline": "pipeline"}), "one").join(line.withColumnsRenamed({"num": "other", "sp3d_pipeline": "far"}), "other")
    most = met.where("pipeline <> '' AND coalesce(far, '') <> pipeline").groupBy("pipeline", "other").agg(F.max("overlap").alias("overlap"))
    return rel.top_each(most, ["pipeline"], [F.desc("overlap"), F.asc("other")], 10)


_LABELS = {"Piping": "PipingComponent", "Structure": "StructuralMember", "Equipment": "Equipment", "Electrical": "ElectricalComponent", "HVAC": "HvacComponent", "Other": "UncategorizedObject"}
_LABEL_SQL = " ".join(f"WHEN '{k}' THEN 'BIMObject:{v}'" for k, v in _LABELS.items())


@query("graph_nodes", f"""SELECT object_id AS id, CASE WHEN is_analysis_volume THEN 'AnalysisArtifact:AnalysisVolume' WHEN is_container THEN 'BIMObject:HierarchyNode' ELSE CASE refined_class {_LABEL_SQL} ELSE 'BIMObject' END END AS label, display_name AS name FROM ({_GOLD})
UNION ALL SELECT DISTINCT 'pipeline-' || sp3d_pipeline, 'Pipeline', sp3d_pipeline FROM ({_RAW}) WHERE sp3d_pipeline IS NOT NULL
UNION ALL SELECT DISTINCT 'zone-' || zone_id::BIGINT, 'Zone', zone_id::BIGINT::VARCHAR FROM ({_ZONES} FROM ({_GOLD}))""")
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = built(spark, sf_dir)
    by_class = F.create_map(*[F.lit(x) for k, v in _LABELS.items() for x in (k, f"BIMObject:{v}")])
    label = F.when(F.col("is_analysis_volume"), "AnalysisArtifact:AnalysisVolume").when(F.col("is_container"), "BIMObject:HierarchyNode").otherwise(F.coalesce(F.try_element_at(by_class, "refined_class"), F.lit("BIMObject")))
    own = g.select(F.col("object_id").alias("id"), label.alias("label"), F.col("display_name").alias("name"))
    lines = g.where("sp3d_pipeline IS NOT NULL").select("sp3d_pipeline").distinct().select(F.concat(F.lit("pipeline-"), "sp3d_pipeline"), F.lit("Pipeline"), "sp3d_pipeline")
    zones = _zones(g).select(F.col("zone_id").cast("bigint").cast("string").alias("z")).distinct().select(F.concat(F.lit("zone-"), "z"), F.lit("Zone"), "z")
    return own.union(lines).union(zones)


@query("graph_edges", f"""SELECT 'obj-' || src AS start_id, 'obj-' || dst AS end_id, 'ADJACENT_TO' AS type FROM ({{EDGES}})
UNION ALL SELECT object_id, parent_id, 'HAS_PARENT' FROM ({_RAW}) WHERE parent_id IN (SELECT object_id FROM ({_RAW}))
UNION ALL SELECT object_id, 'pipeline-' || sp3d_pipeline, 'BELONGS_TO_PIPELINE' FROM ({_RAW}) WHERE sp3d_pipeline IS NOT NULL
UNION ALL SELECT object_id, 'zone-' || zone_id::BIGINT, 'IN_ZONE' FROM ({_ZONES} FROM ({_RAW}))""")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw(spark, sf_dir)
    ids = r.select(F.col("object_id").alias("parent_id"))
    near = edges(spark, sf_dir).select(F.concat(F.lit("obj-"), "src").alias("start_id"), F.concat(F.lit("obj-"), "dst").alias("end_id"), F.lit("ADJACENT_TO").alias("type"))
    up = r.where("parent_id <> ''").join(ids, "parent_id", "left_semi").select("object_id", "parent_id", F.lit("HAS_PARENT"))
    line = r.where("sp3d_pipeline IS NOT NULL").select("object_id", F.concat(F.lit("pipeline-"), "sp3d_pipeline"), F.lit("BELONGS_TO_PIPELINE"))
    zone = _zones(r).select("object_id", F.concat(F.lit("zone-"), F.col("zone_id").cast("bigint").cast("string")), F.lit("IN_ZONE"))
    return near.union(up).union(line).union(zone)


_STEPS = f"UNION ALL SELECT 'obj-' || src, 'obj-' || dst, 'MUST_PRECEDE', edge_type FROM ({graphs.ACYCLIC})"


@query("graph_edges_full", f"""SELECT 'obj-' || src AS start_id, 'obj-' || dst AS end_id, 'ADJACENT_TO' AS type, NULL::VARCHAR AS edge_type FROM ({{EDGES}})
UNION ALL SELECT object_id, parent_id, 'HAS_PARENT', NULL FROM ({_RAW}) WHERE parent_id IN (SELECT object_id FROM ({_RAW}))
UNION ALL SELECT object_id, 'pipeline-' || sp3d_pipeline, 'BELONGS_TO_PIPELINE', NULL FROM ({_RAW}) WHERE sp3d_pipeline IS NOT NULL
UNION ALL SELECT object_id, 'zone-' || zone_id::BIGINT, 'IN_ZONE', NULL FROM ({_ZONES} FROM ({_RAW})) {_STEPS}""")
def graph_edges_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five kinds of edges of the property graph; those of the precedence graph without cycles say what they come from."""
    steps = graphs.acyclic_precedence(spark, sf_dir)
    steps = steps.select(F.concat(F.lit("obj-"), "src").alias("start_id"), F.concat(F.lit("obj-"), "dst").alias("end_id"), F.lit("MUST_PRECEDE").alias("type"), "edge_type")
    return graph_edges(spark, sf_dir).withColumn("edge_type", F.lit(None).cast("string")).unionByName(steps)


# ontology ----------------------------------------------------------------------------------------------------------

#: Shared things and the property that names each; literals of an object and their types; its links.
SHARED = [("pipeline", "Pipeline", "pipelineName", "sp3d_pipeline", "string"), ("piperun", "PipeRun", "pipeRunName", "sp3d_pipe_run", "string"), ("level", "Level", "levelValue", "level", "integer"), ("material", "Material", "materialName", "sp3d_material", "string"), ("spec", "Specification", "specificationName", "sp3d_spec_name", "string")]
LITERALS = [
    ("objectId", "object_id", "string"), ("displayName", "display_name", "string"), ("systemPath", "system_path", "string"), ("level", "level", "integer"), ("refinedClass", "refined_class", "string"),
    ("centroidX", "centroid_x", "double"), ("centroidY", "centroid_y", "double"), ("centroidZ", "centroid_z", "double"), ("bboxVolumeM3", "bbox_volume_m3", "double"), ("hasRealMesh", "has_real_mesh", "boolean"),
    ("dryWeightKg", "dry_weight_kg", "double"), ("wetWeightKg", "wet_weight_kg", "double"), ("lengthM", "length_m", "double"), ("designPressureKpa", "design_pressure_kpa", "double"), ("designTemperatureC", "design_temperature_c", "double"),
    ("commodityCode", "sp3d_commodity_code", "string"), ("npd", "sp3d_npd", "string"), ("specName", "sp3d_spec_name", "string"), ("isContainer", "is_container", "boolean"), ("isAnalysisVolume", "is_analysis_volume", "boolean"),
    ("classificationConfidence", "classification_confidence", "string"), ("classificationConfidenceReason", "classification_confidence_reason", "string"),
]
LINKS = [("belongsToPipeline", "sp3d_pipeline", "pipeline-"), ("belongsToPipeRun", "sp3d_pipe_run", "piperun-"), ("hasParent", "parent_id", ""), ("atLevel", "level", "level-"), ("hasMaterial", "sp3d_material", "material-"), ("hasSpecification", "sp3d_spec_name", "spec-"), ("inGroup", "group_id", "group-")]


def _literal_sql(column: str, kind: str) -> str:
    return f"CAST(round({column} * 10000 + 1e-6) AS BIGINT)::VARCHAR" if kind == "double" else f"{column}::VARCHAR"


_SAFE = "coalesce(nullif(trim(regexp_replace(regexp_replace(trim({0}::VARCHAR), '[^A-Za-z0-9_-]', '_', 'g'), '_+', '_', 'g'), '_'), ''), 'unknown')"


@query("schema_counts", """SELECT * FROM (VALUES ('rdf:type', 'owl:Class', 28), ('rdf:type', 'owl:ObjectProperty', 8), ('rdf:type', 'owl:DatatypeProperty', 32), ('rdf:type', 'owl:SymmetricProperty', 1),
('rdfs:subClassOf', NULL, 26), ('rdfs:domain', NULL, 40), ('rdfs:range', NULL, 40), ('rdfs:label', NULL, 68)) AS t(p, kind, n)""")
def schema_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("p") == "rdf:type", F.col("o"))
    return ontology.schema_triples(spark).groupBy("p", kind.alias("kind")).agg(F.count("*").alias("n"))


_TYPE = "CASE num % 9 WHEN 0 THEN 'Process Equipment' WHEN 1 THEN 'Architectural' WHEN 2 THEN 'unheard of' END"


@query("object_types", f"""SELECT object_id, CASE WHEN is_analysis_volume THEN 'AnalysisVolume' WHEN is_container OR is_parent_box THEN 'HierarchyNode' WHEN refined_class = 'Equipment' THEN
  CASE num % 9 WHEN 0 THEN 'ProcessEquipment' WHEN 1 THEN 'ArchitecturalEquipment' ELSE 'UnclassifiedEquipment' END WHEN refined_class = 'Piping' THEN 'PipingComponent' WHEN refined_class = 'Structure' THEN 'StructuralMember'
  WHEN refined_class = 'Electrical' THEN 'ElectricalComponent' ELSE 'UncategorizedObject' END AS type FROM ({_GOLD})""")
def object_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = ontology.class_of(F.col("is_analysis_volume"), F.col("is_container"), F.col("is_parent_box"), F.col("refined_class"), F.expr(_TYPE))
    return built(spark, sf_dir).select("object_id", made.alias("type"))


@query("shared_individuals", " UNION ALL ".join(f"SELECT DISTINCT 'inst:{p}-' || {'level' if k == 'integer' else _SAFE.format(c)} AS s, 'rdf:type' AS p, 'bim:{cls}' AS o, 'iri' AS o_type FROM ({_RAW}) WHERE {c} IS NOT NULL UNION ALL SELECT DISTINCT 'inst:{p}-' || {'level' if k == 'integer' else _SAFE.format(c)}, 'bim:{prop}', {c}::VARCHAR, '{k}' FROM ({_RAW}) WHERE {c} IS NOT NULL" for p, cls, prop, c, k in SHARED))
def shared_individuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, out = raw(spark, sf_dir), None
    things = []
    for prefix, cls, prop, column, kind in SHARED:
        iri = F.concat(F.lit(f"inst:{prefix}-"), F.col(column).cast("string") if kind == "integer" else names.uri_safe(F.col(column)))
        things.append(F.struct(iri.alias("s"), F.lit(cls).alias("cls"), F.lit(prop).alias("prop"), F.col(column).cast("string").alias("o"), F.lit(kind).alias("kind")))
    seen = r.select(F.inline(F.array(*things))).where("o IS NOT NULL").distinct()
    typed = seen.select("s", F.lit("rdf:type").alias("p"), F.concat(F.lit("bim:"), "cls").alias("o"), F.lit("iri").alias("o_type")).distinct()
    out = seen.select("s", F.concat(F.lit("bim:"), "prop"), "o", "kind")
    return typed.union(out)


@query("object_literals", " UNION ALL ".join(f"SELECT 'inst:' || object_id AS s, 'bim:{p}' AS p, {_literal_sql(c, k)} AS o, '{k}' AS o_type FROM ({_GOLD}) WHERE {c} IS NOT NULL{' AND trim(' + c + ') <> ' + repr('') if k == 'string' else ''}" for p, c, k in LITERALS))
def object_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every literal of every object, in one pass; doubles in ten-thousandths, so that they compare as text."""
    g = built(spark, sf_dir)

    def told(column: str, kind: str):
        c = F.col(column)
        value = F.round(c * 10000 + 1e-6).cast("bigint") if kind == "double" else c
        return F.when(F.trim(c) != "", c) if kind == "string" else value.cast("string")

    made = F.array(*[F.struct(F.lit(f"bim:{p}").alias("p"), told(c, k).alias("o"), F.lit(k).alias("o_type")) for p, c, k in LITERALS])
    return g.select(F.concat(F.lit("inst:"), "object_id").alias("s"), F.inline(made)).where("o IS NOT NULL")


@query("object_links", " UNION ALL ".join(f"SELECT 'inst:' || object_id AS s, 'bim:{p}' AS p, 'inst:{prefix}' || {c if p in ('hasParent', 'atLevel') else _SAFE.format(c)} AS o FROM ({_RAW}) WHERE {c} IS NOT NULL{'' if p == 'atLevel' else ' AND trim(' + c + ') <> ' + repr('')}" for p, c, prefix in LINKS))
def object_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    def told(p: str, column: str, prefix: str):
        c = F.col(column).cast("string")
        return F.when(F.trim(c) != "", F.concat(F.lit(f"inst:{prefix}"), c if p in ("hasParent", "atLevel") else names.uri_safe(c)))

    made = F.array(*[F.struct(F.lit(f"bim:{p}").alias("p"), told(p, c, prefix).alias("o")) for p, c, prefix in LINKS])
    return raw(spark, sf_dir).select(F.concat(F.lit("inst:"), "object_id").alias("s"), F.inline(made)).where("o IS NOT NULL")


@query("spatial_triples", "SELECT 'inst:obj-' || src AS s, 'bim:adjacentTo' AS p, 'inst:obj-' || dst AS o FROM ({EDGES}) UNION ALL SELECT 'inst:obj-' || dst, 'bim:adjacentTo', 'inst:obj-' || src FROM ({EDGES})")
def spatial_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = rel.symmetric_closure(edges(spark, sf_dir).select("src", "dst"), "src", "dst")
    return both.select(F.concat(F.lit("inst:obj-"), "src").alias("s"), F.lit("bim:adjacentTo").alias("p"), F.concat(F.lit("inst:obj-"), "dst").alias("o"))


@query("piping_confidence_shape", f"SELECT object_id FROM ({_GOLD}) WHERE refined_class = 'Piping' AND classification_confidence NOT IN ('HIGH', 'LOW')")
def piping_confidence_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piping without a confidence that the shape admits (HIGH or LOW here, so that some violate it)."""
    return built(spark, sf_dir).where("refined_class = 'Piping' AND NOT coalesce(classification_confidence IN ('HIGH', 'LOW'), false)").select("object_id")


# small scalars -----------------------------------------------------------------------------------------------------


@query("path_and_prefix", f"""SELECT object_id, coalesce(starts_with(system_path, 'TRAINING'), false) AS in_training, split_part(object_id, '-', 1) AS prefix, regexp_extract(p_type, '^([^-_0-9]+)', 1) AS stem,
  format('{{:,}}', num * 1000) AS thousands, num * 10000 AS raw_value FROM ({_RAW}) JOIN part ON num = p_partkey""")
def path_and_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("num"), "p_type"), "num")
    return r.select("object_id", F.coalesce(F.col("system_path").startswith("TRAINING"), F.lit(False)).alias("in_training"), F.substring_index("object_id", "-", 1).alias("prefix"), F.regexp_extract("p_type", "^([^-_0-9]+)", 1).alias("stem"), F.format_number(F.col("num") * 1000, 0).alias("thousands"), (F.col("num") * 10000).alias("raw_value"))


@query("coerced_times", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def coerced_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is no time gives NULL."""
    text = F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd").alias("day"))


@query("mesh_references", "SELECT page_id, CASE WHEN page_id % 3 > 0 THEN page_id || '.glb' END AS uri FROM pages")
def mesh_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the folder before it; blank is NULL."""
    k = F.col("page_id")
    source = F.when(k % 3 == 0, " ").when(k % 3 == 1, F.concat(F.lit("mesh/"), k, F.lit(".glb"))).otherwise(F.concat(k, F.lit(".glb")))
    return table(spark, sf_dir, "pages").select("page_id", F.nullif(F.trim(F.regexp_replace(source, "^mesh/", "")), F.lit("")).alias("uri"))


@query("readable_labels", f"SELECT object_id, CASE classification_confidence_reason WHEN 'xlsx_class_clean' THEN 'Xlsx Class Clean' WHEN 'piping_has_pipeline_and_metadata' THEN 'Has Pipeline And Metadata' WHEN 'piping_pipeline_only' THEN 'Pipeline Only' WHEN 'piping_metadata_only' THEN 'Metadata Only' ELSE 'No Metadata' END AS label FROM ({_GOLD})")
def readable_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.initcap(F.regexp_replace(F.regexp_replace("classification_confidence_reason", "^piping_", ""), "_", " "))
    return built(spark, sf_dir).select("object_id", F.when(label.startswith("No Metadata"), "No Metadata").otherwise(label).alias("label"))


@query("install_order", f"SELECT object_id, row_number() OVER (PARTITION BY level ORDER BY CASE class_raw WHEN 'Structure' THEN 1 WHEN 'Equipment' THEN 2 WHEN 'Piping' THEN 3 ELSE 4 END, coalesce(group_id, ''), coalesce(adjacency_count, 0) DESC, num) AS place, level FROM ({_RAW})")
def install_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place within the level by class sequence, package, priority and id."""
    sequence = F.expr("CASE class_raw WHEN 'Structure' THEN 1 WHEN 'Equipment' THEN 2 WHEN 'Piping' THEN 3 ELSE 4 END")
    order = [sequence, F.coalesce("group_id", F.lit("")), F.desc(F.coalesce("adjacency_count", F.lit(0))), F.col("num")]
    return rel.place_in(raw(spark, sf_dir), "level", order, "place").select("object_id", "place", "level")


@query("pressure_or_heat", f"SELECT object_id FROM ({_GOLD}) WHERE trim(coalesce(sp3d_material, '')) <> '' AND (design_pressure_kpa > 0 OR coalesce(design_temperature_c <> 0, true))")
def pressure_or_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a material, and under pressure or of a temperature other than 0; an unknown temperature counts as other."""
    return built(spark, sf_dir).where((F.trim("sp3d_material") != "") & ((F.col("design_pressure_kpa") > 0) | F.coalesce(F.col("design_temperature_c") != 0, F.lit(True)))).select("object_id")
