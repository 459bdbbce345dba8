"""Scalar functions over unit strings, names and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.functions import text as names
from gantry.functions import units
from gantry.operators import relational as rel
from gantry.plans.base import objects, query, table


@query("unit_length", """SELECT id, round(CASE size % 5 WHEN 0 THEN size * 0.3048::DOUBLE + 4 * 0.0254::DOUBLE WHEN 1 THEN (size + 0.5::DOUBLE) * 0.0254::DOUBLE WHEN 2 THEN size / 1000 WHEN 3 THEN size * 0.3048::DOUBLE END, 9) AS m FROM ({OBJ})""")
def unit_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("size")
    raw = F.when(size % 5 == 0, F.concat(size, F.lit(" ft  4.00 in"))).when(size % 5 == 1, F.concat(size, F.lit(" 1/2 in"))).when(size % 5 == 2, F.concat(size, F.lit(" mm"))).when(size % 5 == 3, F.concat(size, F.lit(" ft"))).otherwise("n/a")
    return objects(spark, sf_dir).select("id", F.round(units.length_m(raw), 9).alias("m"))


@query("unit_weight", "SELECT id, CASE WHEN size % 4 <> 0 THEN round((size + 0.25) * 0.45359237::DOUBLE, 9) END AS kg FROM ({OBJ})")
def unit_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("size")
    raw = F.when(size % 4 != 0, F.concat(size, F.lit(".25 LBM"))).otherwise(F.concat(size, F.lit(" kg")))
    return objects(spark, sf_dir).select("id", F.round(units.weight_kg(raw), 9).alias("kg"))


@query("unit_pressure", "SELECT id, round(size * 6.894757::DOUBLE, 9) AS kpa FROM ({OBJ})")
def unit_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("size")
    return objects(spark, sf_dir).select("id", F.round(units.pressure_kpa(F.concat(size, F.lit(".00 psi"))), 9).alias("kpa"))


@query("unit_temperature", "SELECT id, CASE WHEN size % 3 <> 0 THEN round((size * 10.0::DOUBLE - 32) * 5 / 9, 9) END AS c FROM ({OBJ})")
def unit_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("size")
    raw = F.when(size % 3 != 0, F.concat(size * 10, F.lit(" F"))).otherwise(F.concat(size * 10, F.lit(" f")))
    return objects(spark, sf_dir).select("id", F.round(units.temperature_c(raw), 9).alias("c"))


@query("unit_npd", """SELECT id, round(CASE size % 4 WHEN 3 THEN NULL ELSE size * CASE WHEN size % 4 = 1 THEN 0.001::DOUBLE ELSE 0.0254::DOUBLE END END, 9) AS end1, round(CASE size % 4 WHEN 0 THEN 6 * 0.0254::DOUBLE WHEN 1 THEN 0.0 WHEN 2 THEN size * 0.0254::DOUBLE END, 9) AS end2 FROM ({OBJ})""")
def unit_npd(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("size")
    raw = F.when(size % 4 == 0, F.concat(size, F.lit("in x 6in"))).when(size % 4 == 1, F.concat(size, F.lit("mm x 0"))).when(size % 4 == 2, F.concat(size, F.lit(" in"))).otherwise(F.concat(size, F.lit("in x 6mm")))
    made = objects(spark, sf_dir).select("id", units.npd_m(raw).alias("n"))
    return made.select("id", F.round("n.end1", 9).alias("end1"), F.round("n.end2", 9).alias("end2"))


@query("unit_npd_inches", "SELECT id, round(CASE WHEN size % 2 = 0 THEN size ELSE size / 25.4 END, 9) AS inches FROM ({OBJ})")
def unit_npd_inches(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("size")
    raw = F.when(size % 2 == 0, F.concat(size, F.lit(" in dia"))).otherwise(F.concat(size, F.lit("mm dia")))
    return objects(spark, sf_dir).select("id", F.round(units.npd_inches(raw), 9).alias("inches"))


#: Texts over a size n, one of each row by its id: of a length, of a weight, pressure or temperature (with its unit), of a pipe's diameters.
_LENGTHS = ["-{n} ft", "1.{n} ft 6 in", "{n} ft  -2.5 in", "{n}. in", ".5 in", "{n} 1/0 in", "{n}.5 1/2 in", "-{n} 1/2 in", "\t{n} FT 3/4 IN ", "{n} ft 4", "-.25 mm", "{n}/8 in"]
_AMOUNTS = ["-{n}.5 u", "{n}. u", ".5 u", "{n}.0625u", " -{n}   U", "+{n} u", "{n} u u"]
_DIAMETERS = ["-{n}in x .5in", "{n}mm x 0", "{n}. in", ".5mm", "{n}in x 2mm", "{n} IN X 0", "{n}in x 0.0", "{n}.25 in x -3 in"]


def _texts(forms: list[str]) -> Column:
    n = F.col("size").cast("string")
    out = F.lit(None).cast("string")
    for k, form in enumerate(forms):
        before, _, after = form.partition("{n}")
        out = F.when(F.col("id") % len(forms) == k, F.concat(F.lit(before), n, F.lit(after)) if "{n}" in form else F.lit(form)).otherwise(out)
    return out


@query("unit_grammar", """SELECT id, round(CASE id % 12 WHEN 0 THEN -size * 0.3048::DOUBLE WHEN 1 THEN ('1.' || size)::DOUBLE * 0.3048 + 6 * 0.0254::DOUBLE WHEN 2 THEN size * 0.3048::DOUBLE - 2.5 * 0.0254::DOUBLE WHEN 4 THEN 0.5 * 0.0254::DOUBLE
  WHEN 8 THEN size * 0.3048::DOUBLE + 0.75 * 0.0254::DOUBLE WHEN 10 THEN -0.25 * 0.001::DOUBLE WHEN 11 THEN size / 8 * 0.0254::DOUBLE END, 9) AS m,
  round(a * 0.45359237::DOUBLE, 9) AS kg, round(a * 6.894757::DOUBLE, 9) AS kpa, round((CASE WHEN id % 7 <> 4 THEN a END - 32) * 5 / 9, 9) AS c,
  round(CASE id % 8 WHEN 0 THEN -size * 0.0254::DOUBLE WHEN 1 THEN size * 0.001::DOUBLE WHEN 3 THEN 0.0005 WHEN 5 THEN size * 0.0254::DOUBLE WHEN 7 THEN (size + 0.25::DOUBLE) * 0.0254 END, 9)::DOUBLE AS end1,
  round(CASE id % 8 WHEN 0 THEN 0.0127 WHEN 1 THEN 0 WHEN 3 THEN 0.0005 WHEN 5 THEN 0 WHEN 7 THEN -0.0762 END, 9)::DOUBLE AS end2
FROM (SELECT *, CASE id % 7 WHEN 0 THEN -(size + 0.5::DOUBLE) WHEN 3 THEN size + 0.0625::DOUBLE WHEN 4 THEN -size::DOUBLE END AS a FROM ({OBJ}))""")
def unit_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signs, leading and trailing points, fractions beside numbers, either case and stray white space, by every parser."""
    amount = _texts(_AMOUNTS)
    o = objects(spark, sf_dir)
    named = [F.regexp_replace(amount, "(?i)u", u) for u in ("lbm", "psi")] + [F.regexp_replace(F.regexp_replace(amount, "U", "f"), "u", "F")]
    npd = units.npd_m(_texts(_DIAMETERS))
    made = o.select("id", units.length_m(_texts(_LENGTHS)).alias("m"), units.weight_kg(named[0]).alias("kg"), units.pressure_kpa(named[1]).alias("kpa"), units.temperature_c(named[2]).alias("c"), npd["end1"].alias("end1"), npd["end2"].alias("end2"))
    return made.select("id", *[F.round(x, 9).alias(x) for x in ("m", "kg", "kpa", "c", "end1", "end2")])


#: Patterns of the classes by name, in order of precedence.
CLASS_RULES = [(r"(?i)\bpipe\b(?!\s+(rack|support))", "Piping"), (r"(?i)\b(beam|column|rack)\b", "Structure"), (r"(?i)\b(pump|tank|vessel)\b", "Equipment"), (r"(?i)\bcable\b", "Electrical"), (r"(?i)\b(duct|ventilat)\b", "HVAC")]


@query("classify_tiers", r"""SELECT id, CASE WHEN regexp_matches(regexp_replace(label, 'pipe\s+(rack|support)', ' \1', 'g'), '\bpipe\b') THEN 'Piping' WHEN regexp_matches(label, '\b(beam|column|rack)\b') THEN 'Structure'
WHEN regexp_matches(label, '\b(pump|tank|vessel)\b') THEN 'Equipment' WHEN regexp_matches(label, '\bcable\b') THEN 'Electrical' WHEN regexp_matches(label, '\b(duct|ventilat)\b') THEN 'HVAC' ELSE 'Other' END AS class
FROM (SELECT id, CASE size % 8 WHEN 0 THEN 'pipe 4' WHEN 1 THEN 'pipe rack 2' WHEN 2 THEN 'feed pump' WHEN 3 THEN 'cable tray' WHEN 4 THEN 'ventilation' WHEN 5 THEN 'air duct' WHEN 6 THEN 'beam_block' ELSE 'pipe  support' END AS label FROM ({OBJ}))""")
def classify_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("size")
    label = F.when(size % 8 == 0, "pipe 4").when(size % 8 == 1, "pipe rack 2").when(size % 8 == 2, "feed pump").when(size % 8 == 3, "cable tray").when(size % 8 == 4, "ventilation").when(size % 8 == 5, "air duct").when(size % 8 == 6, "beam_block").otherwise("pipe  support")
    return objects(spark, sf_dir).select("id", names.first_rule(label, CLASS_RULES, "Other").alias("class"))


@query("clean_prefix", "SELECT id, CASE WHEN size % 3 = 0 THEN trim(name) ELSE name END AS name FROM ({OBJ})")
def clean_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("size")
    raw = F.when(size % 3 == 0, F.concat(F.lit("DISPLAYSTRING:  "), "name")).otherwise(F.col("name"))
    return objects(spark, sf_dir).select("id", names.clean_prefix(raw).alias("name"))


@query("snake_case_values", r"""SELECT id, trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_') AS name FROM ({OBJ})""")
def snake_case_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).select("id", names.snake_case_column(F.col("name")).alias("name"))


@query("title_fallback", "SELECT id, coalesce(grp, CAST(id AS VARCHAR)) AS title FROM ({OBJ})")
def title_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = F.when(F.col("grp").isNull() & (F.col("id") % 2 == 0), "  ").otherwise(F.col("grp"))
    return objects(spark, sf_dir).select("id", names.title_or_id(blank, F.col("id").cast("string")).alias("title"))


@query("uri_names", r"""SELECT page_id, coalesce(nullif(trim(regexp_replace(regexp_replace(trim(url), '[^A-Za-z0-9_-]', '_', 'g'), '_+', '_', 'g'), '_'), ''), 'unknown') AS safe FROM pages""")
def uri_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", names.uri_safe(F.col("url")).alias("safe"))


@query("container_flags", """SELECT id, weight IS NULL AND level = 0 AS is_container, coalesce(grp = 'Brand#11', false) AS is_box, regexp_matches(lower(name), 'part_?1.*9|volume') AS is_volume FROM ({OBJ})""")
def container_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    no = F.lit(False)
    return objects(spark, sf_dir).select("id", (F.col("weight").isNull() & (F.col("level") == 0)).alias("is_container"), F.coalesce(F.col("grp") == "Brand#11", no).alias("is_box"), F.coalesce(F.col("name").rlike("(?i)part_?1.*9|volume"), no).alias("is_volume"))


@query("parent_box_p99", """WITH o AS ({OBJ}), t AS (SELECT coalesce(quantile_cont(pressure, 0.99), 0) AS p FROM o WHERE weight IS NOT NULL) SELECT id, weight IS NULL AND pressure > t.p AS is_parent_box FROM o, t""")
def parent_box_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    bound = rel.exact_quantile(o.where("weight IS NOT NULL"), "pressure", 0.99) or 0.0
    return o.select("id", (F.col("weight").isNull() & (F.col("pressure") > bound)).alias("is_parent_box"))


@query("confidence_rules", """SELECT id, CASE WHEN grp IS NOT NULL AND weight IS NOT NULL THEN 'HIGH' WHEN grp IS NOT NULL THEN 'LOW' ELSE 'LIKELY_BUG' END AS confidence,
CASE WHEN grp IS NOT NULL AND weight IS NOT NULL THEN 'complete' WHEN grp IS NOT NULL THEN 'no_weight' WHEN name LIKE '%bolt%' THEN 'trench' WHEN name LIKE '%large%' THEN 'rack' ELSE 'unknown' END AS reason FROM ({OBJ})""")
def confidence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped, weighed = F.col("grp").isNotNull(), F.col("weight").isNotNull()
    tier = F.when(grouped & weighed, "HIGH").when(grouped, "LOW").otherwise("LIKELY_BUG")
    reason = F.when(grouped & weighed, "complete").when(grouped, "no_weight").when(F.col("name").contains("bolt"), "trench").when(F.col("name").contains("large"), "rack").otherwise("unknown")
    return objects(spark, sf_dir).select("id", tier.alias("confidence"), reason.alias("reason"))


@query("path_tokens", r"""SELECT page_id, split_part(regexp_replace(url, '^[a-z]+://', ''), '/', 1) AS host, split_part(regexp_replace(url, '^[a-z]+://', ''), '/', 2) AS first FROM pages""")
def path_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = F.split(F.regexp_replace("url", "^[a-z]+://", ""), "/")
    return table(spark, sf_dir, "pages").select("page_id", segments[0].alias("host"), F.coalesce(F.try_element_at(segments, F.lit(2)), F.lit("")).alias("first"))


@query("json_fields", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.none'), 'missing') AS other FROM events""")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.coalesce(F.get_json_object("props", "$.none"), F.lit("missing")).alias("other"))


@query("envelope_margin", """SELECT id, round(CASE WHEN temperature <= 0 THEN 100.0 WHEN temperature <= 50 THEN 100 - 0.4 * temperature ELSE 80 - 0.8 * (temperature - 50) END, 6) AS allowed, greatest(temperature, 0) AS clipped FROM ({OBJ})""")
def envelope_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("temperature")
    allowed = F.when(t <= 0, 100.0).when(t <= 50, 100 - 0.4 * t).otherwise(80 - 0.8 * (t - 50))
    return objects(spark, sf_dir).select("id", F.round(allowed, 6).alias("allowed"), F.when(t.isNotNull(), F.greatest(t, F.lit(0.0))).alias("clipped"))


@query("priority_first_positive", """SELECT id, CASE WHEN weight > 60 THEN weight WHEN level > 5 THEN level WHEN temperature > 0 THEN temperature ELSE 0 END::DOUBLE AS priority FROM ({OBJ})""")
def priority_first_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).select("id", F.coalesce(F.when(F.col("weight") > 60, F.col("weight")), F.when(F.col("level") > 5, F.col("level").cast("double")), F.when(F.col("temperature") > 0, F.col("temperature")), F.lit(0.0)).alias("priority"))


@query("transform_coordinates", "SELECT id, -x AS x, z AS y, y AS z FROM ({OBJ})")
def transform_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).select("id", (-F.col("x")).alias("x"), F.col("z").alias("y"), F.col("y").alias("z"))


@query("date_window", """SELECT o_orderkey, o_orderpriority FROM orders WHERE (o_orderdate IS NULL OR o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-06-30') AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 1000 AND 200000""")
def date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    within = F.col("o_orderdate").isNull() | F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-06-30").cast("timestamp_ntz"))
    return o.where(within & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_totalprice").between(1000, 200000)).select("o_orderkey", "o_orderpriority")
