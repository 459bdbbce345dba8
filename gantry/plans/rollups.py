"""Rollups, dimensions, shares, ranks and analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gantry.functions import text as names
from gantry.operators import relational as rel
from gantry.plans.base import edges, objects, query, table

R6 = 6


@query("pipeline_rollup", """
WITH m AS (SELECT l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_returnflag) AS rn FROM lineitem GROUP BY 1, 2)
SELECT l.l_suppkey AS grp, count(*) AS n, count(DISTINCT l.l_partkey) AS n_parts, round(sum(l_quantity), 6) AS weight, round(avg(l_extendedprice), 6) AS mean_p, max(l_extendedprice) AS max_p,
  min(l_extendedprice) AS min_p, round(sum(l_tax * l_quantity) / sum(l_quantity), 6) AS centroid, string_agg(DISTINCT l_linestatus, ', ' ORDER BY l_linestatus) AS statuses,
  count(*) FILTER (l_discount = 0) AS n_plain, any_value(m.l_returnflag) AS mode_flag
FROM lineitem l JOIN m ON l.l_suppkey = m.l_suppkey AND rn = 1 GROUP BY l.l_suppkey""")
def pipeline_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    made = li.groupBy(F.col("l_suppkey").alias("grp")).agg(
        F.count("*").alias("n"), F.count_distinct("l_partkey").alias("n_parts"), F.round(rel.positive_sum(F.col("l_quantity")), R6).alias("weight"), F.round(F.avg("l_extendedprice"), R6).alias("mean_p"),
        F.max("l_extendedprice").alias("max_p"), F.min("l_extendedprice").alias("min_p"), F.round(rel.weighted_mean(F.col("l_tax"), F.col("l_quantity")), R6).alias("centroid"),
        rel.sorted_list(F.col("l_linestatus")).alias("statuses"), F.count_if(F.col("l_discount") == 0).alias("n_plain"),
    )
    return made.join(rel.mode_of(li.withColumnRenamed("l_suppkey", "grp"), ["grp"], "l_returnflag", "mode_flag"), "grp")


@query("piperun_rollup", """SELECT l_suppkey || '::' || l_returnflag AS run, count(*) AS n, round(sum(l_quantity), 6) AS weight, round(avg(l_discount), 6) AS mean_t, max(l_extendedprice) AS max_p, min(l_partkey) AS first_id
FROM lineitem GROUP BY l_suppkey, l_returnflag""")
def piperun_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    made = li.groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), R6).alias("weight"), F.round(F.avg("l_discount"), R6).alias("mean_t"), F.max("l_extendedprice").alias("max_p"), F.min("l_partkey").alias("first_id"))
    return made.select(F.concat_ws("::", "l_suppkey", "l_returnflag").alias("run"), "n", "weight", "mean_t", "max_p", "first_id")


#: Order and colour of the classes.
CLASSES = {"STANDARD": (1, "#1f77b4"), "SMALL": (2, "#ff7f0e"), "MEDIUM": (3, "#2ca02c"), "LARGE": (4, "#d62728"), "ECONOMY": (5, "#9467bd"), "PROMO": (6, "#8c564b")}
_ORDER = " ".join(f"WHEN '{c}' THEN {o}" for c, (o, _) in CLASSES.items())
_COLOUR = " ".join(f"WHEN '{c}' THEN '{h}'" for c, (_, h) in CLASSES.items())


@query("class_dim", f"""SELECT cls, count(*) AS n, CASE cls {_ORDER} ELSE 99 END AS class_order, CASE cls {_COLOUR} ELSE '#7f7f7f' END AS color, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share FROM ({{OBJ}}) GROUP BY cls""")
def class_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = objects(spark, sf_dir).groupBy("cls").agg(F.count("*").alias("n"))
    pick = F.create_map(*[F.lit(x) for c, v in CLASSES.items() for x in (c, v[1])])
    rank = F.create_map(*[F.lit(x) for c, v in CLASSES.items() for x in (c, v[0])])
    made = n.withColumns({"class_order": F.coalesce(F.try_element_at(rank, "cls"), F.lit(99)), "color": F.coalesce(F.try_element_at(pick, "cls"), F.lit("#7f7f7f"))})
    return rel.share_of_total(made, "n", "share")


@query("level_dim", "SELECT level, count(*) AS n FROM ({OBJ}) GROUP BY level")
def level_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).groupBy("level").agg(F.count("*").alias("n"))


@query("group_dim", """SELECT grp, n, n = max(n) OVER () AS is_giant, n = 1 AS is_single FROM (SELECT grp, count(*) AS n FROM ({OBJ}) WHERE grp IS NOT NULL GROUP BY grp)""")
def group_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = objects(spark, sf_dir).where("grp IS NOT NULL").groupBy("grp").agg(F.count("*").alias("n"))
    return n.withColumns({"is_giant": F.col("n") == n.agg(F.max("n")).scalar(), "is_single": F.col("n") == 1})


@query("giant_group_flag", """WITH g AS (SELECT grp, count(*) AS n FROM ({OBJ}) GROUP BY grp) SELECT o.id, o.grp, coalesce(g.n = (SELECT max(n) FROM g WHERE grp IS NOT NULL), false) AS in_giant FROM ({OBJ}) o LEFT JOIN g ON o.grp = g.grp""")
def giant_group_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    n = o.where("grp IS NOT NULL").groupBy("grp").agg(F.count("*").alias("n"))
    return o.join(n, "grp", "left").select("id", "grp", F.coalesce(F.col("n") == n.agg(F.max("n")).scalar(), F.lit(False)).alias("in_giant"))


@query("meshq_dim", "SELECT source, count(*) AS n, source IN ('src0', 'src1') AS is_container FROM documents GROUP BY source")
def meshq_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).withColumn("is_container", F.col("source").isin("src0", "src1"))


@query("fact_projection", "SELECT id, name, cls, grp, CAST(NULL AS DOUBLE) AS bend_radius, level FROM ({OBJ})")
def fact_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    wanted = {"id": "bigint", "name": "string", "cls": "string", "grp": "string", "bend_radius": "double", "level": "bigint"}
    return o.select(*[F.col(c) if c in o.columns else F.lit(None).cast(t).alias(c) for c, t in wanted.items()])


@query("column_stats", """WITH o AS ({OBJ}) SELECT 'id' AS "column", count(*) FILTER (id IS NULL) AS nulls, count(DISTINCT id) AS distinct_values FROM o UNION ALL SELECT 'grp', count(*) FILTER (grp IS NULL), count(DISTINCT grp) FROM o
UNION ALL SELECT 'weight', count(*) FILTER (weight IS NULL), count(DISTINCT weight) FROM o UNION ALL SELECT 'cls', count(*) FILTER (cls IS NULL), count(DISTINCT cls) FROM o""")
def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.column_stats(objects(spark, sf_dir).select("id", "grp", "weight", "cls"))


@query("fill_rate", """WITH o AS ({OBJ}) SELECT 'grp' AS name, round(count(grp) / count(*), 6) AS rate FROM o UNION ALL SELECT 'weight', round(count(weight) / count(*), 6) FROM o""")
def fill_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = objects(spark, sf_dir).agg(*[F.round(F.count(c) / F.count("*"), R6).alias(c) for c in ("grp", "weight")])
    return made.select(F.expr("stack(2, 'grp', grp, 'weight', weight) AS (name, rate)"))


@query("crosstab", """SELECT cls, count(*) FILTER (level < 5) AS low, count(*) FILTER (level >= 5) AS high FROM ({OBJ}) GROUP BY cls""")
def crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir).withColumn("half", F.when(F.col("level") < 5, "low").otherwise("high"))
    return o.groupBy("cls").pivot("half", ["low", "high"]).agg(F.count(F.lit(1))).fillna(0, ["low", "high"])


@query("class_pair_matrix", """WITH o AS ({OBJ}), e AS ({EDGES}) SELECT least(a.cls, b.cls) AS c1, greatest(a.cls, b.cls) AS c2, count(*) FILTER (relation = 'overlap') AS "overlap", count(*) FILTER (relation = 'touch') AS touch,
count(*) FILTER (relation = 'neartouch') AS neartouch FROM e JOIN o a ON e.src = a.id JOIN o b ON e.dst = b.id GROUP BY 1, 2""")
def class_pair_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir).select("id", "cls")
    e = edges(spark, sf_dir).join(o.withColumnsRenamed({"id": "src", "cls": "ca"}), "src").join(o.withColumnsRenamed({"id": "dst", "cls": "cb"}), "dst")
    e = e.select(F.least("ca", "cb").alias("c1"), F.greatest("ca", "cb").alias("c2"), "relation")
    return e.groupBy("c1", "c2").pivot("relation", ["overlap", "touch", "neartouch"]).agg(F.count(F.lit(1))).fillna(0, ["overlap", "touch", "neartouch"])


@query("clash_rank", """WITH o AS ({OBJ}), e AS ({EDGES}) SELECT src, dst, overlap, round(ln(1 + overlap) * greatest(coalesce(a.pressure, 0), coalesce(b.pressure, 0)), 6) AS score FROM e JOIN o a ON e.src = a.id JOIN o b ON e.dst = b.id
WHERE relation = 'overlap' AND NOT coalesce(a.grp = b.grp, false) ORDER BY score DESC, src, dst LIMIT 100""")
def clash_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir).select("id", "grp", "pressure")
    e = edges(spark, sf_dir).where("relation = 'overlap'").join(o.withColumnsRenamed({"id": "src", "grp": "ga", "pressure": "pa"}), "src").join(o.withColumnsRenamed({"id": "dst", "grp": "gb", "pressure": "pb"}), "dst")
    e = e.where(~F.coalesce(F.col("ga") == F.col("gb"), F.lit(False)))
    score = F.round(F.log1p("overlap") * F.greatest(F.coalesce("pa", F.lit(0.0)), F.coalesce("pb", F.lit(0.0))), R6)
    return e.select("src", "dst", "overlap", score.alias("score")).orderBy(F.desc("score"), "src", "dst").limit(100)


@query("clash_cross_type", """WITH o AS ({OBJ}), e AS ({EDGES}) SELECT a.cls AS ca, b.cls AS cb, count(*) AS n, max(overlap) AS worst FROM e JOIN o a ON e.src = a.id JOIN o b ON e.dst = b.id WHERE a.cls <> b.cls AND overlap >= 40 GROUP BY 1, 2""")
def clash_cross_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir).select("id", "cls")
    e = edges(spark, sf_dir).where("overlap >= 40").join(o.withColumnsRenamed({"id": "src", "cls": "ca"}), "src").join(o.withColumnsRenamed({"id": "dst", "cls": "cb"}), "dst")
    return e.where("ca <> cb").groupBy("ca", "cb").agg(F.count("*").alias("n"), F.max("overlap").alias("worst"))


@query("hub_rank", """WITH d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM ({EDGES}) UNION ALL SELECT dst FROM ({EDGES})) GROUP BY id)
SELECT o.id, degree, round(ln(1 + degree) * ln(2 + coalesce(weight, 0)), 6) AS score FROM d JOIN ({OBJ}) o ON d.id = o.id ORDER BY score DESC, o.id LIMIT 20""")
def hub_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = edges(spark, sf_dir).select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    score = F.round(F.log1p("degree") * F.log1p(F.coalesce("weight", F.lit(0.0)) + 1), R6)
    return d.join(objects(spark, sf_dir), "id").select("id", "degree", score.alias("score")).orderBy(F.desc("score"), "id").limit(20)


@query("hub_tier_share", """WITH d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM ({EDGES}) UNION ALL SELECT dst FROM ({EDGES})) GROUP BY id),
r AS (SELECT o.cls, row_number() OVER (ORDER BY degree DESC, d.id) AS rn FROM d JOIN ({OBJ}) o ON d.id = o.id) SELECT cls, count(*) FILTER (rn <= 20) AS top20, count(*) FILTER (rn <= 50) AS top50, count(*) FILTER (rn <= 100) AS top100 FROM r WHERE rn <= 100 GROUP BY cls""")
def hub_tier_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = edges(spark, sf_dir).select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    top = d.orderBy(F.desc("degree"), "id").limit(100).withColumn("rn", F.row_number().over(Window.orderBy(F.desc("degree"), "id")))
    return top.join(objects(spark, sf_dir), "id").groupBy("cls").agg(*[F.count_if(F.col("rn") <= n).alias(f"top{n}") for n in (20, 50, 100)])


@query("iqr_outliers", """WITH o AS ({OBJ}), q AS (SELECT quantile_cont(weight, 0.25) AS q1, quantile_cont(weight, 0.75) AS q3 FROM o) SELECT id, weight FROM o, q WHERE weight > q3 + 0.1 * (q3 - q1)""")
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.quartile_outliers(objects(spark, sf_dir).select("id", "weight"), "weight", 0.1)


@query("quantile_profile", """SELECT cls, round(quantile_cont(pressure, 0.05), 6) AS p5, round(quantile_cont(pressure, 0.5), 6) AS p50, round(quantile_cont(pressure, 0.95), 6) AS p95 FROM ({OBJ}) GROUP BY cls""")
def quantile_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).groupBy("cls").agg(*[F.round(F.percentile("pressure", F.lit(p)), R6).alias(f"p{round(100 * p)}") for p in (0.05, 0.5, 0.95)])


@query("profile_numeric", """SELECT cls, count(weight) AS n, round(avg(weight), 6) AS mean, round(stddev_samp(weight), 6) AS sd, min(weight) AS low, max(weight) AS high, coalesce(sum(weight), 0.0) AS total FROM ({OBJ}) GROUP BY cls""")
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("weight")
    return objects(spark, sf_dir).groupBy("cls").agg(F.count(w).alias("n"), F.round(F.avg(w), R6).alias("mean"), F.round(F.stddev_samp(w), R6).alias("sd"), F.min(w).alias("low"), F.max(w).alias("high"), F.coalesce(F.sum(w), F.lit(0.0)).alias("total"))


@query("prefix_groups", """SELECT CASE WHEN kind LIKE 'STANDARD%' THEN 'std' WHEN kind LIKE 'SMALL%' THEN 'sml' WHEN kind LIKE 'S%' THEN 's' WHEN kind LIKE 'P%' THEN 'promo' ELSE 'other' END AS prefix, count(*) AS n, round(coalesce(sum(weight), 0), 6) AS weight FROM ({OBJ}) GROUP BY 1""")
def prefix_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("kind")
    prefix = F.when(kind.startswith("STANDARD"), "std").when(kind.startswith("SMALL"), "sml").when(kind.startswith("S"), "s").when(kind.startswith("P"), "promo").otherwise("other")
    return objects(spark, sf_dir).groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n"), F.round(F.coalesce(F.sum("weight"), F.lit(0.0)), R6).alias("weight"))


@query("typical_vs_outlier", """WITH o AS ({OBJ}), m AS (SELECT max(weight) AS w, max(pressure) AS p FROM o) SELECT cls, round(median(weight) / any_value(m.w), 6) AS w, round(median(pressure) / any_value(m.p), 6) AS p FROM o, m GROUP BY cls""")
def typical_vs_outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    made = o.groupBy("cls").agg(F.percentile("weight", F.lit(0.5)).alias("w"), F.percentile("pressure", F.lit(0.5)).alias("p"))
    most = o.agg(F.max("weight").alias("w"), F.max("pressure").alias("p"))
    return made.select("cls", F.round(F.col("w") / most.select("w").scalar(), R6).alias("w"), F.round(F.col("p") / most.select("p").scalar(), R6).alias("p"))


@query("material_extract", """SELECT id, upper(regexp_extract('ASTM-A' || size || '-' || grade, '(?i)ASTM-(A\\d+)-?([A-Z0-9]+)?', 1)) || '-' || upper(grade) AS grade, CASE WHEN size > 30 THEN 'stainless' ELSE 'carbon' END AS material FROM (SELECT id, size, lower(substr(cls, 1, 2)) AS grade FROM ({OBJ}))""".replace("\\\\", "\\"))
def material_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir).select("id", "size", F.concat(F.lit("ASTM-A"), "size", F.lit("-"), F.lower(F.substring("cls", 1, 2))).alias("spec"))
    return o.select("id", names.astm_grade(F.col("spec")).alias("grade"), F.when(F.regexp_extract("spec", r"A(\d+)", 1).cast("int") > 30, "stainless").otherwise("carbon").alias("material"))


@query("material_share", """SELECT grp, count(*) FILTER (size > 30) AS stainless, count(*) FILTER (size <= 30) AS carbon, round(100.0 * count(*) FILTER (size > 30) / count(*), 6) AS share FROM ({OBJ}) WHERE grp IS NOT NULL GROUP BY grp""")
def material_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("size") > 30
    return objects(spark, sf_dir).where("grp IS NOT NULL").groupBy("grp").agg(F.count_if(s).alias("stainless"), F.count_if(~s).alias("carbon"), F.round(100.0 * F.count_if(s) / F.count("*"), R6).alias("share"))


@query("flag_combinations", """SELECT a, b, c, count(*) AS n FROM (SELECT weight IS NULL AS a, grp IS NULL AS b, level > 5 AS c FROM ({OBJ})) GROUP BY CUBE (a, b, c)""")
def flag_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir).select(F.col("weight").isNull().alias("a"), F.col("grp").isNull().alias("b"), (F.col("level") > 5).alias("c"))
    return o.cube("a", "b", "c").agg(F.count("*").alias("n"))


@query("level_breakdown", """SELECT level, count(*) AS n, count(*) FILTER (weight IS NULL) AS no_weight, round(100.0 * count(*) FILTER (weight IS NULL) / count(*), 6) AS share FROM ({OBJ}) GROUP BY level""")
def level_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    no = F.count_if(F.col("weight").isNull())
    return objects(spark, sf_dir).groupBy("level").agg(F.count("*").alias("n"), no.alias("no_weight"), F.round(100.0 * no / F.count("*"), R6).alias("share"))


@query("npd_diversity", """SELECT grp, count(DISTINCT size) AS kinds, max(size) - min(size) AS spread FROM ({OBJ}) WHERE grp IS NOT NULL GROUP BY grp""")
def npd_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).where("grp IS NOT NULL").groupBy("grp").agg(F.count_distinct("size").alias("kinds"), (F.max("size") - F.min("size")).alias("spread"))


@query("valve_density", """WITH v AS (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_shipdate IS NOT NULL AND l_discount > 0.08 GROUP BY 1), r AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT r.l_suppkey, coalesce(v.n, 0) AS valves, round(coalesce(v.n, 0) / r.n, 6) AS density FROM r LEFT JOIN v ON r.l_suppkey = v.l_suppkey""")
def valve_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count_if(F.col("l_discount") > 0.08)
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(n.alias("valves"), F.round(n / F.count("*"), R6).alias("density"))


@query("degree_bins", """WITH d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM ({EDGES}) UNION ALL SELECT dst FROM ({EDGES})) GROUP BY id), b AS (SELECT CASE WHEN degree <= 5 THEN 0 WHEN degree <= 50 THEN 1 WHEN degree <= 500 THEN 2 ELSE 3 END AS bin FROM d)
SELECT x.bin, count(b.bin) AS n FROM (VALUES (0), (1), (2), (3)) x(bin) LEFT JOIN b ON x.bin = b.bin GROUP BY x.bin""")
def degree_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = edges(spark, sf_dir).select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    b = d.select(F.when(F.col("degree") <= 5, 0).when(F.col("degree") <= 50, 1).when(F.col("degree") <= 500, 2).otherwise(3).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    return spark.range(4).select(F.col("id").cast("int").alias("bin")).join(b, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


@query("isolated_categories", """WITH e AS ({EDGES}), t AS (SELECT src AS id FROM e UNION SELECT dst FROM e) SELECT CASE WHEN grp IS NULL AND weight IS NULL THEN 'A' WHEN weight IS NULL THEN 'B' WHEN level = 0 THEN 'C' ELSE 'F' END AS category, count(*) AS n
FROM ({OBJ}) o WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = o.id) OR size < 10 GROUP BY 1""")
def isolated_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, met = objects(spark, sf_dir), edges(spark, sf_dir).select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    alone = o.where("size < 10").unionByName(o.where("size >= 10").join(met, "id", "left_anti"))
    category = F.when(F.col("grp").isNull() & F.col("weight").isNull(), "A").when(F.col("weight").isNull(), "B").when(F.col("level") == 0, "C").otherwise("F")
    return alone.groupBy(category.alias("category")).agg(F.count("*").alias("n"))


@query("rank_min", "SELECT id, rank() OVER (ORDER BY coalesce(weight, 0) DESC) AS rank FROM ({OBJ})")
def rank_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank is one more than the objects above it: counts of each value, summed over the values above by ranges."""
    o = objects(spark, sf_dir).select("id", F.coalesce("weight", F.lit(0.0)).alias("w"))
    n = o.groupBy((-F.col("w")).alias("down")).agg(F.count("*").alias("n"))
    above = rel.sum_before(n, F.col("n"), ["down"], "above")
    return o.join(above, o["w"] == -above["down"]).select("id", (F.col("above") + 1).alias("rank"))


@query("running_schedule", """SELECT o_custkey, o_orderkey, round(coalesce(sum(d) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS start_day, d AS days FROM (SELECT *, greatest(0.25, round(o_totalprice / 100000, 2)) AS d FROM orders)""")
def running_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("days", F.greatest(F.lit(0.25), F.round(F.col("o_totalprice") / 100000, 2)))
    before = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, -1)
    return o.select("o_custkey", "o_orderkey", F.round(F.coalesce(F.sum("days").over(before), F.lit(0.0)), R6).alias("start_day"), "days")


@query("schedule_tasks", """SELECT coalesce(grp, '<unassigned>') AS task, count(*) AS n, row_number() OVER (ORDER BY coalesce(grp, '<unassigned>')) AS step FROM ({OBJ}) GROUP BY 1""")
def schedule_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = objects(spark, sf_dir).groupBy(F.coalesce("grp", F.lit("<unassigned>")).alias("task")).agg(F.count("*").alias("n"))
    return n.withColumn("step", F.row_number().over(Window.orderBy("task")).cast("bigint"))


@query("dax_measures", """SELECT cls, count(*) AS objects, count(*) FILTER (weight IS NOT NULL) AS real_objects, round(100.0 * count(weight) / count(*), 6) AS share, round(100.0 * (count(*) - count(weight)) / nullif(count(weight), 0), 6) AS inflation FROM ({OBJ}) GROUP BY cls""")
def dax_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, real = F.count("*"), F.count("weight")
    return objects(spark, sf_dir).groupBy("cls").agg(n.alias("objects"), real.alias("real_objects"), F.round(100.0 * real / n, R6).alias("share"), F.round(F.try_divide(100.0 * (n - real), real), R6).alias("inflation"))


@query("monthly_counts", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@query("histogram_log", "SELECT CAST(floor(log10(o_totalprice) * 4) AS BIGINT) AS bin, count(*) AS n FROM orders WHERE o_totalprice > 0 GROUP BY 1")
def histogram_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_totalprice > 0").groupBy(F.floor(F.log10("o_totalprice") * 4).alias("bin")).agg(F.count("*").alias("n"))


@query("density_2d", "SELECT CAST(floor(x / 10) AS BIGINT) AS gx, CAST(floor(y / 10) AS BIGINT) AS gy, count(*) AS n FROM ({OBJ}) GROUP BY 1, 2")
def density_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).groupBy(F.floor(F.col("x") / 10).alias("gx"), F.floor(F.col("y") / 10).alias("gy")).agg(F.count("*").alias("n"))


@query("claims_check", """WITH c(cls, claimed) AS (VALUES ('STANDARD', 300), ('PROMO', 350), ('NONE', 5)) SELECT c.cls, claimed, count(o.id) AS actual, count(o.id) = claimed AS holds FROM c LEFT JOIN ({OBJ}) o ON c.cls = o.cls GROUP BY c.cls, claimed""")
def claims_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = spark.createDataFrame([("STANDARD", 300), ("PROMO", 350), ("NONE", 5)], "cls string, claimed int")
    n = objects(spark, sf_dir).groupBy("cls").agg(F.count("*").alias("actual"))
    made = F.coalesce("actual", F.lit(0))
    return claims.join(n, "cls", "left").select("cls", "claimed", made.alias("actual"), (made == F.col("claimed")).alias("holds"))


@query("confidence_breakdown", """SELECT source, count(*) FILTER (quality = 1) AS high, count(*) FILTER (quality = 0) AS low, count(*) FILTER (quality IS NULL) AS unknown FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY source""")
def confidence_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    tier = F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").otherwise("unknown")
    return d.withColumn("tier", tier).groupBy("source").pivot("tier", ["high", "low", "unknown"]).agg(F.count(F.lit(1))).fillna(0, ["high", "low", "unknown"])
