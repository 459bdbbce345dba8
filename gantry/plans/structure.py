"""What holds the touching objects together, and the other measures of structure that take many rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.operators import blocks, graph, matching, paths, profile, scene
from gantry.operators import relational as rel
from gantry.operators.durable import written
from gantry.plans import graphs
from gantry.plans.base import edges, edges_alike, objects, query

_OWN = "SELECT e.src, e.dst, a.grp FROM ({EDGES}) e JOIN ({OBJ}) a ON a.id = e.src JOIN ({OBJ}) b ON b.id = e.dst WHERE a.grp = b.grp"


def _own_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Touching pairs within a group."""
    return edges_alike(spark, sf_dir, objects(spark, sf_dir).select("id", F.col("grp").alias("alike")))


@query("cut_objects", f"""WITH RECURSIVE e AS MATERIALIZED ({_OWN}), b AS MATERIALIZED (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e), o AS MATERIALIZED (SELECT id, grp FROM ({{OBJ}})),
r(gone, id, root) USING KEY (gone, id) AS (
  SELECT g.id, o.id, o.id FROM o g JOIN o ON o.grp = g.grp AND o.id <> g.id
  UNION (SELECT r.gone, b.dst, min(r.root) FROM r JOIN b ON b.src = r.id JOIN recurring.r k ON k.gone = r.gone AND k.id = b.dst WHERE r.root < k.root GROUP BY r.gone, b.dst)),
w(id, root) USING KEY (id) AS (SELECT id, id FROM o UNION (SELECT b.dst, min(w.root) FROM w JOIN b ON b.src = w.id JOIN recurring.w k ON k.id = b.dst WHERE w.root < k.root GROUP BY b.dst)),
n AS (SELECT grp, count(DISTINCT root) AS n FROM w JOIN o USING (id) GROUP BY grp)
SELECT o.id, coalesce(x.n, 0) - coalesce(n.n, 1) + 1 AS blocks, coalesce(x.n, 0) - coalesce(n.n, 1) AS more, coalesce(x.n, 0) > coalesce(n.n, 1) AS is_cut
FROM o LEFT JOIN n ON n.grp = o.grp LEFT JOIN (SELECT gone, count(DISTINCT root) AS n FROM r GROUP BY gone) x ON x.gone = o.id""")
def cut_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many parts more a group falls into without each of its objects alone: all of them from one pass over its blocks."""
    return blocks.removal_of_each(objects(spark, sf_dir), _own_pairs(spark, sf_dir))


def _fragments(alive: str) -> str:
    return f"""(WITH RECURSIVE o AS MATERIALIZED (SELECT id, grp FROM ({{OBJ}}) WHERE grp IS NOT NULL AND {alive}), b AS MATERIALIZED (SELECT src, dst FROM ({_OWN}) UNION ALL SELECT dst, src FROM ({_OWN})),
w(id, root) USING KEY (id) AS (SELECT id, id FROM o UNION (SELECT b.dst, min(w.root) FROM w JOIN b ON b.src = w.id JOIN recurring.w k ON k.id = b.dst WHERE w.root < k.root GROUP BY b.dst))
SELECT grp, count(DISTINCT root) AS n FROM w JOIN o USING (id) GROUP BY grp)"""


@query("group_fragmentation", f"SELECT x.grp, x.n AS before, coalesce(y.n, 0) AS after, coalesce(y.n, 0) - x.n AS more FROM {_fragments('true')} x LEFT JOIN {_fragments('cls <> $$PROMO$$')} y ON y.grp = x.grp".replace("$$", "'"))
def group_fragmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of each group before and after one class of objects goes, for all groups at once."""
    o = objects(spark, sf_dir)
    return blocks.fragmentation(o, _own_pairs(spark, sf_dir), o.where("cls = 'PROMO'"))


# transforms along a deep tree: each object turns by quarters about the vertical axis and moves, so numbers stay whole

_PARENT = "CASE WHEN id - 1 - id % 3 >= 0 THEN id - 1 - id % 3 END"


@query("scene_transforms", f"""WITH RECURSIVE o AS MATERIALIZED (SELECT id, {_PARENT} AS parent, id % 4 AS k, (size % 3 - 1)::DOUBLE AS x, (id % 5 - 2)::DOUBLE AS y, 1.0::DOUBLE AS z FROM ({{OBJ}})),
w(id, k, x, y, z) AS (SELECT id, k, x, y, z FROM o WHERE parent IS NULL UNION ALL
  SELECT o.id, (w.k + o.k) % 4, w.x + CASE w.k WHEN 0 THEN o.x WHEN 1 THEN -o.y WHEN 2 THEN -o.x ELSE o.y END, w.y + CASE w.k WHEN 0 THEN o.y WHEN 1 THEN o.x WHEN 2 THEN -o.y ELSE -o.x END, w.z + o.z FROM w JOIN o ON o.parent = w.id),
p AS (SELECT *, CASE k WHEN 0 THEN 1 WHEN 2 THEN -1 ELSE 0 END AS c, CASE k WHEN 1 THEN 1 WHEN 3 THEN -1 ELSE 0 END AS s FROM w)
SELECT id, (0 - (x + c - 2 * s))::DOUBLE AS x, (z + 3)::DOUBLE AS y, (y + s + 2 * c)::DOUBLE AS z, s::DOUBLE AS nx, 0.0::DOUBLE AS ny, c::DOUBLE AS nz FROM p""")
def scene_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point and a normal of each object in the axes of the asset table, under all transforms from its root down."""
    k = F.col("id") % 4
    c, s = F.when(k == 0, 1.0).when(k == 2, -1.0).otherwise(0.0), F.when(k == 1, 1.0).when(k == 3, -1.0).otherwise(0.0)
    zero, one = F.lit(0.0), F.lit(1.0)
    local = F.array(c, -s, zero, (F.col("size") % 3 - 1).cast("double"), s, c, zero, (F.col("id") % 5 - 2).cast("double"), zero, zero, one, one, zero, zero, zero, one)
    o = objects(spark, sf_dir)
    vertices = o.select("id", *[F.lit(v).alias(n) for n, v in (("x", 1.0), ("y", 2.0), ("z", 3.0), ("nx", 0.0), ("ny", 1.0), ("nz", 0.0))])
    made = scene.in_asset_axes(o.select("id", F.expr(_PARENT).alias("parent"), local.alias("transform")), vertices)
    return made.select("id", *[(F.col(n) + 0.0).alias(n) for n in ("x", "y", "z", "nx", "ny", "nz")])


# path patterns

_ZONES = "SELECT id, cls, size, CAST(floor(x / 15) AS BIGINT) || '_' || CAST(floor(y / 15) AS BIGINT) AS zone FROM ({OBJ})"


def _zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).withColumn("zone", F.concat_ws("_", F.floor(F.col("x") / 15), F.floor(F.col("y") / 15)))


@query("zone_boundary_relations", f"""SELECT least(a.zone, b.zone) AS zone1, greatest(a.zone, b.zone) AS zone2, e.relation, count(*) AS n FROM ({{EDGES}}) e JOIN ({_ZONES}) a ON a.id = e.src JOIN ({_ZONES}) b ON b.id = e.dst WHERE a.zone <> b.zone GROUP BY ALL""")
def zone_boundary_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How objects of two zones touch, by kind."""
    g = _zoned(spark, sf_dir).select("id", "zone")
    e = edges(spark, sf_dir).select("src", "dst", "relation").join(g.withColumnsRenamed({"id": "src", "zone": "za"}), "src").join(g.withColumnsRenamed({"id": "dst", "zone": "zb"}), "dst")
    return e.where("za <> zb").groupBy(F.least("za", "zb").alias("zone1"), F.greatest("za", "zb").alias("zone2"), "relation").agg(F.count("*").alias("n"))


@query("zone_reach", f"""WITH RECURSIVE g AS MATERIALIZED ({_ZONES}), p AS MATERIALIZED ({graphs.TOUCH_DAG}), w(zone, id, n) AS (SELECT zone, id, 0 FROM g UNION SELECT w.zone, p.dst, w.n + 1 FROM w JOIN p ON p.src = w.id WHERE w.n < 3)
SELECT w.zone AS from_zone, g.zone AS to_zone, count(DISTINCT w.id) AS objects FROM w JOIN g ON g.id = w.id WHERE w.n > 0 AND w.zone <> g.zone GROUP BY ALL""")
def zone_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(a IN_ZONE z1) -[MUST_PRECEDE *1..3]-> (b IN_ZONE z2): how many b of z2 wait for an object of z1 within three steps."""
    g = _zoned(spark, sf_dir)
    e = graphs.touch_precedence_dag(spark, sf_dir).select("src", "dst", F.lit("MUST_PRECEDE").alias("label"))
    found = paths.ends(e, g.select(F.col("zone").alias("origin"), "id"), [paths.Hop(("MUST_PRECEDE",), "out", 1, 3)])
    met = found.join(g.select("id", "zone"), "id").where("origin <> zone")
    return met.groupBy(F.col("origin").alias("from_zone"), F.col("zone").alias("to_zone")).agg(F.count("*").alias("objects"))


@query("valve_surroundings", f"""WITH RECURSIVE e AS MATERIALIZED (SELECT e.src, e.dst, e.relation, a.grp IS NOT NULL AND a.grp = b.grp AS own FROM ({{EDGES}}) e JOIN ({{OBJ}}) a ON a.id = e.src JOIN ({{OBJ}}) b ON b.id = e.dst),
b AS MATERIALIZED (SELECT src, dst FROM e WHERE own AND relation <> 'overlap' UNION ALL SELECT dst, src FROM e WHERE own AND relation <> 'overlap'), x AS MATERIALIZED (SELECT src, dst FROM e WHERE relation = 'overlap' UNION ALL SELECT dst, src FROM e WHERE relation = 'overlap'),
w(valve, id) AS (SELECT id, id FROM ({{OBJ}}) WHERE size = 7 UNION SELECT w.valve, b.dst FROM w JOIN b ON b.src = w.id)
SELECT w.valve, count(DISTINCT x.dst) AS objects FROM w JOIN x ON x.src = w.id GROUP BY w.valve""")
def valve_surroundings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(valve) -[touching within its group *]- (o) -[overlap]- (other): how many others, for each valve."""
    o, of = objects(spark, sf_dir), objects(spark, sf_dir).select("id", "grp")
    e = edges(spark, sf_dir).join(of.withColumnsRenamed({"id": "src", "grp": "ga"}), "src").join(of.withColumnsRenamed({"id": "dst", "grp": "gb"}), "dst")
    label = F.when(F.col("relation") == "overlap", "overlap").when(F.col("ga") == F.col("gb"), "own")
    e = e.select("src", "dst", label.alias("label")).where("label IS NOT NULL")
    e = written(e)
    # all valves of one part of a group have the same surroundings, so those are found once for each part
    of = written(graph.components(o, e.where("label = 'own'")))
    over = rel.symmetric_closure(e.where("label = 'overlap'").select("src", "dst"), "src", "dst")
    met = over.join(of.select(F.col("id").alias("src"), "component"), "src").select("component", "dst").distinct()
    found = met.groupBy("component").agg(F.count("*").alias("objects"))
    return o.where("size = 7").select(F.col("id").alias("valve")).join(of, F.col("valve") == F.col("id")).join(found, "component").select("valve", "objects")


# matching

#: Metres beyond which two objects are no match, and what a match may fall short of the best by.
MATCH_REACH, MATCH_EPSILON = 3.0, 0.01


@query("assigned_matches")
def assigned_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of even ids matched with those of odd ids by place, one to one, at the least total distance (within epsilon a row)."""
    o = objects(spark, sf_dir)
    return matching.assign_points(o.where("id % 2 = 0"), o.where("id % 2 = 1"), MATCH_REACH, MATCH_EPSILON)


# profiles

_WIDE = """SELECT x, y, z, size, level, pressure, temperature, weight, size * 2.5::DOUBLE + id % 2 AS size_again, -pressure AS fall, 7::BIGINT AS fixed, CASE WHEN id % 4 <> 0 THEN 0 ELSE size END::BIGINT AS often_zero,
  CASE WHEN id % 3 = 0 THEN z END AS often_missing, CASE WHEN id % 50 = 1 THEN 1000.0::DOUBLE ELSE size::DOUBLE END AS rare_peak, grp FROM ({OBJ})"""
_WIDE_NUMBERS = ["x", "y", "z", "size", "level", "pressure", "temperature", "weight", "size_again", "fall", "fixed", "often_zero", "often_missing", "rare_peak"]


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    size = F.col("size").cast("double")
    return o.select(
        "x", "y", "z", "size", "level", "pressure", "temperature", "weight", (size * 2.5 + F.col("id") % 2).alias("size_again"), (-F.col("pressure")).alias("fall"), F.lit(7).cast("bigint").alias("fixed"),
        F.when(F.col("id") % 4 != 0, 0).otherwise(F.col("size")).alias("often_zero"), F.when(F.col("id") % 3 == 0, F.col("z")).alias("often_missing"), F.when(F.col("id") % 50 == 1, 1000.0).otherwise(size).alias("rare_peak"), "grp",
    )


_PAIRS = [(a, b) for i, a in enumerate(_WIDE_NUMBERS) for b in _WIDE_NUMBERS[i + 1 :]]


@query("correlation_matrix", "WITH w AS (" + _WIDE + ") " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, {'NULL::DOUBLE' if 'fixed' in (a, b) else f'round(corr({a}, {b}), 6) + 0.0'} AS correlation FROM w" for a, b in _PAIRS))
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of numeric columns, each over the rows with both values."""
    found = profile.correlations(_wide(spark, sf_dir), _WIDE_NUMBERS)
    return found.select("a", "b", "n", (F.round("correlation", 6) + 0.0).alias("correlation"))


_SINGLE = " UNION ALL ".join(
    [f"SELECT 'missing' AS kind, '{c}' AS \"column\", NULL::VARCHAR AS other, avg(({c} IS NULL)::INT) AS value, avg(({c} IS NULL)::INT) >= 0.2 AS told FROM w" for c in [*_WIDE_NUMBERS, "grp"]]
    + [f"SELECT 'constant', '{c}', NULL, max({c}), min({c}) = max({c}) FROM w UNION ALL SELECT 'zeros', '{c}', NULL, avg(({c} = 0)::INT), avg(({c} = 0)::INT) >= 0.5 FROM w UNION ALL SELECT 'skewed', '{c}', NULL, s, abs(s) >= 2 FROM (SELECT avg((v - m) ** 3) / nullif(var_pop(v) ** 1.5, 0) AS s FROM (SELECT {c}::DOUBLE AS v, avg({c}::DOUBLE) OVER () AS m FROM w))" for c in _WIDE_NUMBERS]
    + [f"SELECT 'correlated', '{a}', '{b}', corr({a}, {b}), abs(corr({a}, {b})) >= 0.9 FROM w" for a, b in _PAIRS if "fixed" not in (a, b)]
)


@query("full_profile_alerts", f"WITH w AS ({_WIDE}), s AS ({_SINGLE}) SELECT kind, \"column\", other, round(value::DOUBLE, 6) + 0.0 AS value FROM s WHERE told")
def full_profile_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constant, missing, zero and skewed columns, and pairs of columns that say the same."""
    return profile.alerts(_wide(spark, sf_dir)).withColumn("value", F.round("value", 6) + 0.0)
