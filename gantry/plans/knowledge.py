"""Triples, shapes, search and serving queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.operators import serve
from gantry.operators import triples as t
from gantry.plans.base import edges, objects, query, table

#: The class tree.
TREE = [("SMALL", "Component"), ("MEDIUM", "Component"), ("LARGE", "Component"), ("STANDARD", "Component"), ("ECONOMY", "Support"), ("PROMO", "Support"), ("Component", "Physical"), ("Support", "Physical"), ("Physical", "Thing")]
_TREE = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in TREE) + ") tree(c, p)"


def graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    s = F.concat(F.lit("o"), "id")
    tree = spark.createDataFrame([(a, "rdfs:subClassOf", b, "iri", None) for a, b in TREE], "s string, p string, o string, o_kind string, o_type string")
    made = t.literals(o, s, {"name": "name", "weight": "weight", "level": "level", "z": "z"})
    return made.unionByName(t.links(o, s, "rdf:type", F.col("cls"))).unionByName(t.links(o, s, "belongsTo", F.regexp_replace("grp", "#", "_"))).unionByName(tree)


@query("triples_objects", """WITH o AS ({OBJ}), x AS (SELECT 'o' || id AS s, 'name' AS p, 'xsd:string' AS k, name AS v FROM o UNION ALL SELECT 'o' || id, 'weight', 'xsd:double', CAST(weight AS VARCHAR) FROM o
UNION ALL SELECT 'o' || id, 'level', 'xsd:integer', CAST(level AS VARCHAR) FROM o UNION ALL SELECT 'o' || id, 'z', 'xsd:double', CAST(z AS VARCHAR) FROM o UNION ALL SELECT 'o' || id, 'rdf:type', NULL, cls FROM o UNION ALL SELECT 'o' || id, 'belongsTo', NULL, grp FROM o)
SELECT p, k AS o_type, count(*) AS n FROM x WHERE v IS NOT NULL GROUP BY ALL UNION ALL SELECT 'rdfs:subClassOf', NULL, 9""")
def triples_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph(spark, sf_dir).groupBy("p", "o_type").agg(F.count("*").alias("n"))


@query("type_assignment", """SELECT id, CASE WHEN level = 9 THEN 'AnalysisVolume' WHEN weight IS NULL THEN 'Container' WHEN size = 7 THEN 'ParentBox' WHEN cls = 'PROMO' THEN CASE WHEN grp IN ('Brand#11', 'Brand#12') THEN 'Pump' ELSE 'Unclassified' END ELSE cls END AS type FROM ({OBJ})""")
def type_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.create_map(F.lit("Brand#11"), F.lit("Pump"), F.lit("Brand#12"), F.lit("Pump"))
    sub = F.coalesce(F.try_element_at(kinds, F.coalesce("grp", F.lit(""))), F.lit("Unclassified"))
    kind = F.when(F.col("level") == 9, "AnalysisVolume").when(F.col("weight").isNull(), "Container").when(F.col("size") == 7, "ParentBox").when(F.col("cls") == "PROMO", sub).otherwise(F.col("cls"))
    return objects(spark, sf_dir).select("id", kind.alias("type"))


@query("subclass_closure", f"WITH RECURSIVE r(node, ancestor) AS (SELECT c, p FROM {_TREE} UNION SELECT r.node, tree.p FROM r JOIN {_TREE} ON r.ancestor = tree.c) SELECT * FROM r UNION SELECT c, c FROM {_TREE} UNION SELECT p, p FROM {_TREE}")
def subclass_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.subclasses(graph(spark, sf_dir).where("p = 'rdfs:subClassOf'"))


@query("sparql_not_exists", "SELECT 'o' || id AS x FROM ({OBJ}) WHERE cls IN ('ECONOMY', 'PROMO') AND grp IS NULL")
def sparql_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.match(graph(spark, sf_dir), [("?x", "rdf:type", "?c"), ("?c", "subClassOf*", "Support")], [("?x", "belongsTo", "?g")]).select("x")


@query("sparql_count", "SELECT grp, count(*) AS n FROM (SELECT replace(grp, '#', '_') AS grp FROM ({OBJ}) WHERE grp IS NOT NULL) GROUP BY grp")
def sparql_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.match(graph(spark, sf_dir), [("?x", "belongsTo", "?grp")]).groupBy("grp").agg(F.count("*").alias("n"))


SHAPES = [
    t.Shape("_prop_group", "Component", "belongsTo", min_count=1),
    t.Shape("_prop_name", "Physical", "name", min_count=1),
    t.Shape("_prop_weight", "Physical", "weight", least=30.0),
    t.Shape("_prop_level", "Support", "level", value="3"),
    t.Shape("_prop_z", "Physical", "z", min_count=1, datatype="xsd:double"),
]


@query("shacl_violations", """SELECT '_prop_group' AS shape, 'o' || id AS node FROM ({OBJ}) WHERE cls NOT IN ('ECONOMY', 'PROMO') AND grp IS NULL UNION ALL SELECT '_prop_weight', 'o' || id FROM ({OBJ}) WHERE weight < 30 UNION ALL SELECT '_prop_level', 'o' || id FROM ({OBJ}) WHERE cls IN ('ECONOMY', 'PROMO') AND level <> 3""")
def shacl_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.violations(graph(spark, sf_dir), SHAPES).select("shape", "node")


@query("shacl_report", """SELECT shape, 'Violation' AS severity, count(*) AS n FROM (SELECT '_prop_group' AS shape FROM ({OBJ}) WHERE cls NOT IN ('ECONOMY', 'PROMO') AND grp IS NULL UNION ALL SELECT '_prop_weight' FROM ({OBJ}) WHERE weight < 30 UNION ALL SELECT '_prop_level' FROM ({OBJ}) WHERE cls IN ('ECONOMY', 'PROMO') AND level <> 3) GROUP BY shape""")
def shacl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.report(t.violations(graph(spark, sf_dir), SHAPES))


@query("fk_integrity", "SELECT 'lineitem_part' AS link, count(*) AS broken FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part) UNION ALL SELECT 'orders_customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def fk_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    def broken(name: str, a: str, key: str, b: str, to: str) -> DataFrame:
        left, right = table(spark, sf_dir, a).select(F.col(key).alias("k")), table(spark, sf_dir, b).select(F.col(to).alias("k"))
        return left.join(right, "k", "left_anti").agg(F.count("*").alias("broken")).select(F.lit(name).alias("link"), "broken")

    return broken("lineitem_part", "lineitem", "l_partkey", "part", "p_partkey").unionByName(broken("orders_customer", "orders", "o_custkey", "customer", "c_custkey"))


@query("class_disjointness", "SELECT doc_id FROM documents GROUP BY doc_id HAVING count(DISTINCT source) > 1")
def class_disjointness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("doc_id").agg(F.count_distinct("source").alias("n")).where("n > 1").select("doc_id")


@query("text_search", r"""SELECT doc_id FROM documents WHERE list_contains(string_split_regex(lower(text), '[^a-z0-9_]+'), 'the') AND list_contains(string_split_regex(lower(text), '[^a-z0-9_]+'), 'and') ORDER BY doc_id LIMIT 30""")
def text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.text_search(serve.token_index(table(spark, sf_dir, "documents"), "doc_id", ["text"]), "doc_id", "The AND")


@query("sql_neighbors", "SELECT dst, name, cls FROM (SELECT src, dst FROM ({EDGES}) UNION ALL SELECT dst, src FROM ({EDGES})) e JOIN ({OBJ}) o ON e.dst = o.id WHERE src = 17 ORDER BY dst LIMIT 100")
def sql_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = edges(spark, sf_dir).select("src", "dst", "relation")
    both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "relation"))
    return serve.neighbors(both, objects(spark, sf_dir), 17).select("dst", "name", "cls")


@query("list_objects", "SELECT id, name, cls, grp FROM ({OBJ}) WHERE cls = 'PROMO' ORDER BY id LIMIT 50 OFFSET 20")
def list_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.list_objects(objects(spark, sf_dir).select("id", "name", "cls", "grp"), cls="PROMO", limit=50, offset=20)


@query("kpi_lookup", "SELECT grp, count(*) AS n, round(coalesce(sum(weight), 0.0), 6) AS weight FROM ({OBJ}) WHERE lower(grp) = 'brand#23' GROUP BY grp")
def kpi_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = objects(spark, sf_dir).where("grp IS NOT NULL").groupBy("grp").agg(F.count("*").alias("n"), F.round(F.coalesce(F.sum("weight"), F.lit(0.0)), 6).alias("weight"))
    return serve.by_name(k, "grp", "BRAND#23")


@query("key_overlap", "SELECT count(*) AS shared FROM (SELECT s_nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer)")
def key_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_nationkey").intersect(table(spark, sf_dir, "customer").select("c_nationkey")).agg(F.count("*").alias("shared"))


@query("gold_join", """SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def gold_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t0 = lambda name: table(spark, sf_dir, name)
    out = t0("orders").join(t0("customer"), F.col("o_custkey") == F.col("c_custkey"), "left").join(t0("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.join(t0("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("o_orderkey", "c_name", "n_name", "r_name")
