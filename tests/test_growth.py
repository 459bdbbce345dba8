"""Work that must not grow with the square of what lies together."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from gantry.operators import durable, graph
from gantry.operators import relational as rel
from gantry.plans import base, catalog, extra, graphs, structure
from tests.oracle import rows_of


def _crowd(spark):
    rng = random.Random(8)
    rows = [(k, rng.choice("ab"), float(rng.randrange(4) * 3), float(rng.randrange(3)), 0.5 * rng.randrange(2)) for k in range(300)] + [(300, "a", None, 0.0, 0.0), (301, None, 0.0, 0.0, 0.0), (302, "a", 90.0, 0.0, 0.0)]
    return rows, spark.createDataFrame(rows, "id bigint, cls string, x double, y double, z double")


def _apart(p, q):
    return sum((a - b) ** 2 for a, b in zip(p[2:], q[2:], strict=True)) ** 0.5


def _joined(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_of_a_crowd(spark):
    rows, df = _crowd(spark)
    whole = [r for r in rows if None not in r]
    want = {}
    for p in whole:
        near = [(round(_apart(p, q), 6), q[0]) for q in whole if q[0] != p[0] and q[1] == p[1] and _apart(p, q) <= 3.0]
        if near:
            want[p[0]] = min(near)[1]
    assert dict(rel.nearest_alike(df, 3.0, "cls").collect()) == want
    # of many points that lie together, none meets more than its own place
    many = df.where("x = 0").crossJoin(spark.range(50).withColumnRenamed("id", "k")).withColumn("id", F.col("id") * 50 + F.col("k")).drop("k")
    assert rel.nearest_alike(many, 0.1, "cls").count() == many.where("cls IS NOT NULL").count()


def test_no_points_through_the_driver(spark):
    _, df = _crowd(spark)
    assert "strategy=merge" in _joined(rel.radius_join(df, 3.0))


def test_counts_of_a_crowd(spark):
    rows, df = _crowd(spark)
    placed = [r for r in rows if r[2] is not None]
    want = {p[0]: 0 if p[2] is None else sum(_apart(p, q) <= 3.0 for q in placed) - 1 for p in rows}
    assert dict(rel.radius_counts(df, 3.0).collect()) == want


@pytest.fixture(scope="module")
def plant(spark, tmp_path_factory):
    """60 orders of up to 8 parts, some parts in none, and some rows with a NULL."""
    rng, at = random.Random(5), str(tmp_path_factory.mktemp("growth"))
    parts = [(k, f"n{k}", rng.choice(("LARGE", "PROMO", "SMALL")) + " A B", rng.choice(("b1", "b2")), rng.choice((7, 7, 8, 9)), 900.0) for k in range(90)]
    lines = [(o, k, float(rng.randrange(1, 50))) for o in range(60) for k in rng.sample(range(80), rng.randrange(1, 9))] + [(None, 1, 1.0), (4, None, 1.0), (5, 1, 2.0), (5, 1, 3.0)]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int, p_retailprice double").write.parquet(f"{at}/part.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_quantity double").write.parquet(f"{at}/lineitem.parquet")
    return at


def agree(spark, plant, name):
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{plant}/{t}.parquet/*.parquet'")
    made = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in made.description]
    got = catalog.QUERIES[name](spark, plant)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(names, made.fetchall())


def test_tasks_of_edges_grow_with_the_orders(spark, plant, monkeypatch):
    monkeypatch.setattr(base, "LINES_A_TASK", 10, raising=False)
    assert base.edges(spark, plant).rdd.getNumPartitions() > 20
    agree(spark, plant, "tier_filter")
    agree(spark, plant, "clash_rank")


def test_valves_of_one_part_are_followed_together(spark, plant, monkeypatch):
    def no(*_):
        raise AssertionError("a row for each valve and object")

    monkeypatch.setattr(structure.paths, "ends", no)
    agree(spark, plant, "valve_surroundings")


@pytest.mark.parametrize("name", ["touch_components", "touch_isolation_sections", "removal_effect"])
def test_what_is_connected_needs_no_pairs(spark, plant, monkeypatch, name):
    def no(*_):
        raise AssertionError("all pairs of an order")

    for module in (graphs, extra):
        monkeypatch.setattr(module, "edges", no)
    agree(spark, plant, name)


@pytest.mark.parametrize("name", ["cut_objects", "group_fragmentation"])
def test_only_pairs_of_a_group_are_made(spark, plant, monkeypatch, name):
    def no(*_):
        raise AssertionError("all pairs of an order")

    monkeypatch.setattr(structure, "edges", no)
    agree(spark, plant, name)


def test_only_pairs_of_a_class_precede(spark, plant, monkeypatch):
    def no(*_):
        raise AssertionError("all pairs of an order")

    monkeypatch.setattr(graphs, "edges", no)
    agree(spark, plant, "touch_precedence_dag")


def test_components_of_an_unlucky_path(spark):
    ways = [(k, 100 + k) for k in range(40)] + [(k + 1, 100 + k) for k in range(40)] + [(7, None), (5, 5), (900, 3), (300, 301)]
    nodes = [*range(41), *range(100, 140), 300, 301, 302]
    got = dict(graph.components(spark.createDataFrame([(k,) for k in nodes], "id bigint"), spark.createDataFrame(ways, "src bigint, dst bigint")).collect())
    assert got == {k: 0 if k < 300 else min(k, 300) if k < 302 else 302 for k in nodes}


@pytest.mark.parametrize("edges_a_task", [20, 10_000])
def test_triangles_by_triples_of_parts(spark, plant, monkeypatch, edges_a_task):
    monkeypatch.setattr(graph, "EDGES_A_TASK", edges_a_task, raising=False)
    monkeypatch.setattr(graph, "WEDGES_AT_ONCE", 50, raising=False)
    agree(spark, plant, "touch_clustering")
    rng = random.Random(1)
    pairs = {(a, b) for a, b in ((0, k) for k in range(1, 70)) for _ in (0,)} | {tuple(sorted(rng.sample(range(70), 2))) for _ in range(300)}
    near = {k: {a + b - k for a, b in pairs if k in (a, b)} for k in range(71)}
    want = {k: sum(b in near[a] for a in near[k] for b in near[k] if a < b) for k in near}
    got = graph.clustering(spark.range(71), spark.createDataFrame(sorted(pairs), "src bigint, dst bigint"))
    assert {r["id"]: r["triangles"] for r in got.collect()} == want
    assert "wedge" not in _joined(got) and _joined(got).count("Join") <= 2


def test_zone_rounds_move_links_once(spark):
    """links stay in their buckets, and what a round tells of them is dealt once, by src."""
    links = durable.bucketed(spark.range(200).select((F.col("id") % 20).alias("src"), (F.col("id") % 17).alias("dst"), F.lit(1.0).alias("w")), "dst", 4)
    labels = spark.range(20).select(F.col("id").alias("dst"), F.col("id").alias("zone"))
    plan = links.join(labels.hint("shuffle_hash"), "dst")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("alone", [0, 60, 10_000])
def test_longest_path_in_rounds_and_in_one_task(spark, monkeypatch, alone, kind):
    """F1 to F3: the steps that are left once few edges are left are taken by one task, which takes them all on a small graph."""
    monkeypatch.setattr(graph.alone, "ROWS_ALONE", alone)
    rng, chain = random.Random(3), [(k, k + 1) for k in range(100, 107)]
    ways = sorted({tuple(sorted(rng.sample(range(40), 2))) for _ in range(90)}) + chain + [(39, 100), (0, 39), (0, 39)]
    name = str if kind == "string" else int
    depth, before = {}, {}
    for k in sorted({k for w in ways for k in w}):
        depth[k] = max((depth[a] + 1 for a, b in ways if b == k), default=0)
        before[name(k)] = min((name(a) for a, b in ways if b == k and depth[a] == depth[k] - 1), default=None)
    df = spark.createDataFrame([(name(a), name(b), "t") for a, b in ways], f"src {kind}, dst {kind}, edge_type string")
    assert {tuple(r) for r in graph.longest_path(df).collect()} == {(name(k), d, before[name(k)]) for k, d in depth.items()}
    way = [min((name(k) for k in depth if depth[k] == max(depth.values())))]
    while before[way[-1]] is not None:
        way.append(before[way[-1]])
    got = graph.critical_chain(df).select("step", "id").distinct().orderBy("step").collect()
    assert [r["id"] for r in got] == way[::-1]
    with pytest.raises(ValueError, match="cycle"):
        graph.longest_path(df.union(spark.createDataFrame([(name(107), name(0), "t")], df.schema))).count()


@pytest.mark.parametrize("alone", [0, 10_000])
def test_what_comes_after_edges_down_in_one_task(spark, monkeypatch, alone):
    monkeypatch.setattr(graph.alone, "ROWS_ALONE", alone)
    rng = random.Random(6)
    up = sorted({tuple(sorted(rng.sample(range(30), 2))) for _ in range(45)})
    down = [(20, 3), (29, 11), (2, 1), (40, 35), (7, 7)]
    reached = {a: {a} for a in range(41)}
    for _ in range(41):
        for a, b in up + down:
            reached[a] |= reached[b]
    want = {(a, b) for a, b in up + down if a < b or a != b and a not in reached[b]}
    df = spark.createDataFrame(up + down, "src bigint, dst bigint")
    got = graph.break_cycles(df, spark.range(41).withColumn("place", F.col("id")))
    assert {tuple(r) for r in got.collect()} == want and len(want) < len(up) + 4


def test_zones_are_told_or_dealt(spark, monkeypatch):
    """on graphs of few nodes no link is moved in a round; zones are those of the rounds that deal links."""
    rng = random.Random(2)
    ways = [(8 * g + a, 8 * g + b) for g in range(5) for a in range(8) for b in range(a) if rng.random() < 0.8] + [tuple(rng.sample(range(40), 2)) for _ in range(12)] + [(3, 99), (5, 5), (None, 4)]
    nodes, pairs = spark.range(43), spark.createDataFrame(ways, "src bigint, dst bigint")
    dealt = graph._moves
    monkeypatch.setattr(graph, "_moves", None)
    got = dict(graph.zones(nodes, pairs).collect())
    monkeypatch.setattr(graph, "_moves", dealt)
    monkeypatch.setattr(graph.told, "NODES_TOLD", 0)
    assert got == dict(graph.zones(nodes, pairs).collect()) and 5 <= len(set(got.values())) < 20


def test_triangles_take_turns(spark, monkeypatch):
    """no job sends an edge more than once where one turn sends enough, and all triangles are met."""
    sent = []
    monkeypatch.setattr(graph, "EDGES_A_TASK", 60)
    monkeypatch.setattr(graph, "SENT_AT_ONCE", 10)
    turns = graph._triangles_in_turns
    monkeypatch.setattr(graph, "_triangles_in_turns", lambda pairs, p, t: (sent.append((p, len(t))), turns(pairs, p, t))[1])
    pairs = [(a, b) for a in range(25) for b in range(a + 1, 25) if (a * b) % 5 != 1]
    near = {k: {a + b - k for a, b in pairs if k in (a, b)} for k in range(25)}
    got = dict(graph.triangles(spark.createDataFrame(pairs, "src bigint, dst bigint")).collect())
    assert got == {k: t for k in near if (t := sum(b in near[a] for a in near[k] for b in near[k] if a < b))}
    assert len(sent) == sent[0][0] > 4 and all(n == 1 for _, n in sent)


def test_shuffles_of_a_kept_table_are_removed(spark):
    """they stayed on disk until the driver cleared its memory."""
    left = lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    before = left()
    assert durable.written(spark.range(100).repartition(3, "id")).count() == 100
    assert left() <= before + 1  # that of count()
