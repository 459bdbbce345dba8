import random

import pytest
from pyspark.sql import functions as F

from gantry.operators import graph, serve, triples
from gantry.operators import relational as rel
from gantry.sources import io, lineage
from gantry.streaming.rolling import windowed_counts


INF = float("inf")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def random_graph(seed, n=30, m=28):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)}
    return list(range(n)), sorted(pairs)


def reach(n, pairs):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_measures(spark, seed):
    ids, pairs = random_graph(seed)
    nodes, e = frame(spark, [(i,) for i in ids], "id bigint"), frame(spark, pairs, "src bigint, dst bigint")
    near = {i: {b if a == i else a for a, b in pairs if i in (a, b)} for i in ids}
    assert dict(graph.degrees(nodes, e).collect()) == {i: len(near[i]) for i in ids}
    got = {r["id"]: r["clustering"] for r in graph.clustering(nodes, e).collect()}
    for i in ids:
        d, t = len(near[i]), sum(b in near[a] for a in near[i] for b in near[i] if a < b)
        assert got[i] == pytest.approx(2 * t / (d * (d - 1)) if d > 1 else 0, abs=1e-6)
    assert [x for _, x in sorted(graph.components(nodes, e).collect())] == reach(len(ids), pairs)
    zones = dict(graph.zones(nodes, e).collect())
    assert set(zones) == set(ids) and all(zones[z] == z for z in zones.values())


def test_graph_edges_of_meaning(spark):
    e = frame(spark, [(2, 1), (1, 2), (1, 1), (3, 2), (None, 4)], "src bigint, dst bigint")
    assert sorted(map(tuple, rel.canonical_pairs(e).collect())) == [(1, 2), (2, 3)]
    one = frame(spark, [(7,)], "id bigint")
    assert [r["centrality"] for r in graph.centrality(one, frame(spark, [], "src bigint, dst bigint")).collect()] == [1.0]
    path = frame(spark, [(1, 2), (2, 3), (1, 3), (5, 3)], "src bigint, dst bigint")
    assert {r["id"]: (r["depth"], r["before"]) for r in graph.longest_path(path).collect()} == {1: (0, None), 2: (1, 1), 3: (2, 2), 5: (0, None)}
    with pytest.raises(ValueError, match="cycle"):
        graph.longest_path(frame(spark, [(1, 2), (2, 1)], "src bigint, dst bigint"))
    up = frame(spark, [(1, None), (2, 1), (3, 2), (4, 3), (5, 4)], "c bigint, p bigint")
    assert graph.closure(up, "c", "p").count() == 10


def test_radius_join(spark):
    rng = random.Random(3)
    points = [(i, rng.uniform(-9, 9), rng.uniform(-9, 9), rng.uniform(-2, 2)) for i in range(80)]
    got = {(r["a"], r["b"]) for r in rel.radius_join(frame(spark, points, "id bigint, x double, y double, z double"), 3.0).collect()}
    assert got == {(p[0], q[0]) for p in points for q in points if p[0] != q[0] and sum((a - b) ** 2 for a, b in zip(p[1:], q[1:], strict=True)) <= 9}


def test_aggregates(spark):
    df = frame(spark, [("a", 1.0, 0.0), ("a", 3.0, 0.0), ("b", 2.0, 1.0), ("b", 4.0, 3.0), ("c", None, 1.0)], "k string, v double, w double")
    got = dict(df.groupBy("k").agg(rel.weighted_mean(F.col("v"), F.col("w"))).collect())
    assert got == {"a": 2.0, "b": 3.5, "c": None}
    m = frame(spark, [("a", "x"), ("a", "y"), ("a", None), ("b", "z")], "k string, v string")
    assert dict(rel.mode_of(m, ["k"], "v", "m").collect()) == {"a": "x", "b": "z"}
    closed = rel.symmetric_closure(frame(spark, [(1, 2, "A", "B")], "s int, t int, sn string, tn string"), "s", "t", (("sn", "tn"),))
    assert sorted(map(tuple, closed.collect())) == [(1, 2, "A", "B"), (2, 1, "B", "A")]


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0, 4.0, INF], [-INF, INF], [-INF, 1.0, 1.0], [INF] * 3, [-1.7e308, 1.7e308, 0.0, 1.0], [5e-324, 1e-323, 0.0, 1.5e-323], [float(x) for x in range(20_000)], [2.0] * 50 + [3.0], [1e300 + k for k in range(9)], [0.1 * k for k in range(999)] + [-INF, INF, INF]])
def test_quantiles_end(spark, values):
    """Infinities, the widest and the narrowest ranges, ties: always an end, and the value at the rank."""
    df = frame(spark, [(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
    shares = (0.0, 0.25, 0.5, 0.9, 1.0)
    turn = sorted(values)
    for got, share in zip(rel.exact_quantiles(df, "v", shares), shares, strict=True):
        at = (len(turn) - 1) * share
        a, b = turn[int(at)], turn[min(int(at) + 1, len(turn) - 1)]
        if a == b or at == int(at):
            assert got == a
        elif INF in (abs(a), abs(b)):
            assert got == a + b or (got != got and a + b != a + b)
        else:
            assert got == pytest.approx(a + (b - a) * (at - int(at)), rel=1e-12)


def test_triples(spark):
    t = frame(
        spark,
        [("Pump", "rdfs:subClassOf", "Part", "iri", None), ("Part", "rdfs:subClassOf", "Thing", "iri", None), ("a", "rdf:type", "Pump", "iri", None), ("b", "rdf:type", "Part", "iri", None), ("a", "name", 'x "y"\n\\z', "literal", "xsd:string"), ("b", "weight", "-1.0", "literal", "xsd:double")],
        "s string, p string, o string, o_kind string, o_type string",
    )
    assert [r["x"] for r in triples.match(t, [("?x", "rdf:type", "?c"), ("?c", "subClassOf*", "Part")], [("?x", "name", "?n")]).select("x").collect()] == ["b"]
    with pytest.raises(ValueError, match="shares no variable"):
        triples.match(t, [("?x", "name", "?n"), ("?y", "weight", "?w")])
    shapes = [triples.Shape("named", "Part", "name", min_count=1), triples.Shape("heavy", "Thing", "weight", least=0.0, datatype="xsd:double")]
    assert sorted((r["shape"], r["node"]) for r in triples.violations(t, shapes).collect()) == [("heavy", "b"), ("named", "b")]
    back = triples.read_n_triples(triples.n_triples(t))
    assert sorted(map(str, back.collect())) == sorted(map(str, t.collect()))


def test_serving(spark):
    frame(spark, [(1, "a"), (2, "b")], "id int, name string").createOrReplaceTempView("served")
    assert serve.run_sql(spark, "SELECT id FROM served WHERE name = :n", {"n": "b"}) == {"rows": ['{"id":2}']}
    assert serve.run_sql(spark, "SELECT 'drop; set' AS x FROM served LIMIT 1") == {"rows": ['{"x":"drop; set"}']}
    for bad in ("DROP TABLE served", "SELECT 1; DROP TABLE served", "WITH x AS (SELECT 1) INSERT INTO served SELECT 1, 'x'", "SELECT nothing FROM served"):
        assert "error" in serve.run_sql(spark, bad)
    texts = frame(spark, [(1, "Feed pump"), (2, "pump-house"), (3, None)], "id int, t string")
    assert [r["id"] for r in serve.text_search(serve.token_index(texts, "id", ["t"]), "id", "PUMP house").collect()] == [2]
    names = frame(spark, [("A-1",), ("a-1",)], "grp string")
    assert [r["grp"] for r in serve.by_name(names, "grp", "A-1").collect()] == ["A-1"]
    assert len(serve.by_name(names, "grp", "a-1").collect()) == 1


def test_sources(spark, tmp_path):
    (tmp_path / "h.csv").write_text(f"ObjectId,ParentId,Level\nx,{io.EMPTY_GUID},0\ny,x,1.0\nz,y,none\n")
    got = {r["object_id"]: (r["parent_id"], r["level"]) for r in io.read_hierarchy(spark, str(tmp_path / "h.csv")).collect()}
    assert got == {"x": (None, 0), "y": ("x", 1), "z": ("y", None)}
    (tmp_path / "g.csv").write_text("ObjectId,MinX,Category\nx,1.5,c\ny,NaN,c\n")
    geometry = io.read_csv(spark, str(tmp_path / "g.csv"), "ObjectId string, MinX double, Category string", {"MinX": "bbox_min_x"}, ["Category"])
    assert sorted(map(tuple, geometry.collect())) == [("x", 1.5), ("y", None)] and geometry.columns == ["object_id", "bbox_min_x"]
    io.write_parquet(geometry, str(tmp_path / "p"))
    assert io.read_parquet(spark, str(tmp_path / "p"), ["object_id"]).count() == 2
    io.write_graph_csv(geometry, str(tmp_path / "c"), {"object_id": ":ID", "bbox_min_x": "x:double"})
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == [":ID", "x:double"]
    io.write_json_lines(geometry, str(tmp_path / "j"))
    assert io.read_json_lines(spark, str(tmp_path / "j")).count() == 2
    assert io.files(spark, str(tmp_path), "*.csv").count() >= 2
    assert dict(io.for_upload(frame(spark, [(1, None)], "a int, b string")).dtypes) == {"a": "double", "b": "string"}
    assert len(lineage.events("job", {"in": geometry}, {"out": geometry}, "2020-01-01T00:00:00Z")) == 2
    assert "| bbox_min_x | double | 1 | 1 |" in lineage.catalog_report(spark, {"g": geometry})


def test_stream_equals_batch(spark, tmp_path):
    source = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(source)
    batch.write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("windowed").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    key = ["start", "event_type"]
    assert [(r["start"], r["event_type"], r["n"]) for r in spark.table("windowed").orderBy(key).collect()] == [(r["start"], r["event_type"], r["n"]) for r in windowed_counts(batch).orderBy(key).collect()]


def test_order_over_ranges(spark):
    """Sums and forerunners do not depend on where one range ends, also with one group that spans them all."""
    rows = [(k % 2 if k < 20 else 2, k * 7 % 101, k) for k in range(101)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.createDataFrame(rows, "g bigint, z bigint, id bigint").repartition(5)
    assert rel.in_ranges(df, ["g", "z", "id"]).select("_part").distinct().count() > 3
    turn = sorted(rows)
    got = {r["id"]: (r["before"], r["upto"]) for r in rel.sum_before(rel.row_before(df, "id", "g", ["z", "id"], "before"), F.col("id"), ["g", "z", "id"], "upto").collect()}
    for i, (g, _, k) in enumerate(turn):
        assert got[k] == (turn[i - 1][2] if i and turn[i - 1][0] == g else None, sum(x[2] for x in turn[:i]))
    assert rel.row_before(df.limit(0), "id", "g", ["z", "id"], "before").collect() == []
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def modularity(zone, edges):
    degree = {k: sum(k in e for e in edges) for k in zone}
    m2 = 2 * len(edges)
    return sum(2 * (zone[a] == zone[b]) for a, b in edges) / m2 - sum(sum(degree[k] for k in zone if zone[k] == z) ** 2 for z in set(zone.values())) / m2**2


def one_by_one(nodes, edges):
    """Communities merged pair by pair while that raises modularity most."""
    zone = {k: k for k in nodes}
    while True:
        ways = [(modularity({k: a if z == b else z for k, z in zone.items()}, edges), a, b) for a, b in {(zone[a], zone[b]) for a, b in edges if zone[a] != zone[b]}]
        if not ways or max(ways)[0] <= modularity(zone, edges) + 1e-9:
            return zone
        _, a, b = max(ways)
        zone = {k: a if z == b else z for k, z in zone.items()}


@pytest.mark.parametrize("kind", ["chain", "cliques"])
def test_zones_by_levels(spark, kind):
    """Communities of a chain and of cliques in a ring are about as good as those found one by one."""
    if kind == "chain":
        edges = [(k, k + 1) for k in range(47)]
    else:
        edges = [(6 * c + i, 6 * c + j) for c in range(8) for i in range(6) for j in range(i + 1, 6)] + [tuple(sorted((6 * c, (6 * c + 9) % 48))) for c in range(8)]
    got = dict(graph.zones(frame(spark, [(k,) for k in range(50)], "id bigint"), frame(spark, edges, "src bigint, dst bigint")).collect())
    assert sorted(got) == list(range(50)) and got[48] == 48 and got[49] == 49
    assert all(z == min(k for k in got if got[k] == z) for z in got.values())
    assert modularity(got, edges) >= 0.95 * modularity(one_by_one(range(50), edges), edges)
