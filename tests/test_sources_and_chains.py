"""Database files, footers and marks; cycles, chains and ranks against plain programmes."""

from __future__ import annotations

import json
import random

import pytest

from gantry.operators import cycles, graph, ontology, triples
from gantry.sources import io, lineage, silver


def test_sqlite_there_and_back(spark, tmp_path):
    path = str(tmp_path / "a.db")
    df = spark.createDataFrame([(1, "é", 1.5, None), (2, None, None, True)], "i bigint, t string, x double, b boolean")
    assert io.write_sqlite({"one": df, "two": df.limit(0)}, path, {"one": ["i"]}) == {"one": 2, "two": 0}
    assert io.write_sqlite({"one": df.limit(1)}, path) == {"one": 1}  # replaced
    got = io.read_sqlite(spark, path, "SELECT i, t FROM one", "i bigint, t string").collect()
    assert [tuple(r) for r in got] == [(1, "é")]
    try:
        io.read_sqlite(spark, path, "DELETE FROM one", "i bigint")
        raise AssertionError("the file was opened for writing")
    except Exception as e:
        assert "readonly" in str(e)


def test_csv_mark_and_profile(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None), (3, "é")], "n int, t string")
    io.write_csv_with_bom(df.coalesce(1), str(tmp_path / "c"))
    part = next((tmp_path / "c").glob("part-*.csv")).read_bytes()
    assert part.startswith(b"\xef\xbb\xbfn,t\n")
    io.write_csv(df.coalesce(2), str(tmp_path / "p"))
    rows, schema = io.csv_profile(spark, str(tmp_path / "p"))
    assert rows == 3 and [(f.name, f.dataType.simpleString()) for f in schema] == [("n", "int"), ("t", "string")]


def test_csv_rows_with_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text('n,t\n1,"two\nlines"\n2,one\n')
    rows, schema = io.csv_profile(spark, str(tmp_path / "q.csv"))
    assert rows == 2 and [(f.name, f.dataType.simpleString()) for f in schema] == [("n", "int"), ("t", "string")]


def test_literals_there_and_back(spark, tmp_path):
    """Backslashes before letters, quotes, line ends of both kinds and nothing at all, through a file."""
    texts = ["\\n", "a\\\\n\n", 'say "x"', "\r\n", "", "\\", '\\"', "tab\t", "é\U0001f600 \\t"]
    t = spark.createDataFrame([(f"s{i}", "p", x, "literal", "xsd:string") for i, x in enumerate(texts)] + [("s0", "p", "o", "iri", None)], "s string, p string, o string, o_kind string, o_type string")
    triples.n_triples(t).write.text(str(tmp_path / "t"))
    assert sorted(map(str, triples.read_n_triples(spark.read.text(str(tmp_path / "t"))).collect())) == sorted(map(str, t.collect()))
    some = spark.createDataFrame([("# a comment",), ("",), ("  ",), ("<urn:asset:a> <urn:asset:b> <urn:asset:c> .",)], "value string")
    assert triples.read_n_triples(some).count() == 1
    with pytest.raises(Exception, match="this is no triple: <a> <b>"):
        triples.read_n_triples(some.union(spark.createDataFrame([("<a> <b>",)], "value string"))).collect()


def test_footers(spark, tmp_path):
    spark.range(10).selectExpr("id", "cast(id AS string) AS s").repartition(2).write.parquet(str(tmp_path / "f"))
    got = io.parquet_footers(spark, str(tmp_path / "f")).collect()
    assert {(r["column"], r["physical_type"]) for r in got} == {("id", "INT64"), ("s", "BYTE_ARRAY")} and sum(r["rows"] for r in got) == 20


def test_summary(spark):
    df = spark.range(4)
    lines = lineage.events("job", {"in": df}, {"out": df}, "2026-01-01T00:00:00Z")
    assert json.loads(lineage.summary(lines)) == {"jobs": ["job"], "runs": 1, "events": {"COMPLETE": 1, "START": 1}, "rows": {"out": 4}}


def test_schema(spark):
    got = {tuple(r) for r in ontology.schema_triples(spark).collect()}
    assert ("bim:HvacEquipment", "rdfs:subClassOf", "bim:Equipment") in got and ("bim:adjacentTo", "rdf:type", "owl:SymmetricProperty") in got
    assert ("bim:npd", "rdfs:domain", "bim:PipingComponent") in got and ("bim:levelValue", "rdfs:range", "xsd:integer") in got


def acyclic(edges):
    left = set(edges)
    while left:
        sources = {a for a, _ in left} - {b for _, b in left}
        if not sources:
            return False
        left = {(a, b) for a, b in left if a not in sources}
    return True


def depths(edges):
    found = {x: 0 for e in edges for x in e}
    for _ in found:
        for a, b in edges:
            found[b] = max(found[b], found[a] + 1)
    return found


def components_of(edges):
    """By mutual reach: {node: least member} of the strongly connected components of two nodes or more."""
    reach = {x: {x} for e in edges for x in e}
    for _ in reach:
        for a, b in edges:
            reach[a] |= reach[b]
    out = {x: min(y for y in reach if y in reach[x] and x in reach[y]) for x in reach}
    return {x: c for x, c in out.items() if list(out.values()).count(c) > 1}


#: Cycles with bridges between them, one within another, a tail and a head, loops; the last two once lost a bridge.
CYCLES = [
    [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (6, 5)],
    [(0, 1), (1, 2), (2, 0), (2, 5), (5, 6), (6, 7), (7, 5), (7, 6), (9, 0), (7, 10), (1, 1)],
    [(2, 3), (3, 2), (1, 4), (4, 1), (2, 1)],
    [(2, 3), (3, 2), (4, 5), (5, 4), (2, 1), (1, 4)],
]


@pytest.mark.parametrize("case", range(1, 6))
def test_strong_components(spark, case):
    """Only edges inside a component go, those that do not go up; an edge on no cycle always stays."""
    rng = random.Random(case)
    edges = CYCLES[case] if case < 4 else sorted({(rng.randrange(24), rng.randrange(24)) for _ in range((30, 60)[case - 4])})
    df = spark.createDataFrame([(a, b, f"{a}>{b}") for a, b in edges], "src bigint, dst bigint, edge_type string")
    want = components_of([e for e in edges if e[0] != e[1]])
    of = graph.cut(cycles.strongly_connected(df))
    assert dict(of.collect()) == want
    left = cycles.break_cycles(df, of=of).collect()
    inside = lambda a, b: a in want and want[a] == want.get(b)
    assert sorted((r["src"], r["dst"]) for r in left) == sorted((a, b) for a, b in edges if a != b and (not inside(a, b) or a < b))
    assert acyclic([(r["src"], r["dst"]) for r in left]) and all(r["edge_type"] == f"{r['src']}>{r['dst']}" for r in left)
    order = {x: rng.choice((0, 1, None)) for e in edges for x in e}
    place = lambda x: (order[x] is not None, order[x] or 0, x)
    got = cycles.break_cycles(df, spark.createDataFrame(list(order.items()), "id bigint, place int"), of).collect()
    assert sorted((r["src"], r["dst"]) for r in got) == sorted((a, b) for a, b in edges if a != b and (not inside(a, b) or place(a) < place(b)))


@pytest.mark.parametrize("case", range(1, 7))
def test_cycles_by_order(spark, case, monkeypatch):
    """F10 F11 F12: by an order the edges on no cycle stay without a search for components, and with more edges down than marks the same stay."""
    rng = random.Random(case)
    edges = CYCLES[case] if case < 4 else sorted({(rng.randrange(24), rng.randrange(24)) for _ in range((30, 60, 45)[case - 4])})
    df = spark.createDataFrame([(a, b, f"{a}>{b}") for a, b in edges], "src bigint, dst bigint, edge_type string")
    order = {x: rng.choice((0, 1, 2, None)) for e in edges for x in e if x % 5}
    place = lambda x: (order.get(x) is not None, order.get(x) or 0, x)
    of = components_of([e for e in edges if e[0] != e[1]])
    want = sorted((a, b, f"{a}>{b}") for a, b in edges if a != b and (a not in of or of[a] != of.get(b) or place(a) < place(b)))
    heights = spark.createDataFrame(list(order.items()), "id bigint, place int")
    if case != 6:
        monkeypatch.setattr(cycles, "strongly_connected", None)
    else:
        monkeypatch.setattr(cycles, "MARKS", 2)
    assert sorted(map(tuple, cycles.break_cycles(df, heights).collect())) == want


def test_strong_components_of_names(spark):
    df = spark.createDataFrame([("b", "a"), ("a", "b"), ("b", "c"), (None, "a")], "src string, dst string")
    assert dict(cycles.strongly_connected(df).collect()) == {"a": "a", "b": "a"}
    assert sorted(map(tuple, cycles.break_cycles(df.where("src IS NOT NULL")).collect())) == [("a", "b"), ("b", "c")]
    assert cycles.break_cycles(df.limit(0)).collect() == []


def test_cycles_break(spark):
    rng = random.Random(7)
    for n, m in ((3, 3), (12, 30), (25, 40)):
        edges = sorted({(a, b) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(m)) if a != b} | {(0, 1), (1, 0)})
        df = spark.createDataFrame([(a, b, "x") for a, b in edges], "src bigint, dst bigint, edge_type string")
        left = {(r["src"], r["dst"]) for r in graph.break_cycles(df).collect()}
        assert left < set(edges) and acyclic(left)
        for e in set(edges) - left:  # each edge that went lies on a cycle of the whole
            reach, more = {e[1]}, True
            while more:
                more = {b for a, b in edges if a in reach} - reach
                reach |= more
            assert e[0] in reach
    chain = spark.createDataFrame([(1, 2, "x"), (2, 3, "y")], "src bigint, dst bigint, edge_type string")
    assert graph.break_cycles(chain).count() == 2


def test_chain_and_rank(spark):
    rng = random.Random(9)
    edges = sorted({(min(a, b), max(a, b)) for a, b in ((rng.randrange(30), rng.randrange(30)) for _ in range(60)) if a != b})
    df = spark.createDataFrame([(a, b, f"{a}-{b}") for a, b in edges], "src bigint, dst bigint, edge_type string")
    far = depths(edges)
    chain = graph.critical_chain(df).orderBy("step").collect()
    assert [r["step"] for r in chain] == list(range(max(far.values()) + 1))
    assert all((a["id"], b["id"]) in set(edges) and b["edge_type"] == f"{a['id']}-{b['id']}" for a, b in zip(chain, chain[1:], strict=False)) and chain[0]["edge_type"] == ""
    rank = {r["id"]: r["rank"] for r in graph.install_rank(df, spark.range(33)).collect()}
    assert sorted(rank.values()) == list(range(1, 34)) and all(rank[a] < rank[b] for a, b in edges) and [rank[i] for i in (30, 31, 32)] == [31, 32, 33]


def test_declared_sources(spark, tmp_path):
    """Headers in any order, text that does not fit, absent and unknown columns, quoted line breaks."""
    (tmp_path / "a.csv").write_text('Tolerance,Extra,SourceObjectId,Distance,RelationType\n0.1,e,"a ""b""",nan,touch\nmuch,,x,1e2,\n')
    df = silver.read(spark, str(tmp_path / "a.csv"), silver.ADJACENCY)
    assert df.columns == [n for _, n, _ in silver.ADJACENCY.columns] + ["Extra"]
    assert [(r["source_object_id"], r["distance_m"], r["relation_type"], r["tolerance_m"], r["target_name"], r["Extra"]) for r in df.collect()] == [('a "b"', None, "touch", 0.1, None, "e"), ("x", 100.0, None, None, None, None)]
    (tmp_path / "g.csv").write_text('GroupId,MemberObjectIds,ElementCount\n"g\n1",a;b,2.0\ng2,c,x\n')
    got = silver.read(spark, str(tmp_path / "g.csv"), silver.GROUPS, multi_line=True)
    assert "MemberObjectIds" not in got.columns and [(r["group_id"], r["group_size"]) for r in got.collect()] == [("g\n1", 2), ("g2", None)]
    assert dict(got.dtypes)["group_centroid_z"] == "double"


def test_silver_sides(spark):
    """Hierarchy is the source of parents and levels; a group of many objects multiplies none."""
    objects = spark.createDataFrame([("a", "no", "3.0"), ("b", "no", "x")], "object_id string, parent_id string, level string")
    hierarchy = spark.createDataFrame([("a", None, 0), ("b", "a", 1)], "object_id string, parent_id string, level bigint")
    validation = spark.createDataFrame([("a", "g"), ("b", "g")], "object_id string, group_id string")
    groups, geometry = spark.createDataFrame([("g", 2)], "group_id string, group_size bigint"), spark.createDataFrame([("a", 1.5)], "object_id string, centroid_x double")
    assert [r["level"] for r in silver.with_levels(objects).orderBy("object_id").collect()] == [3, None]
    base, sides = silver.silver(geometry, validation, groups, hierarchy, objects)
    for side, key in sides:
        base = base.join(side, key, "left")
    got = {r["object_id"]: (r["parent_id"], r["level"], r["group_id"], r["group_size"], r["centroid_x"]) for r in base.collect()}
    assert got == {"a": (None, 0, "g", 2, 1.5), "b": ("a", 1, "g", 2, None)}
