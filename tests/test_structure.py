"""Blocks and removal, against plain programmes."""

import math
import random

import pytest

from gantry.operators import blocks, durable, matching, paths, profile, scene
from tests.test_operators import reach


def parts_of(nodes, pairs):
    at = {x: i for i, x in enumerate(nodes)}
    root = reach(len(nodes), [(at[a], at[b]) for a, b in pairs])
    return len(set(root))


def chain(n):
    return [(i, i + 1) for i in range(n)]


GRAPHS = {
    "chain": (range(301), chain(300)),
    "rings on a chain": (range(60), chain(59) + [(a, a + 5) for a in range(0, 50, 7)]),
    "star": (range(120), [(0, i) for i in range(1, 120)] + [(1, 2), (3, 4)]),
    "sparse": (range(40), sorted({tuple(sorted(random.Random(1).sample(range(40), 2))) for _ in range(1)} | {tuple(sorted((random.Random(k).randrange(40), random.Random(k + 99).randrange(40)))) for k in range(46)})),
    "dense": (range(14), sorted({tuple(sorted((random.Random(k).randrange(14), random.Random(k + 50).randrange(14)))) for k in range(60)})),
    "none": (range(3), []),
}


@pytest.mark.parametrize("name", GRAPHS)
def test_removal_of_each(spark, name):
    nodes, pairs = GRAPHS[name]
    pairs = [(a, b) for a, b in pairs if a != b]
    ids = spark.createDataFrame([(10 * i,) for i in nodes], "id bigint")
    e = spark.createDataFrame([(10 * a, 10 * b) for a, b in pairs], "src bigint, dst bigint")
    whole = parts_of(list(nodes), pairs)
    want = {}
    for x in nodes:
        left = [y for y in nodes if y != x]
        more = parts_of(left, [p for p in pairs if x not in p]) - whole
        want[10 * x] = (more + 1, more, more > 0)
    assert {r["id"]: (r["blocks"], r["more"], r["is_cut"]) for r in blocks.removal_of_each(ids, e).collect()} == want


def test_blocks_share_no_cycle(spark):
    """Two triangles with a common node, a bridge to a ring of four with a diagonal."""
    pairs = [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (3, 5), (5, 6), (6, 7), (7, 8), (8, 9), (6, 9), (7, 9)]
    of = {}
    for r in blocks.blocks(spark.range(12), spark.createDataFrame(pairs, "src bigint, dst bigint")).collect():
        of.setdefault(r["block"], set()).add((r["src"], r["dst"]))
    assert sorted(map(sorted, of.values())) == [[(1, 2), (1, 3), (2, 3)], [(3, 4), (3, 5), (4, 5)], [(5, 6)], [(6, 7), (6, 9), (7, 8), (7, 9), (8, 9)]]


def test_fragmentation(spark):
    nodes = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "b"), (6, None), (7, "c")], "id bigint, grp string")
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5), (5, 6)], "src bigint, dst bigint")
    got = blocks.fragmentation(nodes, pairs, spark.createDataFrame([(2,), (7,), (6,)], "id bigint"))
    assert sorted(map(tuple, got.collect())) == [("a", 1, 2, 1), ("b", 1, 1, 0), ("c", 1, 0, -1)]


# transforms


def times(a, b):
    return [sum(a[4 * i + k] * b[4 * k + j] for k in range(4)) for i in range(4) for j in range(4)]


def test_world_transforms(spark):
    """A chain of over 1,000 with branches, order kept (turns do not commute), against a plain walk; unknown and null parents are roots."""
    rng = random.Random(5)
    local, parent = {}, {}
    for i in range(1300):
        a = rng.uniform(0, 6.3)
        c, s = math.cos(a), math.sin(a)
        turn = [c, -s, 0, 0, s, c, 0, 0, 0, 0, 1, 0] if i % 2 else [1, 0, 0, 0, 0, c, -s, 0, 0, s, c, 0]
        local[i] = [*(turn[k] if k % 4 < 3 else rng.uniform(-1, 1) for k in range(12)), 0.0, 0.0, 0.0, 1.0]
        parent[i] = i - 1 if i % 50 else max(0, i - 3)
    parent[0], parent[1290], local[1295] = None, 99_999, None
    rows = [(i, parent[i], local[i] and list(map(float, local[i]))) for i in local]
    got = dict(scene.world_transforms(spark.createDataFrame(rows, "id bigint, parent bigint, transform array<double>")).collect())
    world = {}
    for i in local:
        own = local[i] or scene.IDENTITY
        world[i] = times(world[parent[i]], own) if parent[i] in world and i else own
        assert got[i] == pytest.approx(world[i], abs=1e-8)
    depth = {}
    for i in local:
        depth[i] = depth.get(parent[i], 0) + 1
    assert max(depth.values()) > 1000


def test_transforms_that_are_none(spark):
    schema = "id bigint, parent bigint, transform array<double>"
    loop = spark.createDataFrame([(1, 2, None), (2, 3, None), (3, 1, None), (4, 1, None)], schema)
    with pytest.raises(ValueError, match="form a loop"):
        scene.world_transforms(loop)
    with pytest.raises(Exception, match="several rows"):
        scene.world_transforms(spark.createDataFrame([(1, None, None), (1, None, None), (2, 1, None)], schema)).collect()
    with pytest.raises(Exception, match="not 16 numbers"):
        scene.world_transforms(spark.createDataFrame([(1, None, [1.0])], schema)).collect()
    assert scene.world_transforms(loop.limit(0)).collect() == []


def test_points_and_normals(spark):
    nodes = spark.createDataFrame([(1, None, [2.0, 0.0, 0.0, 5.0, 0.0, 2.0, 0.0, 6.0, 0.0, 0.0, 2.0, 7.0, 0.0, 0.0, 0.0, 1.0])], "id bigint, parent bigint, transform array<double>")
    vertices = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 0.0, 3.0, 4.0, "a"), (1, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, "b"), (9, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, "c")], "id bigint, x double, y double, z double, nx double, ny double, nz double, name string")
    got = {r["name"]: tuple(r[c] for c in ("x", "y", "z", "nx", "ny", "nz")) for r in scene.in_asset_axes(nodes, vertices).collect()}
    assert got == {"a": (-7.0, 13.0, 10.0, 0.0, 0.8, pytest.approx(0.6)), "b": (-5.0, 7.0, 6.0, 0.0, 0.0, 0.0)}


# path patterns


def plain_ends(edges, starts, pattern):
    """By brute force: sets of (origin, node) after each hop, repeated hops until nothing is new."""
    def step(at, hop):
        out = set()
        for o, n in at:
            for a, b, label in edges:
                if hop.labels is None or label in hop.labels:
                    out |= {(o, b)} if a == n and hop.way in ("out", "both") else set()
                    out |= {(o, a)} if b == n and hop.way in ("in", "both") else set()
        return out

    at = set(starts)
    for hop in pattern:
        for _ in range(hop.least):
            at = step(at, hop)
        more, k = at, hop.least
        while more and (hop.most is None or k < hop.most):
            more, k = step(more, hop) - (at if hop.most is None else set()), k + 1
            at = at | more
    return at


PATTERNS = [
    [],
    [paths.Hop(("a",))],
    [paths.Hop(("a",), "both"), paths.Hop(("b",), "in")],
    [paths.Hop(("a", "b"), "out", 0, None)],
    [paths.Hop(("a",), "out", 2, 3), paths.Hop(None, "both", 0, 1)],
    [paths.Hop(("a",), "out", 1, None), paths.Hop(("b",), "out", 0, None), paths.Hop(("c",), "in", 0, 2)],
]


@pytest.mark.parametrize("k", range(len(PATTERNS)))
def test_path_patterns(spark, k):
    rng = random.Random(k)
    edges = sorted({(rng.randrange(15), rng.randrange(15), rng.choice("abc")) for _ in range(34)})
    starts = sorted({(f"z{i % 3}", rng.randrange(15)) for i in range(5)})
    got = paths.ends(spark.createDataFrame(edges, "src bigint, dst bigint, label string"), spark.createDataFrame(starts, "origin string, id bigint"), PATTERNS[k]).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == plain_ends(edges, starts, PATTERNS[k])


def test_origins_and_repeats_share_rows(spark, monkeypatch):
    """F16: edges are kept once for a repeated hop, and a node once for up to 62 origins, however many reach it."""
    kept, tables = [], []
    monkeypatch.setattr(paths, "bucketed", lambda df, *a: kept.append(df.count()) or durable.bucketed(df, *a))
    monkeypatch.setattr(paths, "written", lambda df: tables.append(durable.written(df)) or tables[-1])
    edges = spark.createDataFrame([(k, k % 7 + 100, "a") for k in range(70)] + [(k + 100, 200, "a") for k in range(7)], "src bigint, dst bigint, label string")
    starts = spark.createDataFrame([(f"o{k}", k) for k in range(70)], "origin string, id bigint")
    got = paths.ends(edges, starts, [paths.Hop(("a",), "out", 1, 3)]).collect()
    assert sorted(map(tuple, got)) == sorted([(f"o{k}", k % 7 + 100) for k in range(70)] + [(f"o{k}", 200) for k in range(70)])
    assert kept == [77] and tables[-1].where("id >= 100").count() <= 16


def test_hops_are_checked():
    for bad in ({"way": "up"}, {"least": -1}, {"least": 3, "most": 2}, {"least": 0, "most": 0}):
        with pytest.raises(ValueError, match="not a hop"):
            paths.Hop(**bad)


# matching


def least_total(cost, n, m, reach):
    """The least sum of costs, `reach` for each left row alone, by going through all right rows taken."""
    best = {0: 0.0}
    for a in range(n):
        new = {}
        for taken, total in best.items():
            for b in [None, *range(m)]:
                c = reach if b is None else cost.get((a, b), reach)
                if b is not None and (taken >> b & 1 or c >= reach):
                    continue
                key = taken if b is None else taken | 1 << b
                new[key] = min(new.get(key, 1e9), total + c)
        best = new
    return min(best.values())


@pytest.mark.parametrize("most", [matching.LOCAL_PAIRS, 5])
def test_assignment(spark, monkeypatch, most):
    """Many small tables side by side: one to one, and each total within epsilon a row of the least; ties and lone rows among them."""
    monkeypatch.setattr(matching, "LOCAL_PAIRS", most)
    rng, reach, epsilon, rows, cases = random.Random(6), 5.0, 0.05, [], []
    for k in range(10):
        n, m = rng.randrange(1, 7), rng.randrange(1, 7)
        whole = k % 3 == 0  # costs with ties
        cost = {(a, b): float(rng.randrange(1, 7)) if whole else rng.uniform(0, 7) for a in range(n) for b in range(m) if rng.random() < 0.7}
        cases.append((n, m, cost))
        rows += [(100 * k + a, 100 * k + b, c) for (a, b), c in cost.items()]
    # twice the price war of three for one place, and rows that do not count
    rows += [(9000, 9000, 1.0), (9001, 9000, 1.0), (9002, 9000, 1.0), (9003, 9003, 6.0), (None, 9004, 1.0), (9005, 9005, None), (9000, 9000, 2.0)]
    got = matching.assign(spark.createDataFrame(rows, "a bigint, b bigint, cost double"), reach, epsilon).collect()
    assert len({r["a"] for r in got}) == len({r["b"] for r in got}) == len(got)
    assert all((r["a"], r["b"], r["cost"]) in rows and r["cost"] < reach for r in got)
    assert sum(r["b"] == 9000 for r in got) == 1 and not any(r["a"] in (9003, 9005) for r in got)
    for k, (n, m, cost) in enumerate(cases):
        own = [r["cost"] for r in got if r["a"] // 100 == k]
        assert sum(own) + reach * (n - len(own)) <= least_total(cost, n, m, reach) + epsilon * (n + m)
    assert matching.assign(spark.createDataFrame([], "a bigint, b bigint, cost double"), reach, epsilon).collect() == []


# profiles


def test_co_moments(spark):
    """Large values close together, gaps, NaN and infinities, a constant and an empty column, over several tasks."""
    rng = random.Random(8)
    rows = []
    for k in range(400):
        x = 1e9 + rng.random()
        rows.append((x, -3 * x + rng.random() * 0.1, None if k % 3 else float(k), 5, rng.choice([float("nan"), float("inf"), 1.0, 2.0, -1.0]), None))
    df = spark.createDataFrame(rows, "a double, b double, c double, d int, e double, f double").repartition(5)
    got = {(r["a"], r["b"]): (r["n"], r["correlation"]) for r in profile.correlations(df, list("abcdef")).collect()}
    clean = [[None if v is None or not math.isfinite(v) else float(v) for v in r] for r in rows]
    for i, p in enumerate("abcdef"):
        for j in range(i + 1, 6):
            both = [(r[i], r[j]) for r in clean if r[i] is not None and r[j] is not None]
            if not both:
                assert (p, "abcdef"[j]) not in got
                continue
            mx, my = (sum(v[k] - both[0][k] for v in both) / len(both) + both[0][k] for k in (0, 1))
            sxx, syy, sxy = (sum((v[m] - (mx, my)[m]) * (v[n] - (mx, my)[n]) for v in both) for m, n in ((0, 0), (1, 1), (0, 1)))
            n, r = got[p, "abcdef"[j]]
            assert n == len(both)
            assert r is None if sxx == 0 or syy == 0 else r == pytest.approx(sxy / math.sqrt(sxx * syy), abs=1e-6)
    assert profile.correlations(df.limit(0), ["a", "b"]).collect() == []
    told = {(r["kind"], r["column"], r["other"]) for r in profile.alerts(df).collect()}
    assert {("constant", "d", None), ("missing", "c", None), ("missing", "f", None), ("correlated", "a", "b")} <= told and ("missing", "a", None) not in told
