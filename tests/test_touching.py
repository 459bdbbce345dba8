"""Queries over all touching objects against plain Python, on a small plant."""

import random

import pytest

from gantry.plans import catalog
from tests.test_operators import reach

KINDS = ("LARGE", "MEDIUM", "SMALL", "PROMO")


@pytest.fixture(scope="module")
def plant(spark, tmp_path_factory):
    rng = random.Random(4)
    at = str(tmp_path_factory.mktemp("plant"))
    size = {k: rng.choice((7, 8, 9, 20, 31)) for k in range(40)}
    cls = {k: rng.choice(KINDS) for k in range(40)}
    parts = [(k, f"n{k}", f"{cls[k]} A B", "Brand", size[k], 900.0 + k) for k in range(40)]
    lines = [(o, k, 5.0) for o in range(14) for k in {rng.randrange(30), rng.randrange(40), 0 if o < 8 else rng.randrange(40)}]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int, p_retailprice double").write.parquet(f"{at}/part.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_quantity double").write.parquet(f"{at}/lineitem.parquet")
    pairs = sorted({(a, b) for o, a, _ in lines for p, b, _ in lines if o == p and a < b})
    return at, size, cls, pairs


def ask(spark, plant, name):
    return catalog.QUERIES[name](spark, plant[0]).collect()


def test_measures(spark, plant):
    _, size, cls, pairs = plant
    near = {k: {b if a == k else a for a, b in pairs if k in (a, b)} for k in size}
    assert max(map(len, near.values())) > 4
    got = {r["id"]: (r["degree"], r["triangles"]) for r in ask(spark, plant, "touch_clustering")}
    assert got == {k: (len(near[k]), sum(b in near[a] for a in near[k] for b in near[k] if a < b)) for k in size}
    assert [c for _, c in sorted(ask(spark, plant, "touch_components"))] == reach(40, pairs)
    assert {tuple(r) for r in ask(spark, plant, "touch_neighbors_1hop")} == {(k, n) for k in size for n in near[k]}
    rest = reach(40, [(a, b) for a, b in pairs if size[a] != 7 and size[b] != 7])
    want = {d: len({k for n in near[d] if size[n] != 7 for k in size if size[k] != 7 and rest[k] == rest[n]}) for d in size if size[d] == 7}
    assert dict(ask(spark, plant, "touch_isolation_sections")) == want
    for r in ask(spark, plant, "removal_effect"):
        left = [k for k in size if cls[k] != r["without"]]
        roots = reach(40, [(a, b) for a, b in pairs if a in left and b in left])
        assert r["components"] == len({roots[k] for k in left})


def test_zones_and_chain(spark, plant):
    _, size, cls, pairs = plant
    zone = dict(ask(spark, plant, "louvain_zones"))
    single = {k for k in size if not any(k in p for p in pairs)}
    assert all(zone[k] == k for k in single)
    assert all(any(zone[a] == zone[b] for a, b in pairs if k in (a, b)) for k in size if list(zone.values()).count(zone[k]) > 1)
    dag = [tuple(r) for r in ask(spark, plant, "touch_precedence_dag")]
    rises = {(a, b) if size[a] < size[b] else (b, a) for a, b in pairs if cls[a] == cls[b] and size[a] != size[b]}
    assert rises and rises <= {(a, b) for a, b, _ in dag}
    depth = {r["id"]: r["depth"] for r in ask(spark, plant, "longest_chain")}
    want = {k: 0 for a, b, _ in dag for k in (a, b)}
    for _ in want:
        for a, b, _ in dag:
            want[b] = max(want[b], want[a] + 1)
    assert depth == want


def test_every_class_is_taken_out(spark, plant):
    """of four classes only two were."""
    _, size, cls, pairs = plant
    want = {}
    for gone in KINDS:
        left = [k for k in size if cls[k] != gone]
        roots = reach(40, [(a, b) for a, b in pairs if a in left and b in left])
        want[gone] = len({roots[k] for k in left})
    assert {r["without"]: r["components"] for r in ask(spark, plant, "removal_effect")} == want
