import random

import pytest

from gantry.operators import matching
from gantry.operators import relational as rel
from gantry.plans import structure

REACH = 3.0


def _points(seed, n, wide, odd):
    r = random.Random(seed)
    return [(2 * k + odd, r.randrange(wide) * 0.9, r.randrange(8) * 0.7, r.randrange(3) * 1.1) for k in range(n)]


@pytest.mark.parametrize("wide, rows_of_a_cube", [(12, 200_000), (60, 0)])
def test_points_by_place(spark, monkeypatch, wide, rows_of_a_cube):
    """Totals are those of the auction between rows, with several points in a place, several cubes, and points nowhere."""
    monkeypatch.setattr(matching, "CUBE_ROWS", rows_of_a_cube)
    monkeypatch.setattr(matching, "ROWS_AT_ONCE", 2)
    nowhere = [(1000, None, 0.0, 0.0), (1002, float("nan"), 0.0, 0.0), (1004, 0.0, float("inf"), 0.0), (1006, 500.0, 0.0, 0.0)]
    left, right = _points(1, 260, wide, 0) + nowhere + [(2000 + 2 * k, 1.0, 1.0, 1.0) for k in range(7)], _points(2, 200, wide, 1) + [(3001 + 2 * k, 1.5, 1.0, 1.0) for k in range(5)]
    a, b = (spark.createDataFrame(x, "id bigint, x double, y double, z double") for x in (left, right))
    got = matching.assign_points(a, b, REACH, 0.001).collect()
    assert len({r["a"] for r in got}) == len({r["b"] for r in got}) == len(got)
    of = {r[0]: r[1:] for r in left + right}
    for r in got:
        assert r["cost"] == pytest.approx(sum((p - q) ** 2 for p, q in zip(of[r["a"]], of[r["b"]], strict=True)) ** 0.5) and r["cost"] < REACH
    near = rel.radius_join(a.unionByName(b).where("x < 400"), REACH).where("a % 2 = 0 AND b % 2 = 1").selectExpr("a", "b", "distance AS cost")
    best = matching.assign(near, REACH, 0.001).collect()
    worth = lambda rows: sum(REACH - r["cost"] for r in rows)
    assert worth(got) == pytest.approx(worth(best), abs=0.001 * (len(got) + len(left) + len(right)))


def test_no_points(spark):
    none = spark.createDataFrame([], "id bigint, x double, y double, z double")
    one = spark.createDataFrame([(1, 0.0, 0.0, 0.0)], none.schema)
    assert matching.assign_points(none, one, REACH, 0.01).collect() == matching.assign_points(one, none, REACH, 0.01).collect() == []


def test_assigned_matches_makes_no_pairs_of_parts(spark, tmp_path, monkeypatch):
    """3,000 parts in each of two places that touch: all are matched, without the nine million pairs of them."""
    monkeypatch.setattr(rel, "radius_join", None)
    rows = spark.range(6000).selectExpr("cast(id div 2 * 1600 + id % 2 AS bigint) AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'PROMO x' AS p_type", "7 AS p_size", "1.0D AS p_retailprice")
    rows.write.parquet(f"{tmp_path}/part.parquet")
    got = structure.assigned_matches(spark, str(tmp_path)).collect()
    assert len({r["a"] for r in got}) == len({r["b"] for r in got}) == len(got) == 3000
    assert {r["cost"] for r in got} == {1.0}
