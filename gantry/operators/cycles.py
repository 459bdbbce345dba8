"""Strongly connected components of a directed graph, and an acyclic rest that keeps every edge that lies on no cycle.

Nodes without a way in or a way out are trimmed first, round by round. Then every part that is left has a pivot, its least
node; what the pivot reaches and what reaches it are followed together, all parts side by side, along the newest nodes only.
What lies in both is the pivot's component. The rest of a part falls into three (reached only, reaching only, neither),
between which no component runs, and each is a part of the next turn. Every round is written, so lineage never grows.

Loops (an edge from a node to itself) are cycles of their own. Null ends are no edges. Ids may be of any type with an order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.operators import alone
from gantry.operators.durable import bucketed, buckets_of, written


#: Steps of trimming that are planned as one round, between two tables.
STEPS_A_ROUND = 3
#: Edges that do not go up in an order of which each has a bit of its own.
MARKS = 62


def trimmed(edges: DataFrame) -> DataFrame:
    """The edges left when all that lead to or from a node without the other kind (in its part) are peeled off, round by round."""
    left = written(edges)
    n = left.count()
    while n:
        for _ in range(STEPS_A_ROUND):
            ends, starts = left.select(F.col("dst").alias("src")).distinct(), left.select(F.col("src").alias("dst")).distinct()
            left = left.join(ends, "src", "left_semi").join(starts, "dst", "left_semi").select(edges.columns)
        left = written(left)
        was, n = n, left.count()
        if n == was:
            break
    return left


def _followed(live: DataFrame, start: DataFrame) -> DataFrame:
    """(id, way, pivot): what is reached from the start (id, pivot) along the edges (way 1) and against them (way -1)."""
    ways = live.select(F.col("src").alias("at"), F.col("dst").alias("to"), F.lit(1).alias("way")).union(live.select("dst", "src", F.lit(-1)))
    ways = written(ways)
    new = start.select("id", F.explode(F.array(F.lit(1), F.lit(-1))).alias("way"), "pivot")
    seen = new = written(new)
    while True:
        step = new.join(ways, (F.col("id") == F.col("at")) & (new["way"] == ways["way"])).select(F.col("to").alias("id"), new["way"], "pivot").distinct()
        new = written(step.join(seen.select("id", "way"), ["id", "way"], "left_anti").select("id", "way", "pivot"))
        if new.isEmpty():
            return seen
        seen = seen.unionByName(new)


def strongly_connected(edges: DataFrame) -> DataFrame:
    """(id, component) of every node that lies on a cycle through other nodes; component is its least member."""
    plain = edges.select("src", "dst").where("src <> dst").distinct()
    live = trimmed(plain.withColumns({"part": F.lit(None).cast(plain.schema["src"].dataType), "side": F.lit(0)}))
    found = live.select(F.col("src").alias("id"), F.col("src").alias("component")).limit(0)
    while not live.isEmpty():
        nodes = written(live.select(F.explode(F.array("src", "dst")).alias("id"), "part", "side").distinct())
        pivots = nodes.groupBy("part", "side").agg(F.min("id").alias("pivot"))
        own = nodes.join(pivots.withColumnsRenamed({"part": "of_part", "side": "of_side"}), F.col("part").eqNullSafe(F.col("of_part")) & (F.col("side") == F.col("of_side"))).select("id", "pivot")
        own = written(own)
        marks = _followed(live, own.where("id = pivot")).groupBy("id").agg(F.bool_or(F.col("way") == 1).alias("to"), F.bool_or(F.col("way") == -1).alias("back"))
        marks = own.join(marks, "id", "left")
        side = F.when(F.col("to") & F.col("back"), 3).when(F.col("to"), 1).when(F.col("back"), 2).otherwise(0)
        state = written(marks.select("id", "pivot", side.alias("side")))
        found = written(found.unionByName(state.where("side = 3").select("id", F.col("pivot").alias("component"))))
        rest = state.where("side < 3")
        one = rest.select(F.col("id").alias("src"), F.col("pivot").alias("part"), "side")
        other = rest.select(F.col("id").alias("dst"), F.col("pivot").alias("q"), F.col("side").alias("other_side"))
        within = live.select("src", "dst").join(one, "src").join(other, "dst").where("part = q AND side = other_side")
        live = trimmed(within.select("src", "dst", "part", "side"))
    alone = found.groupBy("component").count().where("count = 1").select("component")
    return found.join(alone, "component", "left_anti").select("id", "component")


def _without_returning(edges: DataFrame, order: DataFrame) -> DataFrame:
    """break_cycles() by an order. A cycle goes down somewhere, so only the edges that do not go up are asked for, and which starts their ends reach.

    With up to MARKS of them, what each end reaches along the edges that go up is marked in one number a node; that, and the
    few edges down, tell what lies on a cycle. With more, strongly connected components are found.
    """
    kept = edges.where("src <> dst")
    one, other = (order.select(F.col("id").alias(f"{c}_id"), F.col("place").alias(f"{c}_place"), F.lit(True).alias(f"{c}_known")) for c in "ab")
    named = kept.join(one, F.col("src") == F.col("a_id"), "left").join(other, F.col("dst") == F.col("b_id"), "left")
    up = F.coalesce(F.struct("a_place", "src") < F.struct("b_place", "dst"), F.lit(False))
    named = written(named.withColumn("_up", up).select(*edges.columns, "_up"))
    down = [tuple(r) for r in named.where("NOT _up").select("src", "dst").distinct().limit(MARKS + 1).collect()]
    if len(down) > MARKS:
        return break_cycles(edges, order, strongly_connected(edges))
    met = _reached(named.where("_up").select("src", "dst"), down)
    reaches = {i: {j for j, (start, _) in enumerate(down) if start == end or met.get(start, 0) >> i & 1} for i, (_, end) in enumerate(down)}
    gone = []
    for i in reaches:  # which edges down come after this one, itself among them on a cycle
        after, new = set(), {i}
        while new:
            new = {k for j in new for k in reaches[j]} - after
            after |= new
        if i in after:
            gone.append(down[i])
    if not gone:
        return named.select(edges.columns)
    out = edges.sparkSession.createDataFrame(gone, edges.select("src", "dst").schema)
    return named.join(F.broadcast(out), ["src", "dst"], "left_anti").select(edges.columns)


def _reached(edges: DataFrame, down: list[tuple]) -> dict:
    """For each start of the edges down: the bits of those whose ends reach it along the edges. Only nodes whose marks have grown are followed."""
    if not down:
        return {}
    first: dict = {}
    for i, (_, end) in enumerate(down):
        first[end] = first.get(end, 0) | 1 << i
    kind = edges.schema["src"].dataType.simpleString()
    if alone.fits(edges):
        return _reached_alone(edges, kind, first, list({s for s, _ in down}))
    edges = written(edges)
    edges = bucketed(edges, "src", buckets_of(edges, edges.count()))
    new = seen = written(edges.sparkSession.createDataFrame(list(first.items()), f"id {kind}, marks bigint"))
    while True:
        told = edges.join(new.hint("shuffle_hash"), F.col("src") == F.col("id")).groupBy(F.col("dst").alias("to")).agg(F.bit_or("marks").alias("more"))
        now = seen.join(told, F.col("id") == F.col("to"), "full").select(F.coalesce("id", "to").alias("id"), F.coalesce("marks", F.lit(0)).alias("was"), F.coalesce("more", F.lit(0)).alias("more"))
        now = now.select("id", F.col("was").bitwiseOR(F.col("more")).alias("marks"), "was")
        now = written(now)
        new, seen = now.where("marks <> was").select("id", "marks"), now.select("id", "marks")
        if new.isEmpty():
            break
    starts = edges.sparkSession.createDataFrame(list({(s,) for s, _ in down}), f"id {kind}")
    return {r["id"]: r["marks"] for r in seen.join(F.broadcast(starts), "id", "left_semi").collect()}


def _reached_alone(edges: DataFrame, kind: str, first: dict, asked: list) -> dict:
    """_reached() in one task: the marks of the nodes asked for."""

    def follow(t: pa.Table) -> pa.Table:
        names, (src, dst) = alone.coded(t, "src", "dst")
        at = pc.index_in(pa.array(list(first), names.type), value_set=names).to_pylist()
        marks = np.zeros(len(names), np.int64)
        for i, bits in zip(at, first.values(), strict=True):
            if i is not None:
                marks[i] |= bits
        marks = alone.marked(src, dst, marks)
        wanted = pc.index_in(pa.array(asked, names.type), value_set=names).drop_null()
        return pa.table([names.take(wanted), pa.array(marks[wanted.to_numpy()])], ["id", "marks"])

    rows = alone.in_one_task(edges, f"id {kind}, marks bigint", follow).collect()
    return {k: first.get(k, 0) for k in asked} | {r["id"]: r["marks"] for r in rows}


def break_cycles(edges: DataFrame, order: DataFrame | None = None, of: DataFrame | None = None) -> DataFrame:
    """An acyclic subset of the edges (src, dst, ...): those that lie on no cycle, and of the others those that go up.

    Inside a strongly connected component every edge is on a cycle, and every cycle goes down somewhere; so its edges that
    do not go up go, and no others. Up is from the lesser to the greater id, or by order (id, place), ties by id; nodes
    without a place come first. Loops go. Components that are known already may be given.
    """
    if of is None and order is not None:
        return _without_returning(edges, order)
    of = strongly_connected(edges) if of is None else of
    place = of.select("id", "component", F.lit(0).alias("place")) if order is None else of.join(order.select("id", "place"), "id", "left").select("id", "component", "place")
    place = written(place)
    a = place.select(F.col("id").alias("a"), F.col("component").alias("ca"), F.struct("place", "id").alias("pa"))
    b = place.select(F.col("id").alias("b"), F.col("component").alias("cb"), F.struct("place", "id").alias("pb"))
    named = edges.where("src <> dst").join(a, F.col("src") == F.col("a"), "left").join(b, F.col("dst") == F.col("b"), "left")
    down = F.coalesce(F.col("ca") == F.col("cb"), F.lit(False)) & ~F.coalesce(F.col("pa") < F.col("pb"), F.lit(False))
    return named.where(~down).select(edges.columns)
