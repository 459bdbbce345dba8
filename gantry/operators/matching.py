"""One-to-one matching of least total cost among candidates, by an auction whose bids are rounds of joins.

A pair is worth reach - cost, so pairs beyond reach are no candidates and a row may stay alone. To let rows stay alone without
harm to the auction's bound, both sides are doubled: each left row bids for its candidates or for a place of its own, worth
nothing, and each right row has a bidder that would take it, or the place of a candidate, for nothing. That problem always
has a full matching, and its best is the best of the first one.

In a round every bidder without a place bids for the place that is worth most to it at the present price: as much more as
makes the next best as good, and epsilon on top. Every place goes to its highest bid, ties to the lesser bidder. Rounds end
when all have a place. Epsilon falls from phase to phase, each beginning at the prices of the one before, so no phase is a
long war of small bids. At the end the total is within epsilon, times the rows of both sides, of the least possible.

A bidder's options are cut to the best two inside the tasks; nothing else of a hub's candidates meets in one. Rows of one
pair, null ends and null costs count once, not and not.
"""

from __future__ import annotations

import functools
import heapq
from collections import deque
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantry.operators import graph, relational
from gantry.operators.durable import written

#: Rounds that are planned as one, between two tables, and what epsilon is divided by from phase to phase.
ROUNDS, FALL = 3, 5.0
#: Pairs of a component up to which one task settles it.
LOCAL_PAIRS = 200_000


def _doubled(pairs: DataFrame) -> DataFrame:
    """(bidder, place, value) of pairs (a, b, value); bidders and places are (side, id), side 1 for those of the other's rows."""
    def name(side: int, c: str) -> Column:
        return F.struct(F.lit(side).alias("side"), F.col(c).cast("bigint").alias("id"))

    none = F.lit(0.0).alias("value")
    own = pairs.select(name(0, "a").alias("bidder"), name(1, "a").alias("place"), none).distinct()
    other = pairs.select(name(1, "b").alias("bidder"), name(0, "b").alias("place"), none).distinct()
    both = pairs.select(name(1, "b").alias("bidder"), name(1, "a").alias("place"), none)
    return pairs.select(name(0, "a").alias("bidder"), name(0, "b").alias("place"), "value").unionByName(own).unionByName(other).unionByName(both)


def _round(options: DataFrame, bidders: DataFrame, places: DataFrame, epsilon: float) -> DataFrame:
    """places (place, price, owner) after one round of bids."""
    placed = places.where("owner IS NOT NULL").select(F.col("owner").alias("bidder"))
    free = bidders.join(placed, "bidder", "left_anti")
    net = options.join(free, "bidder").join(places.select("place", "price"), "place").withColumn("net", F.col("value") - F.col("price"))
    two = net.withColumn("n", F.row_number().over(Window.partitionBy("bidder").orderBy(F.desc("net"), "place"))).where("n <= 2")
    first, second = F.when(F.col("n") == 1, F.struct("place", "price", "net")), F.when(F.col("n") == 2, F.col("net"))
    bids = two.groupBy("bidder").agg(F.max(first).alias("best"), F.max(second).alias("next"))
    bids = bids.select("bidder", F.col("best.place").alias("to"), (F.col("best.price") + F.col("best.net") - F.col("next") + epsilon).alias("bid"))
    highest = bids.groupBy("to").agg(F.max("bid").alias("bid"), F.min_by("bidder", F.struct(-F.col("bid"), "bidder")).alias("winner"))
    made = places.join(highest, F.col("place") == F.col("to"), "left")
    return made.select("place", F.coalesce("bid", "price").alias("price"), F.coalesce("winner", "owner").alias("owner"))


def _fallen(most: float, epsilon: float) -> list[float]:
    """The epsilons of the phases: a quarter of what a pair is worth at most, then ever less, and the last one asked for."""
    out = [max(epsilon, most / 4)]
    while out[-1] > epsilon:
        out.append(max(epsilon, out[-1] / FALL))
    return out


def _spread(pairs: DataFrame, epsilon: float) -> DataFrame:
    """(a, b) matched among pairs (a, b, value), each round a job over all of them."""
    options = written(_doubled(pairs))
    most = options.agg(F.max("value")).first()[0]
    if most is None:
        return pairs.select("a", "b")
    bidders = written(options.select("bidder").distinct())
    nobody = F.lit(None).cast(bidders.schema["bidder"].dataType).alias("owner")
    places = written(options.select("place", F.lit(0.0).alias("price"), nobody).distinct())
    for step in _fallen(most, epsilon):
        places = places.select("place", "price", nobody)
        while not places.where("owner IS NULL").isEmpty():
            for _ in range(ROUNDS):
                places = _round(options, bidders, places, step)
            places = written(places)
    return places.where("place.side = 0 AND owner.side = 0").select(F.col("owner.id").alias("a"), F.col("place.id").alias("b"))


def _in_turn(a: list[int], b: list[int], value: list[float], epsilon: float) -> list[tuple[int, int]]:
    """The same auction over one component inside a task, bidders one after the other."""
    options: dict[tuple[int, int], list[tuple[tuple[int, int], float]]] = {}
    for x, y, v in zip(a, b, value, strict=True):
        options.setdefault((0, x), [((1, x), 0.0)]).append(((0, y), v))
        options.setdefault((1, y), [((0, y), 0.0)]).append(((1, x), 0.0))
    price = {place: 0.0 for own in options.values() for place, _ in own}
    owner: dict[tuple[int, int], tuple[int, int]] = {}
    for step in _fallen(max(value), epsilon):
        owner = {}
        free = sorted(options, reverse=True)
        while free:
            bidder = free.pop()
            (second, _), (first, place) = heapq.nlargest(2, ((v - price[p], p) for p, v in options[bidder]))[::-1]
            price[place] += first - second + step
            if place in owner:
                free.append(owner[place])
            owner[place] = bidder
    return [(bidder[1], place[1]) for place, bidder in owner.items() if place[0] == bidder[0] == 0]


def assign(candidates: DataFrame, reach: float, epsilon: float) -> DataFrame:
    """(a, b, cost): a matching of candidates (a, b, cost), whole numbers a and b, whose sum of costs, and of `reach` for each left row alone, is the least but for epsilon a row.

    Components of the candidates do not touch each other's prices. Those of up to LOCAL_PAIRS pairs are dealt to tasks whole;
    larger ones bid in rounds over the cluster.
    """
    pairs = candidates.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("cost") < reach)).groupBy("a", "b").agg(F.min("cost").alias("cost"))
    pairs = written(pairs.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"), "cost", (reach - F.col("cost")).cast("double").alias("value")))
    links = written(pairs.select((2 * F.col("a")).alias("src"), (2 * F.col("b") + 1).alias("dst")))
    of = graph.components(links.select(F.explode(F.array("src", "dst")).alias("id")).distinct(), links)
    named = written(pairs.join(of.select(F.col("id").alias("of"), "component"), 2 * F.col("a") == F.col("of")).select("a", "b", "value", "component"))
    large = written(named.groupBy("component").count().where(F.col("count") > LOCAL_PAIRS).select("component"))

    def solve(t: pa.Table) -> pa.Table:
        made = _in_turn(*(t[c].to_pylist() for c in ("a", "b", "value")), epsilon)
        return pa.table([pa.array([x[k] for x in made], pa.int64()) for k in (0, 1)], ["a", "b"])

    won = named.join(large, "component", "left_anti").groupBy("component").applyInArrow(solve, "a bigint, b bigint")
    if not large.isEmpty():
        won = won.unionByName(_spread(named.join(large, "component", "left_semi").select("a", "b", "value"), epsilon))
    return won.join(pairs.select("a", "b", "cost"), ["a", "b"])


# points by place

#: Edge of a cube of space, in reaches, and the ways that space is cut into cubes: in three of four cuts at most is a point nearer than a reach to a face (an edge of 8 would just do; the rest is for rounding).
CUBE, CUTS = 8.5, 4
#: Lots and bidders (not rows of theirs) up to which a cube may grow.
CUBE_ROWS = 200_000
#: Rows of one flow that come of one row when flows become rows.
ROWS_AT_ONCE = 10_000


def _bids(at: np.ndarray, lots: list[tuple[int, float, tuple | None, int]], free: list[tuple[tuple, int]], inner, reach: float, epsilon: float) -> tuple[list, list]:
    """Bids inside one cube till none of its own bidders is free: (lots, free) after them.

    at holds the coordinates of the cube's right places, sorted; a lot is (place, price, owner or None, rows). Owners and
    bidders are the coordinates of left places. Whoever is not inner bids in another cut.
    """
    heaps: list[list] = [[] for _ in range(len(at))]
    names: dict[tuple, int] = {}
    rows: list[int] = []
    mine: list[bool] = []

    def number(who: tuple) -> int:
        k = names.setdefault(who, len(names))
        if k == len(rows):
            rows.append(0)
            mine.append(inner(who))
        return k

    for j, price, who, n in lots:
        heapq.heappush(heaps[j], (price, -1 if who is None else number(who), n))
    for who, n in free:
        rows[number(who)] += n
    who_of = list(names)
    price = np.array([h[0][0] if h else np.inf for h in heaps])
    near: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    waiting = deque(k for k in range(len(rows)) if rows[k] and mine[k])
    while waiting:
        k = waiting.popleft()
        if not rows[k]:
            continue
        if k not in near:
            p = np.array(who_of[k])
            a, z = np.searchsorted(at[:, 0], (p[0] - reach, p[0] + reach))
            worth = reach - np.sqrt(((at[a:z] - p) ** 2).sum(axis=1))
            hit = np.flatnonzero(worth > 0)
            near[k] = (hit + a, worth[hit])
        where, worth = near[k]
        while rows[k]:
            net = worth - price[where]
            best = int(net.argmax()) if len(net) else 0
            if not len(net) or net[best] <= 0:
                rows[k] = 0  # prices only rise: these rows stay alone
                break
            j, top = int(where[best]), net[best]
            net[best] = 0
            bid = float(price[j] + top - max(0.0, net.max()) + epsilon)
            heap = heaps[j]
            taken = 0
            while rows[k] and heap and heap[0][0] <= bid - epsilon / 2:
                was, owner, n = heapq.heappop(heap)
                some = min(n, rows[k])
                if some < n:
                    heapq.heappush(heap, (was, owner, n - some))
                rows[k] -= some
                taken += some
                if owner >= 0:
                    if not rows[owner] and mine[owner] and owner != k:
                        waiting.append(owner)
                    rows[owner] += some
                if owner == k:
                    break
            heapq.heappush(heap, (bid, k, taken))
            price[j] = heap[0][0]
    out: dict[tuple, int] = {}
    for j, heap in enumerate(heaps):
        for p, k, n in heap:
            name = (j, p, k)
            out[name] = out.get(name, 0) + n
    return [(j, p, who_of[k] if k >= 0 else None, n) for (j, p, k), n in out.items()], [(who_of[k], n) for k, n in enumerate(rows) if n]


def _in_cubes(start: float, edge: float, reach: float, epsilon: float) -> Callable[[pa.Table], pa.Table]:
    """What is done to the lots and free rows of one cube, of a cut whose faces go through start."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([(c, "ascending") for c in ("x", "y", "z", "price", "ox", "oy", "oz")])
        points = np.stack([t[c].to_numpy() for c in "xyz"], axis=1)
        lot, price, n = t["lot"].to_numpy(zero_copy_only=False), t["price"].to_numpy(), t["n"].to_numpy()
        owners = np.stack([t[c].to_numpy(zero_copy_only=False) for c in ("ox", "oy", "oz")], axis=1)
        corner = np.floor((points[0] - start) / edge) * edge + start
        at, of = np.unique(points[lot], axis=0, return_inverse=True)

        def inner(who: tuple) -> bool:
            return all(c + reach <= x <= c + edge - reach for x, c in zip(who, corner.tolist(), strict=True))

        names = [None if x[0] != x[0] else tuple(x) for x in owners[lot].tolist()]
        sold, left_over = _bids(
            at, list(zip(of.reshape(-1).tolist(), price[lot].tolist(), names, n[lot].tolist(), strict=True)), list(zip(map(tuple, points[~lot].tolist()), n[~lot].tolist(), strict=True)), inner, reach, epsilon
        )
        rows = [(*at[j].tolist(), p, *(who or (None,) * 3), k, True) for j, p, who, k in sold] + [(*who, 0.0, None, None, None, k, False) for who, k in left_over]
        kinds = [pa.float64()] * 7 + [pa.int64(), pa.bool_()]
        return pa.table([pa.array(c, kind) for c, kind in zip(list(zip(*rows, strict=True)) or [[]] * 9, kinds, strict=True)], t.column_names[:9])

    return run


def place_flows(left: DataFrame, right: DataFrame, reach: float, epsilon: float) -> DataFrame:
    """(ax, ay, az, bx, by, bz, n): how many rows of each left place (x, y, z, n) go to each right one, by an auction between places.

    A place's rows are alike, so each place is one bidder for several, or one thing sold in lots; its price is that of its
    cheapest lot. Prices begin at 0 and a row that no place is worth anything to stays alone, so what is never sold costs
    nothing and the total is within epsilon a matched row of the least. Space is cut into cubes, in CUTS ways in turn. In a
    cut, no two cubes have a place in common, and a bidder at least `reach` away from its cube's faces sees all its
    candidates inside; so a cube's bids are one task's, of any number of steps. Each point is so far inside in one cut at least.
    The few that are free after all cuts bid in cubes of twice the edge, as long as none of these holds more than CUBE_ROWS lots.
    """
    edge = CUBE * reach
    shape = "x double, y double, z double, price double, ox double, oy double, oz double, n bigint, lot boolean"
    none = F.lit(None).cast("double")
    lots = right.select("x", "y", "z", F.lit(0.0).alias("price"), none.alias("ox"), none.alias("oy"), none.alias("oz"), F.col("n").cast("bigint").alias("n"), F.lit(True).alias("lot"))
    free = left.select("x", "y", "z", F.lit(0.0).alias("price"), none.alias("ox"), none.alias("oy"), none.alias("oz"), F.col("n").cast("bigint").alias("n"), F.lit(False).alias("lot"))
    state = written(lots.unionByName(free))
    turn = 0
    tasks = 4 * left.sparkSession.sparkContext.defaultParallelism  # a cube is long work on few bytes, so cubes are not to share a task
    cube = [f"cube_{c}" for c in "xyz"]

    def in_cut(turn: int, edge: float) -> tuple[float, DataFrame]:
        start = edge / CUTS * (turn % CUTS)
        return start, state.withColumns({k: F.floor((F.col(c) - start) / edge) for k, c in zip(cube, "xyz", strict=True)})

    turn = 0
    while not state.where("NOT lot").isEmpty():
        if turn and turn % CUTS == 0:
            counts = [in_cut(k, 2 * edge)[1].groupBy(*cube).count().select("count") for k in range(CUTS)]
            if functools.reduce(DataFrame.union, counts).agg(F.max("count")).first()[0] <= CUBE_ROWS:
                edge *= 2
        start, named = in_cut(turn, edge)
        state = written(named.repartition(tasks, *cube).groupBy(*cube).applyInArrow(_in_cubes(start, edge, reach, epsilon), shape))
        turn += 1
    sold = state.where("lot AND ox IS NOT NULL")
    return sold.groupBy(F.col("ox").alias("ax"), F.col("oy").alias("ay"), F.col("oz").alias("az"), F.col("x").alias("bx"), F.col("y").alias("by"), F.col("z").alias("bz")).agg(F.sum("n").alias("n"))


def assign_points(left: DataFrame, right: DataFrame, reach: float, epsilon: float) -> DataFrame:
    """(a, b, cost): points (id, x, y, z) of the left matched with those of the right by distance below reach, as assign(); ids are unique, and points of one place alike.

    What goes from place to place is found by place_flows(); the rows of a place are then dealt to its flows by id.
    """
    axes = ["x", "y", "z"]
    finite = " AND ".join(f"abs({c}) < double('inf')" for c in axes)
    point = [(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in axes]  # no -0.0 beside 0.0
    left, right = (written(d.where(F.col("id").isNotNull()).select("id", *point).where(finite).distinct()) for d in (left, right))
    flows = written(place_flows(*(d.groupBy(*axes).agg(F.count("*").alias("n")) for d in (left, right)), reach, epsilon))
    one, other = ["ax", "ay", "az"], ["bx", "by", "bz"]

    def until(by: list[str], of: list[str]) -> Column:
        return F.sum("n").over(Window.partitionBy(*by).orderBy(*of)) - F.col("n")

    flows = flows.withColumns({"a_from": until(one, other), "b_from": until(other, one)})
    some = flows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(ROWS_AT_ONCE).cast("bigint"))).alias("first"))
    units = some.select("*", F.explode(F.sequence("first", F.least("n", F.col("first") + ROWS_AT_ONCE) - 1)).alias("k"))
    cost = F.sqrt(sum((F.col(p) - F.col(q)) ** 2 for p, q in zip(one, other, strict=True)))
    units = units.select(*one, *other, (F.col("a_from") + F.col("k") + 1).alias("a_at"), (F.col("b_from") + F.col("k") + 1).alias("b_at"), cost.alias("cost"))

    def placed(d: DataFrame, s: str) -> DataFrame:
        rows = relational.place_in(d.withColumn("at", F.struct(*axes)), "at", [F.col("id")], "n")
        return rows.select(F.col("id").alias(s), *[F.col(f"at.{c}").alias(f"{s}{c}") for c in axes], F.col("n").alias(f"{s}_at"))

    made = units.join(placed(left, "a"), [*one, "a_at"]).join(placed(right, "b"), [*other, "b_at"])
    return made.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"), "cost")
