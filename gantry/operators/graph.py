"""Graph operators over edge tables; iterative ones cut their lineage by checkpoints."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

import gantry
from gantry.operators import alone, told
from gantry.operators.cycles import break_cycles, strongly_connected  # noqa: F401
from gantry.operators.durable import bucketed, buckets_of, cut, written
from gantry.operators.relational import canonical_pairs, keep_first, place_in

# Executors need not have this package on their path: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(gantry)

#: Edges that one task of triangles holds, and pairs of edges it looks at side by side.
EDGES_A_TASK, WEDGES_AT_ONCE = 12_000_000, 2_000_000
#: Edges that one job of triangles sends to its tasks, if it need not send all once.
SENT_AT_ONCE = 100_000_000


def degrees(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, degree) of every node; pairs are canonical."""
    ends = pairs.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    return nodes.select("id").join(ends, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"))


def centrality(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """degree / (n - 1); 1 where there is one node at most."""
    n = nodes.agg(F.count("*")).scalar()
    return degrees(nodes, pairs).withColumn("centrality", F.when(n <= 1, F.lit(1.0)).otherwise(F.col("degree") / (n - 1)))


def _in_one_part(u: np.ndarray, v: np.ndarray, role: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, triangles at each) of one triple of parts; edges of role 0 lie away from its apex part, of role 1 lead from there (u), of role 2 lie in the one part there is."""
    base, apex = (role != 1), (role == 1)
    bu, bv = u[base], v[base]
    au, av = np.concatenate([u[apex], u[role == 2], v[role == 2]]), np.concatenate([v[apex], v[role == 2], u[role == 2]])
    ids, place = np.unique(np.concatenate([bu, bv, au, av]), return_inverse=True)
    bu, bv, au, av = np.split(place, np.cumsum([len(bu), len(bv), len(au)]))
    n, met = len(ids), np.zeros(len(ids), np.int64)
    key = np.sort(av * n + au)  # the apex nodes of each other end, in order
    first = np.searchsorted(key, np.arange(n + 1) * n)
    size = np.diff(first)
    turn = size[bu] > size[bv]  # those of the end with fewer are looked for at the other
    few, many = np.where(turn, bv, bu), np.where(turn, bu, bv)
    one = bool((role == 2).any())
    until = np.cumsum(size[few])
    at = 0
    while at < len(few):
        to = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + WEDGES_AT_ONCE)))
        f, m = few[at:to], many[at:to]
        reps = size[f]
        row = np.repeat(np.arange(len(f)), reps)
        top = key[np.repeat(first[f] - np.cumsum(reps) + reps, reps) + np.arange(len(row))] % n
        wanted = m[row] * n + top
        hit = key[np.minimum(np.searchsorted(key, wanted), len(key) - 1)] == wanted if len(key) else np.zeros(0, bool)
        if one:  # each of its triangles lies over three edges: it counts over that of its two greater nodes
            hit &= top < np.minimum(f[row], m[row])
        for c in (top[hit], f[row][hit], m[row][hit]):
            met += np.bincount(c, minlength=n)
        at = to
    return ids[met > 0], met[met > 0]


def triangles(pairs: DataFrame) -> DataFrame:
    """(id, t) of the nodes with triangles, t of them; pairs are canonical.

    Nodes are dealt to parts by hash. Each triple of parts gets the edges among its nodes and counts the triangles whose
    nodes lie in just these parts, from the end of each edge that has fewer neighbours. So an edge is sent as often as there
    are parts, and no two edges of a node are paired outside a task; parts are so many that a task has about EDGES_A_TASK.
    Triples take turns by the sum of their parts: in each of p turns an edge goes to just one triple. A job takes as many
    turns as send SENT_AT_ONCE edges, one at least, and what it has shuffled is gone before the next begins.
    """
    n = pairs.count()
    p = max(1, math.ceil(math.sqrt(9 * n / EDGES_A_TASK)))
    turns = max(1, min(p, SENT_AT_ONCE // max(n, 1)))
    found = [written(_triangles_in_turns(pairs, p, range(t, min(p, t + turns)))) for t in range(0, p, turns)]
    return functools.reduce(DataFrame.unionByName, found).groupBy("id").agg(F.sum("t").alias("t"))


def _triangles_in_turns(pairs: DataFrame, p: int, turns: range) -> DataFrame:
    """(id, t) of the triples of p parts whose turn it is; an id may come from several."""
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(p)).cast("int")
    e = pairs.select("src", "dst", part("src").alias("x"), part("dst").alias("y"))
    e = e.withColumn("w", F.explode(F.array(*[F.pmod(F.lit(t) - F.col("x") - F.col("y"), F.lit(p)) for t in turns])))
    x, y, w = F.col("x"), F.col("y"), F.col("w")
    lone = F.when(x == y, w).when(w == x, y).when(w == y, x).otherwise(F.least(x, y, w))  # the apex part
    role = F.when((x == y) & (x == w), 2).when((lone == x) | (lone == y), 1).otherwise(0)
    swap = (role == 1) & (lone == y)
    u, v = F.when(swap, F.col("dst")).otherwise(F.col("src")), F.when(swap, F.col("src")).otherwise(F.col("dst"))
    name = F.array_sort(F.array(x, y, w))
    e = e.select((name[0] * p * p + name[1] * p + name[2]).alias("triple"), role.cast("byte").alias("role"), u.alias("u"), v.alias("v"))
    e = e.repartition(max(1, (p + 1) * (p + 2) * len(turns) // 6), "triple")

    def count(t: pa.Table) -> pa.Table:
        ids, met = _in_one_part(*(t[c].to_numpy() for c in ("u", "v", "role")))
        return pa.table([pa.array(ids, pa.int64()), pa.array(met, pa.int64())], ["id", "t"])

    return e.groupBy("triple").applyInArrow(count, "id bigint, t bigint")


def clustering(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """2 * triangles / (d * (d - 1)); 0 where d < 2."""
    pairs = written(pairs.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst")))
    d = degrees(nodes, pairs).join(triangles(pairs), "id", "left").withColumn("t", F.coalesce("t", F.lit(0)))
    value = F.when(F.col("degree") < 2, 0.0).otherwise(2.0 * F.col("t") / (F.col("degree") * (F.col("degree") - 1)))
    return d.select("id", "degree", F.col("t").alias("triangles"), F.round(value, 6).alias("clustering"))


def components(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, component): the least id reachable along pairs of these nodes.

    In each round every part that touches one of lesser name goes into the least of them, chains of such steps are followed
    to their ends by doubling, and parts become the nodes of what is left. So all pairs are passed over once, and few of
    them join two parts after that.
    """
    label = written(nodes.select("id", F.col("id").alias("component")))
    ends = lambda c: nodes.select(F.col("id").alias(c))
    left = written(canonical_pairs(pairs.select("src", "dst")).join(ends("src"), "src", "left_semi").join(ends("dst"), "dst", "left_semi"))
    while not left.isEmpty():
        up = written(left.groupBy(F.col("dst").alias("part")).agg(F.min("src").alias("to")))
        while True:
            further = up.select(F.col("part").alias("mid"), F.col("to").alias("far"))
            up = written(up.select("part", "to").join(further, F.col("to") == F.col("mid"), "left").select("part", F.coalesce("far", "to").alias("to"), F.col("far").isNotNull().alias("moved")))
            if up.where("moved").isEmpty():
                break
        label = written(label.join(up.select("part", "to"), F.col("component") == F.col("part"), "left").select("id", F.coalesce("to", "component").alias("component")))
        one, other = up.select(F.col("part").alias("src"), F.col("to").alias("a")), up.select(F.col("part").alias("dst"), F.col("to").alias("b"))
        now = left.join(one, "src", "left").join(other, "dst", "left").select(F.coalesce("a", "src").alias("src"), F.coalesce("b", "dst").alias("dst"))
        left = written(canonical_pairs(now))
    return label


def longest_path(edges: DataFrame) -> DataFrame:
    """(id, depth, before): the most edges on a path that ends at each node of an acyclic graph, and the least node before it there.

    A node is done in the step after the last that leads to it, and its depth is that step's number. So every edge is
    followed once, from the nodes that have just been done, and a graph with a cycle is told when no node is left to do.
    Edges lie in buckets by src and are not moved in a step; nodes that are done leave the table of the next step, and the
    edges into them go each time that half of the nodes have left. Once the edges left fit one task, it takes all further
    steps, as a step of its own costs a job more than its edges do.
    """
    edges = written(edges.select("src", "dst"))
    if alone.fits(edges):
        return _path_alone(edges, 0)
    edges = bucketed(edges, "src", buckets_of(edges, edges.count()))
    into = edges.groupBy(F.col("dst").alias("into")).agg(F.count("*").alias("n"))
    ids = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct().join(into, F.col("id") == F.col("into"), "left")
    first = F.when(F.col("n").isNull(), 0).alias("depth")
    state = written(ids.select("id", F.coalesce("n", F.lit(0)).alias("open"), first, F.lit(None).cast(edges.schema["src"].dataType).alias("before")))
    steps, depth, at_first = [], 0, state.count()
    while True:
        steps += state.inputFiles()
        new, left = state.agg(F.count("depth"), F.count_if(F.col("depth").isNull())).first()
        if not new:
            break
        rest = state.where("depth IS NULL").select("id", "open")
        if 2 * left < at_first:
            edges = written(edges.join(rest.select(F.col("id").alias("dst")).hint("shuffle_hash"), "dst", "left_semi").select("src", "dst"))
            if alone.fits(edges):  # edges of nodes that are done have been followed, but for those just done
                gone = state.sparkSession.read.schema(state.schema).parquet(*steps).where(F.col("depth") < depth).select(F.col("id").alias("src"))
                behind = _path_alone(edges.join(gone, "src", "left_anti"), depth).where("before IS NOT NULL")
                known = state.sparkSession.read.schema(state.schema).parquet(*steps).where("depth IS NOT NULL").select("id", "depth", "before")
                return known.unionByName(behind)
            edges, at_first = bucketed(edges, "src", buckets_of(edges, edges.count())), left
        told = edges.join(state.where("depth IS NOT NULL").select(F.col("id").alias("src")).hint("shuffle_hash"), "src").groupBy(F.col("dst").alias("to")).agg(F.count("*").alias("n"), F.min("src").alias("least"))
        depth += 1
        still = F.col("open") - F.coalesce("n", F.lit(0))
        state = written(rest.join(told, F.col("id") == F.col("to"), "left").select("id", still.alias("open"), F.when(still == 0, depth).alias("depth"), F.when(still == 0, F.col("least")).alias("before")))
    if left:
        raise ValueError("the graph has a cycle")
    return edges.sparkSession.read.schema(state.schema).parquet(*steps).where("depth IS NOT NULL").select("id", "depth", "before")


def _path_alone(edges: DataFrame, at_first: int) -> DataFrame:
    """longest_path() in one task; nodes without a way in have depth `at_first`."""
    kind = edges.schema["src"].dataType.simpleString()

    def settle(t: pa.Table) -> pa.Table:
        names, (src, dst) = alone.coded(t, "src", "dst")
        depth, before = alone.depths(src, dst, len(names))
        return pa.table([names, pa.array(depth + at_first, pa.int32(), mask=depth < 0), names.take(pa.array(before, mask=before < 0))], ["id", "depth", "before"])

    made = written(alone.in_one_task(edges, f"id {kind}, depth int, before {kind}", settle))
    if not made.where("depth IS NULL").isEmpty():
        raise ValueError("the graph has a cycle")
    return made


def _walk_alone(state: DataFrame) -> DataFrame:
    """The way back from the deepest node (the least of equals), in one task."""
    kind = state.schema["id"].dataType.simpleString()

    def walk(t: pa.Table) -> pa.Table:
        names, (ids,) = alone.coded(t, "id")
        depth = t["depth"].to_numpy()
        back = np.full(len(names), -1, np.int64)
        prior = pc.index_in(t["before"], value_set=names)
        back[ids] = prior.fill_null(-1).to_numpy()
        way = [int(ids[np.lexsort((ids, -depth))[0]])]
        while back[way[-1]] >= 0:
            way.append(int(back[way[-1]]))
        return pa.table([names.take(pa.array(way))], ["id"])

    return alone.in_one_task(state, f"id {kind}", walk)


def critical_chain(edges: DataFrame) -> DataFrame:
    """(step, id, edge_type) along a longest path of an acyclic graph (src, dst, edge_type); of equals that to the least end.

    The way back from the end is walked by one task if that can hold all nodes, and found by doubling if not: in each round
    all found so far jump twice as far.
    """
    state = cut(longest_path(edges))
    chain = cut(_walk_alone(state)) if alone.fits(state, ("id",)) else _by_doubling(state)
    steps = state.join(chain.select("id"), "id").select("id", F.col("depth").alias("step"), "before")
    kinds = edges.select("src", "dst", "edge_type")
    made = steps.join(kinds, (steps["before"] == kinds["src"]) & (steps["id"] == kinds["dst"]), "left")
    return made.select("step", "id", F.coalesce("edge_type", F.lit("")).alias("edge_type"))


def _by_doubling(state: DataFrame) -> DataFrame:
    end = state.orderBy(F.desc("depth"), "id").limit(1)
    chain = cut(end.select("id", F.col("depth").alias("step")))
    jump = cut(state.where("before IS NOT NULL").select(F.col("id").alias("at"), "before"))
    while True:
        more = chain.join(jump, chain["id"] == jump["at"]).select(F.col("before").alias("id"))
        wider = cut(chain.select("id").unionByName(more).distinct())
        if wider.count() == chain.count():
            return chain
        chain = wider
        far = jump.select(F.col("at").alias("mid"), F.col("before").alias("further"))
        jump = cut(jump.join(far, F.col("before") == F.col("mid")).select("at", F.col("further").alias("before")))


def install_rank(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, rank) from 1 without gaps in an order in which each edge goes up; nodes without edges come last, by id."""
    levels = topological_levels(edges)
    known = nodes.select("id").join(levels, "id", "left").withColumn("one", F.lit(0))
    return place_in(known, "one", [F.col("level").isNull(), F.col("level"), F.col("id")], "rank").select("id", "rank")


def topological_levels(edges: DataFrame) -> DataFrame:
    """(id, level): nodes with no open predecessor are peeled off round by round; a cycle raises."""
    return longest_path(edges).select("id", F.col("depth").alias("level"))


def closure(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(node, ancestor, depth) over parent edges of a hierarchy, by doubling the reach of each round."""
    reach = cut(edges.where(F.col(parent).isNotNull()).select(F.col(child).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("depth")).distinct())
    while True:
        more = reach.join(reach.select(F.col("node").alias("mid"), F.col("ancestor").alias("far"), F.col("depth").alias("d")), F.col("ancestor") == F.col("mid")).select("node", F.col("far").alias("ancestor"), (F.col("depth") + F.col("d")).alias("depth"))
        new = cut(reach.union(more).groupBy("node", "ancestor").agg(F.min("depth").alias("depth")))
        if new.count() == reach.count():
            return new
        reach = new


def zones(nodes: DataFrame, pairs: DataFrame, resolution: float = 1.0, least_gain: float = 1e-4) -> DataFrame:
    """(id, zone): communities by modularity, zone = least member.

    In each round every node of one half (by hash and round) moves to the neighbouring community with the greatest gain
    sum of links - resolution * degree * community degree / 2m, if that beats staying, until modularity rises by no
    more than `least_gain`. Then communities become nodes, and the same goes on between them until a level gains no
    more. A stated deviation from sequential schemes: the result is deterministic, covers all nodes, and does not equal
    theirs node for node.
    """
    pairs = written(pairs.select("src", "dst"))
    both = pairs.union(pairs.select("dst", "src")).where("src <> dst")
    if told.fits(nodes):
        return told.zones(nodes, both.groupBy("src", "dst").agg(F.count("*").cast("double").alias("w")), resolution, least_gain)
    dealt = buckets_of(pairs, 2 * pairs.count())
    links = bucketed(both, "dst", dealt, lambda d: d.groupBy("src", "dst").agg(F.count("*").cast("double").alias("w")))
    deg = links.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("degree"))
    deg = written(nodes.select("id").join(deg, "id", "left").fillna(0.0, ["degree"]))
    total = links.agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0] or 1.0
    member, within, reached = deg.select("id", F.col("id").alias("zone")), 0.0, None
    while True:
        label, began, got = _moves(links, deg, total, within, resolution, least_gain)
        if got <= (began if reached is None else reached) + least_gain:
            break
        reached = got
        member = written(member.join(label.select(F.col("id").alias("zone"), F.col("zone").alias("into")), "zone").select("id", F.col("into").alias("zone")))
        between = links.join(label.withColumnsRenamed({"id": "src", "zone": "a"}), "src").join(label.withColumnsRenamed({"id": "dst", "zone": "b"}), "dst")
        between = written(between.groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("w").alias("w")))
        within += between.where("src = dst").agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
        links = bucketed(between.where("src <> dst"), "dst", buckets_of(between, between.count()))
        deg = written(deg.join(label, "id").groupBy(F.col("zone").alias("id")).agg(F.sum("degree").alias("degree")))
    names = member.groupBy("zone").agg(F.min("id").alias("least"))
    return member.join(names, "zone").select("id", F.col("least").alias("zone"))


def _moves(links: DataFrame, deg: DataFrame, total: float, within: float, resolution: float, least_gain: float, patience: int = 2) -> tuple[DataFrame, float, float]:
    """(best labels, modularity of nodes alone, modularity of these labels) of one level; ends after `patience` pairs of rounds without a gain.

    Links lie in buckets by dst. What they tell of zones is dealt once by src, and all that follows stays there: in a round
    no link is moved twice. A round also finds the links inside the zones that it began with, so modularity needs no pass of
    its own; in the second of a pair only links of nodes whose turn it is are followed.
    """
    label = best = deg.select("id", F.col("id").alias("zone"))
    tasks = buckets_of(links, links.count())
    began = got = 0.0
    k, idle = 0, 0
    while True:
        turn = F.pmod(F.xxhash64("src", F.lit(k)), F.lit(2)) == 0
        named = label.join(deg, "id")
        weight = named.groupBy("zone").agg(F.sum("degree").alias("zone_degree"))
        known = written(named.join(weight, "zone").select("id", "zone", "degree", "zone_degree"))
        asked = links.where(turn) if k % 2 else links
        near = asked.join(known.select(F.col("id").alias("dst"), "zone", "zone_degree").hint("shuffle_hash"), "dst").select("src", "zone", "zone_degree", "w")
        every = near.union(known.select("id", "zone", "zone_degree", F.lit(0.0))).repartition(tasks, "src")
        options = every.groupBy("src", "zone").agg(F.sum("w").alias("links"), F.max("zone_degree").alias("zone_degree"))
        own = known.select(F.col("id").alias("src"), F.col("zone").alias("own"), "degree")
        options = options.join(own.hint("shuffle_hash"), "src")
        stays = F.col("zone") == F.col("own")
        gain = F.col("links") - resolution * F.col("degree") * (F.col("zone_degree") - F.when(stays, F.col("degree")).otherwise(0.0)) / F.lit(total)
        to = options.groupBy("src").agg(F.min(F.struct((-gain).alias("loss"), "zone"))["zone"].alias("zone"), F.max("own").alias("own"), F.sum(F.when(stays, F.col("links")).otherwise(0.0)).alias("inside"))
        step = written(to.select(F.col("src").alias("id"), F.when(turn, F.col("zone")).otherwise(F.col("own")).alias("zone"), "inside"))
        if k % 2 == 0:
            inside = step.agg(F.coalesce(F.sum("inside"), F.lit(0.0))).first()[0]
            square = weight.agg(F.coalesce(F.sum(F.col("zone_degree") * F.col("zone_degree")), F.lit(0.0))).first()[0]
            now = (within + inside) / total - resolution * square / total**2
            if k == 0:
                began = got = now
            else:
                idle = 0 if now > got + least_gain else idle + 1
            if now > got:
                best, got = label, now
            if idle >= patience:
                return best, began, got
        label = step.select("id", "zone")
        k += 1


def precedence(objects: DataFrame, pairs: DataFrame, bin_height: float = 3.0, least_rise: float = 0.01) -> DataFrame:
    """(src, dst, edge_type) over objects (id, zone, rank, cls, z): one edge for two, class order before vertical before interference.

    Class order: the first object of each rank to that of the next rank in its zone. Vertical: the same of height bins
    within zone and class. Interference: touching objects of one class, from the lower to the higher.
    """
    steps = objects.withColumn("bin", F.rint(F.col("z") / bin_height).cast("bigint"))

    def chain(by: list[str], at: str, name: str) -> DataFrame:
        first = steps.where(F.col(at).isNotNull()).groupBy(*by, at).agg(F.min("id").alias("src"))
        following = F.lead("src").over(Window.partitionBy(*by).orderBy(at))
        return first.withColumn("dst", following).where("dst IS NOT NULL").select("src", "dst", F.lit(name).alias("edge_type"))

    side = steps.select("id", "cls", "z")
    met = canonical_pairs(pairs).join(side.select(F.col("id").alias("src"), F.col("cls").alias("ca"), F.col("z").alias("za")), "src").join(side.select(F.col("id").alias("dst"), F.col("cls").alias("cb"), F.col("z").alias("zb")), "dst")
    met = met.where((F.col("ca") == F.col("cb")) & (F.abs(F.col("za") - F.col("zb")) >= least_rise))
    up = F.col("za") < F.col("zb")
    touch = met.select(F.when(up, F.col("src")).otherwise(F.col("dst")).alias("src"), F.when(up, F.col("dst")).otherwise(F.col("src")).alias("dst"), F.lit("interference").alias("edge_type"))
    every = chain(["zone"], "rank", "class_order").unionByName(chain(["zone", "cls"], "bin", "vertical")).unionByName(touch)
    order = F.expr("CASE edge_type WHEN 'class_order' THEN 0 WHEN 'vertical' THEN 1 ELSE 2 END")
    return keep_first(every.withColumn("_o", order), ["src", "dst"], [F.asc("_o")]).drop("_o")
