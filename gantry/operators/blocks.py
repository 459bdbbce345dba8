"""Blocks of an undirected graph that hold together when any one node goes, and what each node's removal breaks.

A spanning forest is grown by rounds in which every part takes its least edge to another (parts at least halve). An Euler
tour runs along both sides of each tree edge; its order is found by doubling the jumps along the tour, and gives every node
the range of its subtree. Least and greatest places that a subtree reaches by edges outside the tree are minima over ranges,
again by doubling. Two tree edges are in one block where an edge outside the tree closes a cycle through both: those pairs
are the links of an auxiliary graph on tree edges, whose components are the blocks. So rounds grow with the logarithm of the
nodes, also on long chains, and no task holds a hub's neighbours or a tree.

Pairs are canonical (src < dst, each once), as relational.canonical_pairs makes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.operators import graph
from gantry.operators.durable import written
from gantry.operators.relational import row_before

#: Places before and behind all others: those of a root.
_FIRST, _LAST = -(1 << 62), 1 << 62


def spanning_forest(nodes: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((src, dst) of the forest's edges, (id, root) of every node)."""
    label = written(nodes.select("id", F.col("id").alias("root")))
    left = written(pairs.select("src", "dst", F.col("src").alias("a"), F.col("dst").alias("b")))
    tree = left.select("src", "dst").limit(0)
    while not left.isEmpty():
        ways = left.select(F.col("a").alias("part"), F.struct("src", "dst", F.col("b").alias("to")).alias("edge")).union(left.select("b", F.struct("src", "dst", F.col("a").alias("to"))))
        picked = written(ways.groupBy("part").agg(F.min("edge").alias("edge")).select("part", "edge.*"))
        tree = tree.unionByName(picked.select("src", "dst").distinct())
        # two parts that took the same edge: the lesser stays where it is
        back = picked.select(F.col("part").alias("other"), F.col("to").alias("back"))
        up = picked.join(back, F.col("to") == F.col("other")).select("part", F.when((F.col("back") == F.col("part")) & (F.col("part") < F.col("to")), F.col("part")).otherwise(F.col("to")).alias("to"))
        up = written(up)
        while True:
            far = written(up.join(up.select(F.col("part").alias("mid"), F.col("to").alias("far")), F.col("to") == F.col("mid")).select("part", F.col("far").alias("to"), F.col("to").alias("was")))
            up = far.select("part", "to")
            if far.where("to <> was").isEmpty():
                break
        label = written(label.join(up, F.col("root") == F.col("part"), "left").select("id", F.coalesce("to", "root").alias("root")))
        one, other = up.select(F.col("part").alias("a"), F.col("to").alias("x")), up.select(F.col("part").alias("b"), F.col("to").alias("y"))
        left = written(left.join(one, "a").join(other, "b").where("x <> y").select("src", "dst", F.col("x").alias("a"), F.col("y").alias("b")))
    return written(tree), label


def toured(tree: DataFrame, label: DataFrame) -> DataFrame:
    """(id, parent, first, last, root) of every node with a parent: the places of the tour between which its subtree lies."""
    arcs = tree.select(F.col("src").alias("u"), F.col("dst").alias("v")).union(tree.select("dst", "src"))
    turn = row_before(arcs, "v", "u", ["v"], "before")
    most = arcs.groupBy(F.col("u").alias("at")).agg(F.max("v").alias("most"))
    # coming from v into u, the tour goes on to the neighbour before v, and from the first to the last; at a root it ends there
    turn = turn.join(most, F.col("u") == F.col("at")).join(label, F.col("u") == F.col("id"))
    end = F.col("before").isNull() & (F.col("u") == F.col("root"))
    to = F.when(~end, F.coalesce("before", "most"))
    tour = written(turn.select(F.col("v").alias("a"), F.col("u").alias("b"), F.when(~end, F.col("u")).alias("sa"), to.alias("sb"), F.when(end, 0).otherwise(1).cast("bigint").alias("left")))
    while not tour.where("sa IS NOT NULL").isEmpty():
        ahead = tour.select(F.col("a").alias("p"), F.col("b").alias("q"), F.col("sa").alias("ta"), F.col("sb").alias("tb"), F.col("left").alias("more"))
        jump = tour.join(ahead, (F.col("sa") == F.col("p")) & (F.col("sb") == F.col("q")), "left")
        tour = written(jump.select("a", "b", F.col("ta").alias("sa"), F.col("tb").alias("sb"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left")))
    back = tour.select(F.col("a").alias("p"), F.col("b").alias("q"), F.col("left").alias("back"))
    both = tour.join(back, (F.col("a") == F.col("q")) & (F.col("b") == F.col("p"))).where(F.col("left") > F.col("back"))
    found = both.select(F.col("b").alias("child"), F.col("a").alias("parent"), (-F.col("left")).alias("first"), (-F.col("back")).alias("last"))
    return written(found.join(label, F.col("child") == F.col("id")).select("id", "parent", "first", "last", "root"))


def range_ends(values: DataFrame, ranges: DataFrame) -> DataFrame:
    """(id, low, high): the least low and greatest high of values (root, place, low, high) between first and last of ranges (id, root, first, last).

    A place without values has NULLs. In round k every place knows the ends of the 2^k places from it on, and ranges of at
    least that and less than twice that length are answered by two of them.
    """
    table, k, found = written(values), 0, None
    asked = written(ranges.select("id", "root", "first", "last", F.floor(F.log2(F.col("last") - F.col("first") + 1)).alias("k")))
    while True:
        one = table.select(F.col("root").alias("r1"), F.col("place").alias("p1"), F.col("low").alias("l1"), F.col("high").alias("h1"))
        two = table.select(F.col("root").alias("r2"), F.col("place").alias("p2"), F.col("low").alias("l2"), F.col("high").alias("h2"))
        own = asked.where(F.col("k") == k)
        met = own.join(one, (F.col("root") == F.col("r1")) & (F.col("first") == F.col("p1"))).join(two, (F.col("root") == F.col("r2")) & (F.col("last") - ((1 << k) - 1) == F.col("p2")))
        now = written(met.select("id", F.least("l1", "l2").alias("low"), F.greatest("h1", "h2").alias("high")))
        found = now if found is None else found.unionByName(now)
        if asked.where(F.col("k") > k).isEmpty():
            return found
        ahead = two.withColumn("p2", F.col("p2") - (1 << k))
        wider = table.join(ahead, (F.col("root") == F.col("r2")) & (F.col("place") == F.col("p2")), "left")
        table = written(wider.select("root", "place", F.least("low", "l2").alias("low"), F.greatest("high", "h2").alias("high")))
        k += 1


def blocks(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(src, dst, block) of every pair: pairs are in one block where a cycle without repeated nodes runs through both; block is any name of it."""
    pairs = written(pairs.select("src", "dst"))
    tree, label = spanning_forest(nodes, pairs)
    tour = toured(tree, label)
    place = tour.select("id", "first", "last").unionByName(label.where("id = root").select("id", F.lit(_FIRST).cast("bigint").alias("first"), F.lit(_LAST).cast("bigint").alias("last")))
    place = written(place)

    def named(df: DataFrame) -> DataFrame:
        one, other = (place.select(F.col("id").alias(c), F.col("first").alias(f"{c}_first"), F.col("last").alias(f"{c}_last")) for c in ("src", "dst"))
        return df.join(one, "src").join(other, "dst")

    every = written(named(pairs))
    rest = every.join(tree, ["src", "dst"], "left_anti")
    reach = rest.select(F.col("src").alias("id"), F.col("dst_first").alias("to")).union(rest.select("dst", "src_first")).groupBy("id").agg(F.min("to").alias("low"), F.max("to").alias("high"))
    own = tour.join(reach.withColumnRenamed("id", "from"), F.col("id") == F.col("from"), "left")
    down = own.select("root", F.col("first").alias("place"), F.least("first", "low").alias("low"), F.greatest("first", "high").alias("high"))
    up = tour.select("root", F.col("last").alias("place"), F.lit(None).cast("bigint").alias("low"), F.lit(None).cast("bigint").alias("high"))
    ends = range_ends(down.unionByName(up), tour)
    # a tree edge goes by the name of its lower node
    over = place.select(F.col("id").alias("up"), F.col("first").alias("up_first"), F.col("last").alias("up_last"))
    leaving = tour.join(over, F.col("parent") == F.col("up")).join(ends.withColumnRenamed("id", "of"), F.col("id") == F.col("of")).where((F.col("low") < F.col("up_first")) | (F.col("high") > F.col("up_last")))
    inside = (F.col("src_first") <= F.col("dst_first")) & (F.col("dst_last") <= F.col("src_last"))
    around = (F.col("dst_first") <= F.col("src_first")) & (F.col("src_last") <= F.col("dst_last"))
    links = rest.where(~inside & ~around).select("src", "dst").unionByName(leaving.select(F.col("parent").alias("src"), F.col("id").alias("dst")))
    of = graph.components(tour.select("id"), links)
    later = F.when(F.col("src_first") > F.col("dst_first"), F.col("src")).otherwise(F.col("dst"))
    return written(every.withColumn("lower", later).join(of, F.col("lower") == F.col("id")).select("src", "dst", F.col("component").alias("block")))


def removal_of_each(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, blocks, more, is_cut): how many components more there are without each node alone; a lone node leaves one less."""
    found = blocks(nodes, pairs)
    held = found.select(F.explode(F.array("src", "dst")).alias("of"), "block").groupBy("of").agg(F.count_distinct("block").alias("blocks"))
    n = F.coalesce("blocks", F.lit(0))
    return nodes.select("id").join(held, F.col("id") == F.col("of"), "left").select("id", n.alias("blocks"), (n - 1).alias("more"), (n > 1).alias("is_cut"))


def fragmentation(nodes: DataFrame, pairs: DataFrame, gone: DataFrame) -> DataFrame:
    """(grp, before, after, more): components of each group (id, grp of nodes) by its own pairs, with and without the nodes of gone(id).

    All groups are done at once, as no pair that counts leads out of one. A group that is gone whole has none after.
    """
    of = nodes.where("grp IS NOT NULL").select("id", "grp")
    one, other = of.withColumnsRenamed({"id": "src", "grp": "ga"}), of.withColumnsRenamed({"id": "dst", "grp": "gb"})
    own = written(pairs.select("src", "dst").join(one, "src").join(other, "dst").where("ga = gb").select("src", "dst"))
    left = of.join(gone.select("id"), "id", "left_anti")
    kept = own.join(left.select(F.col("id").alias("src")), "src", "left_semi").join(left.select(F.col("id").alias("dst")), "dst", "left_semi")

    def counted(members: DataFrame, e: DataFrame, name: str) -> DataFrame:
        return members.join(graph.components(members, e), "id").groupBy("grp").agg(F.count_distinct("component").alias(name))

    after = counted(left, kept, "after").withColumnRenamed("grp", "of")
    made = counted(of, own, "before").join(after, F.col("grp") == F.col("of"), "left")
    n = F.coalesce("after", F.lit(0))
    return made.select("grp", "before", n.alias("after"), (n - F.col("before")).alias("more"))
