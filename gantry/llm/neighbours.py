"""Near-duplicate vectors: a neighbour graph refined by NN-descent, and the links above a cosine threshold counted exactly.

Equal vectors are one node with a number of copies. Every node has a list of its nearest nodes found so far. Lists begin
with random-hyperplane tables: nodes are sorted by their sign codes, and those that stand together are compared. Then, in
rounds, the neighbours of each node's neighbours are joined: all that have a node in their list or are in its list meet at
that node (in parts of bounded size, so a hub is no hot group), each pair with a fresh member is compared there, and
every member takes what beats the worst of its list. Rounds end when few lists change. These comparisons use half
precision and a margin, so their links are candidates.

A list is saturated when it is full and all of it links: links beyond it may be missing. Such a list is enlarged by its
whole component of candidates: within a component all links are counted exactly below, so the list drops its members
and looks for others, with new tables and rounds, until no two components join. Recall is audited: a bounded sample drawn
by hash is compared with all nodes, and while less than `recall` of a sampled node's links lie inside its component (the
mean over nodes with links), what was missed is added and twice as many new tables follow.

The exact step takes each component of candidates apart in double precision: nodes within half the threshold's angle of
the component's root all link with each other, by the triangle inequality, and are counted by a sum; the others are
compared with all of the component in blocks of bounded size inside tasks, which return counts and a spanning forest.
So no pairs of a large group leave a task, and no group is held whole.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Vectors of different lengths
do not link. Rows with equal vectors link with each other, whatever their keys; of equal keys each row is a vector. A null
key takes part; its row is kept where the component has no other key. Long vectors are fine; a batch holds 8 MB of them. An
empty table gives an empty result. Columns other than key and vector are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import bound_batches, durable
from gantry.llm.simhash import components, root_labels, whole_groups
from gantry.llm.words import buffers

#: What half precision can be wrong by in a cosine, twice over.
MARGIN = 0.002
#: Candidates that a task holds before it cuts them to the best of each node.
MOST_HELD = 1 << 20


@dataclass(frozen=True)
class Search:
    """Lists of `size`; `tables` tables of groups of `leaf`; parts of `part` members; rounds go on while a share of `moving` of all entries is new."""

    threshold: float = 0.95
    size: int = 10
    tables: int = 4
    leaf: int = 64
    part: int = 40
    moving: float = 0.05
    recall: float = 0.99
    audited: int = 1000
    block: int = 500
    seed: int = 13


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Rows of equally long binary values as a matrix."""
    raw, _ = buffers(column)
    return np.frombuffer(raw.tobytes(), kind).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by a power of two so that no square overflows or vanishes."""
    x = x.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In double precision, of rows of unit()."""
    return x @ y.T


def number_of(rows: DataFrame, vector: str) -> type:
    """What the vectors are kept as: their own single precision, or double."""
    return np.float32 if rows.schema[vector].dataType.elementType.simpleString() == "float" else np.float64


def prepared(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, digest, dim, vec, half) of every row: vec its numbers as they came, half those of its unit vector; NULL where it cannot link."""
    kind = number_of(rows, vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for v in b.column("vector"):
                values = v.values
                x = values.to_numpy(zero_copy_only=False).astype(kind) if values is not None and len(values) and not values.null_count else None
                if x is None or not np.isfinite(x).all() or not x.any():
                    out.append((None, None, None, None))
                    continue
                x = x + kind(0)  # -0.0 becomes 0.0
                raw = x.tobytes()
                out.append((hashlib.blake2b(raw, digest_size=16).digest(), len(x), raw, unit(x[None])[0].astype(np.float16).tobytes()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.binary(), pa.int32(), pa.binary(), pa.binary()), strict=True)] if out else []
            if columns:
                yield pa.record_batch([b.column("key"), *columns], ["key", "digest", "dim", "vec", "half"])

    bound_batches(rows.sparkSession)
    plain = rows.select(rows[key].alias("key"), rows[vector].cast("array<float>" if kind is np.float32 else "array<double>").alias("vector"))
    return plain.mapInArrow(run, f"key {plain.schema['key'].dataType.simpleString()}, digest binary, dim int, vec binary, half binary")


# neighbour lists -------------------------------------------------------------------------------------------------


def best(u: np.ndarray, v: np.ndarray, s: np.ndarray, fresh: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Of each u the `size` best v, each once; what is not fresh stands for its equals, and of equal cosines the least v comes first."""
    o = np.lexsort((fresh, v, u))
    u, v, s, fresh = u[o], v[o], s[o], fresh[o]
    once = np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])[: len(u)]
    u, v, s, fresh = u[once], v[once], s[once], fresh[once]
    o = np.lexsort((v, -s, u))
    u, v, s, fresh = u[o], v[o], s[o], fresh[o]
    first = np.searchsorted(u, u)
    keep = np.arange(len(u)) - first < size
    return u[keep], v[keep], s[keep], fresh[keep]


def compared(t: pa.Table, bounds: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(u, v, cosine) inside the groups of rows between the bounds: for each row the best that beat its worst, where one of the two is fresh and their labels differ."""
    node, label, worst, fresh = (t[c].to_numpy() for c in ("member", "label", "worst", "fresh"))
    dims, column = t["dim"].to_numpy(), t["half"].combine_chunks()
    vectors = {d: (np.cumsum(dims == d) - 1, matrix(column.filter(pa.array(dims == d)), np.float16)) for d in np.unique(dims).tolist()}
    n = np.diff(bounds)
    kind = dims[bounds[:-1]]  # all of a group have one
    order = np.lexsort((n, kind))
    order = order[n[order] > 1]
    start = 0
    while start < len(order):
        d, stop = int(kind[order[start]]), start + 1
        while stop < len(order) and kind[order[stop]] == d and (stop + 1 - start) * (w := int(n[order[stop]])) * max(w, d) <= 1 << 20:
            stop += 1
        g = order[start:stop]
        start = stop
        wide = int(n[g].max())
        place = bounds[g][:, None] + np.arange(wide)
        real = np.arange(wide) < n[g][:, None]
        place = np.where(real, place, bounds[g][:, None])
        x = vectors[d][1][vectors[d][0][place]].astype(np.float32)
        s = x @ x.transpose(0, 2, 1)
        ok = real[:, :, None] & real[:, None, :] & (label[place][:, :, None] != label[place][:, None, :]) & (fresh[place][:, :, None] | fresh[place][:, None, :])
        ok &= (node[place][:, :, None] != node[place][:, None, :]) & (s > worst[place][:, :, None])
        if wide > size:
            s = np.where(ok, s, np.float32(-3))
            ok &= s >= -np.partition(-s, size - 1, axis=2)[:, :, size - 1 : size]
        k, i, j = np.nonzero(ok)
        yield node[place[k, i]], node[place[k, j]], s[k, i, j]


def candidates(tables: Iterator[tuple[pa.Table, np.ndarray]], size: int) -> Iterator[pa.RecordBatch]:
    """Rows (node, nbr, cosine, fresh): what a task finds, cut to the best of each node before it leaves."""
    held: tuple = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array(x) for x in (*held, np.ones(len(held[0]), bool))], ["node", "nbr", "cosine", "fresh"])

    after = MOST_HELD
    for t, bounds in tables:
        for found in compared(t, bounds, size):
            held = tuple(np.concatenate(x) for x in zip(held, found, strict=True))
            if len(held[0]) > after:
                held = best(*held, np.ones(len(held[0]), bool), size)[:3]
                if len(held[0]) > MOST_HELD:
                    yield out()
                    held = tuple(x[:0] for x in held)
                after = MOST_HELD + len(held[0])
    held = best(*held, np.ones(len(held[0]), bool), size)[:3]
    yield out()


LIST = "node bigint, nbr bigint, cosine float, fresh boolean"


def from_tables(state: DataFrame, search: Search, tables: int, turn: int) -> DataFrame:
    """Candidates for the lists from new tables: sorted by sign codes, nodes that stand together are compared.

    Rows are dealt by ranges of code and a hash of the node, so that equal codes, however many, make no hot task.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                own = b.filter(pa.array(dims == d))
                x = matrix(own.column("half"), np.float16).astype(np.float32)
                for k in range(tables):
                    if (k, d) not in planes:
                        planes[k, d] = np.random.default_rng([search.seed, turn, k, d]).normal(size=(d, 48)).astype(np.float32)
                    code = (x @ planes[k, d] > 0) @ (np.int64(1) << np.arange(48))
                    yield pa.record_batch([pa.array(np.full(len(x), k, np.int32)), pa.array(code), *own.columns], ["tab", "code", *own.schema.names])

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
        for b in batches:
            tab, dim = b.column("tab").to_numpy(), b.column("dim").to_numpy()
            first = np.concatenate([[0], np.flatnonzero((np.diff(tab) != 0) | (np.diff(dim) != 0)) + 1, [b.num_rows]])
            starts = [np.arange(a, z, search.leaf) for a, z in zip(first, first[1:], strict=False)]
            yield pa.Table.from_batches([b]), np.concatenate([*starts, [b.num_rows]]).astype(np.int64)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from candidates(grouped(batches), search.size)

    rows = state.select(F.col("node").alias("member"), "label", "worst", F.lit(True).alias("fresh"), "dim", "half")
    rows = durable(rows.mapInArrow(coded, "tab int, code bigint, member bigint, label bigint, worst float, fresh boolean, dim int, half binary"), "sign-codes")
    by = ["tab", "dim", "code", "mixed"]
    dealt = rows.withColumn("mixed", F.xxhash64("member", F.lit(turn))).repartitionByRange(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(join, LIST)


def from_neighbours(graph: DataFrame, state: DataFrame, search: Search, turn: int) -> DataFrame:
    """Candidates for the lists from neighbours of neighbours: all that have a node in their list, or are in its list, meet there."""
    both = graph.select(F.col("node").alias("at"), F.col("nbr").alias("member"), "fresh").union(graph.select("nbr", "node", "fresh"))
    both = both.groupBy("at", "member").agg(F.max("fresh").alias("fresh"))
    # only where something is new; a node that many have in their lists is met in parts
    where = both.groupBy("at").agg(F.max("fresh").alias("any"), F.ceil(F.count("*") / search.part).alias("parts")).where("any").select("at", "parts")
    met = both.join(where, "at").withColumn("part", F.pmod(F.xxhash64("member", F.lit(turn)), "parts"))
    rows = met.select("at", "part", "member", "fresh").join(state.withColumnRenamed("node", "member"), "member")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grouped() -> Iterator[tuple[pa.Table, np.ndarray]]:
            for t in whole_groups(batches, ["at", "part"]):
                first = np.flatnonzero((np.diff(t["at"].to_numpy()) != 0) | (np.diff(t["part"].to_numpy()) != 0)) + 1
                yield t, np.concatenate([[0], first, [t.num_rows]])

        yield from candidates(grouped(), search.size)

    dealt = rows.select("at", "part", "member", "label", "worst", "fresh", "dim", "half").repartition("at", "part").sortWithinPartitions("at", "part")
    return dealt.mapInArrow(join, LIST)


def merged(graph: DataFrame | None, found: DataFrame, size: int) -> DataFrame:
    """The lists with what was found; only what has just come into a list is fresh."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["node"]):
            kept = best(*(t[c].to_numpy() for c in ("node", "nbr", "cosine", "fresh")), size)
            yield pa.record_batch([pa.array(x) for x in kept], ["node", "nbr", "cosine", "fresh"])

    every = found if graph is None else graph.withColumn("fresh", F.lit(False)).unionByName(found)
    return durable(every.repartition("node").sortWithinPartitions("node").mapInArrow(run, LIST), "neighbour-lists")


def with_worst(codes: DataFrame, graph: DataFrame | None, label: DataFrame | None, size: int) -> DataFrame:
    """(node, dim, half, label, worst): worst is the cosine to beat; a node without a component is its own label."""
    worst = None if graph is None else graph.groupBy(F.col("node").alias("of")).agg(F.when(F.count("*") >= size, F.min("cosine")).alias("least"))
    state = codes.withColumn("least", F.lit(None).cast("float")) if worst is None else codes.join(worst, codes["node"] == worst["of"], "left").drop("of")
    if label is None:
        state = state.withColumn("root", F.lit(None).cast("bigint"))
    else:
        state = state.join(label.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").drop("of")
    return state.select("node", "dim", "half", F.coalesce("root", "node").alias("label"), F.coalesce("least", F.lit(-2.0)).cast("float").alias("worst"))


def candidate_components(codes: DataFrame, search: Search, tell: list | None = None) -> DataFrame:
    """(node, root) of the nodes of every component of candidate links of two nodes or more. tell gets (turn, rounds, recall)."""
    least = search.threshold - MARGIN
    n = codes.count()
    graph = label = edges = None
    turn, tables = 0, search.tables
    while True:
        state = with_worst(codes, graph, label, search.size)
        graph = merged(graph, from_tables(state, search, tables, turn), search.size)
        rounds = 0
        while graph.where("fresh").count() > search.moving * n * search.size:
            state = with_worst(codes, graph, label, search.size)
            graph = merged(graph, from_neighbours(graph, state, search, rounds), search.size)
            rounds += 1
        new = graph.where(F.col("cosine") >= least).select(F.col("node").alias("a"), F.col("nbr").alias("b"))
        if label is not None:
            new = across(new, label)
        new = durable(new, "candidate-links")
        joined = not new.isEmpty()
        edges = new if edges is None else edges.unionByName(new)
        if joined:
            label = components(edges)
        if label is None:
            label = components(edges)
        got, missed = audited(codes, label, search, turn)
        if tell is not None:
            tell.append((turn, rounds, got))
        if got >= search.recall:
            full = graph.groupBy("node").agg(F.count("*").alias("n"), F.min("cosine").alias("least")).where((F.col("n") >= search.size) & (F.col("least") >= least)).select("node")
            full = durable(full, "saturated")
            if full.isEmpty() or not joined:
                return label
            # saturated lists let go of their own component, which is counted whole below
            of = label.select(F.col("node").alias("x"), F.col("root").alias("own"))
            to = label.select(F.col("node").alias("y"), F.col("root").alias("other"))
            inside = graph.join(full, "node", "left_semi").join(of, F.col("node") == F.col("x")).join(to, F.col("nbr") == F.col("y")).where("own = other").select("node", "nbr")
            graph = durable(graph.join(inside, ["node", "nbr"], "left_anti"), "neighbour-lists")
        else:
            tables *= 2
            edges = durable(edges.unionByName(missed), "candidate-links")
            label = components(edges)
        turn += 1


def across(links: DataFrame, label: DataFrame) -> DataFrame:
    """The links (a, b) between different components."""
    one, other = label.select(F.col("node").alias("x"), F.col("root").alias("p")), label.select(F.col("node").alias("y"), F.col("root").alias("q"))
    named = links.join(one, F.col("a") == F.col("x"), "left").join(other, F.col("b") == F.col("y"), "left")
    return named.where(F.coalesce("p", "a") != F.coalesce("q", "b")).select("a", "b")


def audited(codes: DataFrame, label: DataFrame, search: Search, turn: int) -> tuple[float, DataFrame]:
    """(recall, links missed): a sample of nodes, drawn by hash, against all nodes; the mean share of a node's links that lie inside its component."""
    order = F.xxhash64("node", F.lit(search.seed), F.lit(turn + 1))
    state = with_worst(codes, None, label, search.size).select("node", "dim", "half", "label")
    sample = state.orderBy(order, "node").limit(search.audited).toArrow().combine_chunks()
    spark = codes.sparkSession
    if not sample.num_rows:
        return 1.0, spark.createDataFrame([], "a bigint, b bigint")
    node, dims, own = (sample[c].to_numpy() for c in ("node", "dim", "label"))
    sides = {d: (np.flatnonzero(dims == d), matrix(sample["half"].combine_chunks().filter(pa.array(dims == d)), np.float16).astype(np.float32)) for d in np.unique(dims).tolist()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, inside = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        for b in batches:
            every = b.column("dim").to_numpy()
            for d, (at, y) in sides.items():
                rows = b.filter(pa.array(every == d))
                if not rows.num_rows:
                    continue
                x = matrix(rows.column("half"), np.float16).astype(np.float32)
                there, to = rows.column("node").to_numpy(), rows.column("label").to_numpy()
                for i in range(0, len(x), 4096):
                    r, k = np.nonzero(x[i : i + 4096] @ y.T >= search.threshold)
                    r, k = r + i, at[k]
                    other = there[r] != node[k]
                    r, k = r[other], k[other]
                    same = to[r] == own[k]
                    total += np.bincount(k, minlength=len(node))
                    inside += np.bincount(k[same], minlength=len(node))
                    # of what was missed one link to each component leaves the task
                    _, one = np.unique(np.stack([k[~same], to[r[~same]]]), axis=1, return_index=True)
                    if len(one):
                        yield pa.record_batch([pa.array(node[k[~same][one]]), pa.array(there[r[~same][one]]), pa.nulls(len(one), pa.int64()), pa.nulls(len(one), pa.int64())], names)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(node[some]), pa.nulls(len(some), pa.int64()), pa.array(total[some]), pa.array(inside[some])], names)

    names = ["a", "b", "total", "inside"]
    seen = durable(state.mapInArrow(run, "a bigint, b bigint, total bigint, inside bigint"), "audit")
    share = seen.where("total IS NOT NULL").groupBy("a").agg((F.sum("inside") / F.sum("total")).alias("share")).agg(F.avg("share")).first()[0]
    return 1.0 if share is None else share, seen.where("b IS NOT NULL").select("a", "b")


# exact links -----------------------------------------------------------------------------------------------------


def exact_links(nodes: DataFrame, label: DataFrame, search: Search, kind: type) -> tuple[DataFrame, DataFrame]:
    """((node, links), (a, b)): the copies that each node of a component links with beside its own, and links with the same components as all."""
    half = float(np.cos(np.arccos(search.threshold) / 2)) + 1e-9
    rows = nodes.join(label.withColumnRenamed("node", "of"), F.col("node") == F.col("of")).select("node", "root", "copies", "vec")
    roots = nodes.join(label.where("node = root").select(F.col("node").alias("of")), F.col("node") == F.col("of")).select(F.col("of").alias("root"), F.col("vec").alias("root_vec"))

    def near_root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = pa.compute.binary_length(b.column("vec")).to_numpy()
            for n in np.unique(sizes).tolist():
                own = b.filter(pa.array(sizes == n))
                x, y = unit(matrix(own.column("vec"), kind)), unit(matrix(own.column("root_vec"), kind))
                core = (x * y).sum(axis=1) >= half
                yield pa.record_batch([own.column(c) for c in ("node", "root", "copies", "vec")] + [pa.array(core)], ["node", "root", "copies", "vec", "core"])

    form = "node bigint, root bigint, copies bigint, vec binary, core boolean"
    rows = durable(rows.join(roots, "root").select("node", "root", "copies", "vec", "root_vec").mapInArrow(near_root, form), "component-vectors")
    sums = rows.groupBy("root").agg(F.sum(F.when(F.col("core"), F.col("copies"))).alias("core_copies"), F.count_if("core").alias("cores"), F.count_if(~F.col("core")).alias("others"))
    parts = [F.ceil(F.col(c) / search.block).cast("bigint").alias(name) for c, name in (("cores", "core_parts"), ("others", "other_parts"))]
    sums = durable(sums.select("root", "core_copies", "others", *parts), "component-sizes")
    first = rows.where("core").join(sums, "root").select("node", (F.col("core_copies") - F.col("copies")).alias("links"))
    # parts of the core come first, and meet only parts of the others
    rest = rows.join(sums.where("others > 0"), "root")
    part = F.when(F.col("core"), F.pmod(F.xxhash64("node"), F.greatest("core_parts", F.lit(1)))).otherwise(F.col("core_parts") + F.pmod(F.xxhash64("node"), F.greatest("other_parts", F.lit(1))))
    rest = rest.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.when(F.col("core"), F.col("core_parts")).otherwise(F.lit(0)), F.col("core_parts") + F.col("other_parts") - 1)))
    by = ["root", "lo", "hi"]
    rest = rest.select("root", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "node", "copies", "vec")

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, by):
            change = np.any([np.diff(t[c].to_numpy()) != 0 for c in by], axis=0) if t.num_rows > 1 else np.zeros(0, bool)
            bounds = np.concatenate([[0], np.flatnonzero(change) + 1, [t.num_rows]]).tolist()
            node, copies, part, lo, hi = (t[c].to_numpy() for c in ("node", "copies", "part", "lo", "hi"))
            vec = t["vec"].combine_chunks()
            for i, j in zip(bounds, bounds[1:], strict=False):
                own, many = node[i:j], copies[i:j]
                x = unit(matrix(vec.slice(i, j - i), kind))
                a, b = (np.arange(j - i), np.arange(j - i)) if lo[i] == hi[i] else (np.flatnonzero(part[i:j] == lo[i]), np.flatnonzero(part[i:j] == hi[i]))
                near = cosines(x[a], x[b]) >= search.threshold
                if lo[i] == hi[i]:
                    np.fill_diagonal(near, False)
                links = np.zeros(j - i, np.int64)
                links[a] += near @ many[b]
                if lo[i] != hi[i]:
                    links[b] += near.T @ many[a]
                p, q = np.nonzero(near)
                roots = root_labels(j - i, a[p], b[q])
                moved = np.flatnonzero(roots != np.arange(j - i))
                yield pa.record_batch([pa.array(own), pa.array(links), pa.nulls(len(own), pa.int64())], ["node", "links", "to"])
                yield pa.record_batch([pa.array(own[moved]), pa.nulls(len(moved), pa.int64()), pa.array(own[roots[moved]])], ["node", "links", "to"])

    dealt = rest.repartition(*by).sortWithinPartitions(*by)
    found = durable(dealt.mapInArrow(hold, "node bigint, links bigint, to bigint"), "exact-links")
    counts = first.unionByName(found.where("links IS NOT NULL").select("node", "links")).groupBy("node").agg(F.sum("links").alias("links"))
    edges = rows.where("core AND node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    return counts, edges.unionByName(found.where("to IS NOT NULL").select(F.col("node").alias("a"), F.col("to").alias("b")))


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", search: Search = Search(), tell: list | None = None) -> DataFrame:
    """(key, n_links, component_id, kept) of every row. tell gets what the audits found."""
    made = durable(prepared(rows, key, vector), "vectors")
    known = made.where("digest IS NOT NULL").groupBy("digest").agg(F.first("dim").alias("dim"), F.first("vec").alias("vec"), F.first("half").alias("half"), F.min("key").alias("least"), F.count("*").alias("copies"))
    nodes = durable(known.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    label = durable(candidate_components(nodes.select("node", "dim", "half"), search, tell), "candidate-components")
    counts, edges = exact_links(nodes, label, search, number_of(rows, vector))
    roots = components(edges)
    of = nodes.select("node", "digest", "least", "copies").join(roots.withColumnRenamed("node", "in_node"), F.col("node") == F.col("in_node"), "left").select("node", "digest", "copies", "least", F.coalesce("root", "node").alias("root"))
    heads = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = of.join(heads, "root").join(counts.withColumnRenamed("node", "counted"), F.col("node") == F.col("counted"), "left")
    of = durable(of.select(F.col("digest").alias("known"), "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector-components")
    found = made.select("key", "digest").join(of, F.col("digest") == F.col("known"), "left")
    alone = F.col("digest").isNull()
    component = F.when(alone, F.col("key")).otherwise(F.col("component_id"))
    return found.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))
