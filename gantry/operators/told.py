"""Rounds of graph.zones() where tasks are told the zones of all nodes, so that no link is moved in a round.

A node is its place among the ids in order, a zone the place of one of its members, and zones are one array of 4 bytes a node.
NODES_TOLD bounds it; graphs of more nodes, or of other ids than integers, deal what links tell by a shuffle. Both give the same zones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from gantry.operators.durable import buckets_of, written

#: Nodes whose zones are told to tasks: 16 MB of zones a round, and once a level 32 MB of degrees.
NODES_TOLD = 1 << 22
#: Ends (int32) and weights (float64) are bytes, which pass to Python as they lie.
_ROWS = "at int, id bigint, dst binary, w binary"


def fits(nodes: DataFrame) -> bool:
    return isinstance(nodes.schema["id"].dataType, IntegralType) and nodes.count() <= NODES_TOLD


def _packed(links: DataFrame, names, tasks: int) -> DataFrame:
    """A row for each node of `names` (broadcast, in order) with links (src, dst, w) to others of them; each of these comes once."""

    def pack(t: pa.Table) -> pa.Table:
        ids = names.value
        place = lambda c: np.minimum(np.searchsorted(ids, c), len(ids) - 1)
        src, dst, w = (t[c].to_numpy() for c in ("src", "dst", "w"))
        a, b = place(src), place(dst)
        known = (ids[a] == src) & (ids[b] == dst) & (a != b)
        order = np.flatnonzero(known)[np.argsort(a[known], kind="stable")]
        a, b, w = a[order], b[order].astype(np.int32), w[order]
        start = np.flatnonzero(np.diff(a, prepend=-1))
        off, at = np.append(start, len(a)), a[start]
        listed = lambda c: pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((off * c.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(c))])
        return pa.table([pa.array(at.astype(np.int32)), pa.array(ids[at]), listed(b), listed(w)], ["at", "id", "dst", "w"])

    dealt = links.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"), "w", F.pmod(F.xxhash64("src"), F.lit(tasks)).alias("block"))
    return written(dealt.groupBy("block").applyInArrow(pack, _ROWS))


def _lists(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, for each link: its node among these, other end, weight) of a batch."""
    found = []
    for c, kind in (("dst", np.int32), ("w", np.float64)):
        c = b.column(c).cast(pa.binary())
        off = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
        found.append(np.frombuffer(c.buffers()[2], np.uint8)[off[0] : off[-1]].view(kind))
    size = np.diff(off) // 8
    return b.column("at").to_numpy(), np.repeat(np.arange(len(size)), size), *found


def _sums(key: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.flatnonzero(np.diff(key, prepend=-1))
    return key[start], np.add.reduceat(w[order], start) if len(start) else np.zeros(0)


def _best(b: pa.RecordBatch, label: np.ndarray, degree: np.ndarray, weight: np.ndarray, total: float, resolution: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(nodes, zone of the greatest gain for each whose turn it is and its own for others, weight of links inside zones)."""
    at, row, dst, w = _lists(b)
    n, own = len(label), label[at].astype(np.int64)
    every = np.arange(len(at))
    key, links = _sums(np.concatenate([row * n + label[dst], every * n + own]), np.concatenate([w, np.zeros(len(at))]))
    row, zone = key // n, key % n
    stays = zone == own[row]
    d = degree[at][row]
    loss = -(links - resolution * d * (weight[zone] - np.where(stays, d, 0.0)) / total)
    first = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(loss, first)[row]
    equal = np.flatnonzero(loss == least)  # in order of zones within a node: the first of equals is the least
    to = zone[equal[np.flatnonzero(np.diff(row[equal], prepend=-1))]]
    turn = b.column("turn").to_numpy(zero_copy_only=False)
    return at, np.where(turn, to, own), float(links[stays].sum())


def _round(rows: DataFrame, k: int, label: np.ndarray, degree, weight: np.ndarray, total: float, resolution: float) -> tuple[np.ndarray, float]:
    """(labels after round k, weight of links inside the zones before it, which even rounds alone look for)."""
    turn = F.pmod(F.xxhash64("id", F.lit(k)), F.lit(2)) == 0
    zones = rows.sparkSession.sparkContext.broadcast((label, weight))

    def move(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heavy = zones.value
        inside = 0.0
        for b in batches:
            if len(b):
                at, to, more = _best(b, now, degree.value, heavy, total, resolution)
                inside += more
                moved = to != now[at]
                if moved.any():
                    yield pa.record_batch([pa.array(at[moved]), pa.array(to[moved].astype(np.int32)), pa.array(np.zeros(moved.sum()))], ["at", "zone", "inside"])
        yield pa.record_batch([pa.array([-1], pa.int32()), pa.array([-1], pa.int32()), pa.array([inside])], ["at", "zone", "inside"])

    asked = rows.withColumn("turn", turn)
    got = (asked.where("turn") if k % 2 else asked).mapInArrow(move, "at int, zone int, inside double").toArrow()
    zones.destroy()
    at, zone = got["at"].to_numpy(), got["zone"].to_numpy()
    label = label.copy()
    label[at[at >= 0]] = zone[at >= 0]
    return label, float(got["inside"].to_numpy().sum())


def _moves(rows: DataFrame, degree, total: float, within: float, resolution: float, least_gain: float, patience: int = 2) -> tuple[np.ndarray, float, float]:
    """As graph._moves(): (best labels, modularity of nodes alone, modularity of these labels)."""
    d = degree.value
    label = best = np.arange(len(d), dtype=np.int32)
    began = got = 0.0
    k, idle = 0, 0
    while True:
        weight = np.bincount(label, d, len(d))
        step, inside = _round(rows, k, label, degree, weight, total, resolution)
        if k % 2 == 0:
            now = (within + inside) / total - resolution * float((weight * weight).sum()) / total**2
            if k == 0:
                began = got = now
            else:
                idle = 0 if now > got + least_gain else idle + 1
            if now > got:
                best, got = label, now
            if idle >= patience:
                return best, began, got
        label = step
        k += 1


def _between(rows: DataFrame, ids, label: np.ndarray) -> DataFrame:
    """(src, dst, w): the links between zones, and within each from src to itself, by the id of the member a zone is named by."""
    zones = rows.sparkSession.sparkContext.broadcast(label)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names = zones.value, ids.value
        for b in batches:
            at, row, dst, w = _lists(b)
            key, sums = _sums(now[at][row].astype(np.int64) * len(now) + now[dst], w)
            yield pa.record_batch([pa.array(names[key // len(now)]), pa.array(names[key % len(now)]), pa.array(sums)], ["src", "dst", "w"])

    return written(rows.select("at", "dst", "w").mapInArrow(merge, "src bigint, dst bigint, w double").groupBy("src", "dst").agg(F.sum("w").alias("w")))


def zones(nodes: DataFrame, links: DataFrame, resolution: float, least_gain: float) -> DataFrame:
    """(id, zone) as graph.zones() says; links (src, dst, w) lie both ways and have no loops."""
    context = nodes.sparkSession.sparkContext
    links = written(links)
    count, total = links.agg(F.count("*"), F.coalesce(F.sum("w"), F.lit(0.0))).first()
    total = total or 1.0
    every = names = np.unique(nodes.select(F.col("id").cast("bigint").alias("id")).where("id IS NOT NULL").toArrow()["id"].to_numpy())
    if not len(names):
        return nodes.select("id", F.col("id").alias("zone")).limit(0)
    deg = links.groupBy(F.col("src").cast("bigint").alias("id")).agg(F.sum("w").alias("degree")).toArrow()
    degree, at = np.zeros(len(names)), np.minimum(np.searchsorted(names, deg["id"].to_numpy()), len(names) - 1)
    known = names[at] == deg["id"].to_numpy()
    degree[at[known]] = deg["degree"].to_numpy()[known]
    member, within, reached = np.arange(len(names)), 0.0, None
    while True:
        told, heavy = context.broadcast(names), context.broadcast(degree)
        rows = _packed(links, told, max(context.defaultParallelism, buckets_of(links, count)))
        label, began, got = _moves(rows, heavy, total, within, resolution, least_gain)
        if got <= (began if reached is None else reached) + least_gain:
            break
        reached = got
        between = _between(rows, told, label)
        within += between.where("src = dst").agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
        links = between.where("src <> dst")
        count = links.count()
        used, place = np.unique(label, return_inverse=True)
        member, degree, names = place[member], np.bincount(place, degree, len(used)), names[used]
    least = np.full(len(names), len(every))
    np.minimum.at(least, member, np.arange(len(every)))
    ends = context.broadcast((every, every[least[member]]))
    kind = nodes.schema["id"].dataType.simpleString()

    def name(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, zone = ends.value
        for b in batches:
            one = b.column("id").to_numpy()
            yield pa.record_batch([pa.array(one), pa.array(zone[np.searchsorted(ids, one)])], ["id", "zone"])

    made = nodes.select(F.col("id").cast("bigint").alias("id")).where("id IS NOT NULL").mapInArrow(name, "id bigint, zone bigint")
    return made.select(*[F.col(c).cast(kind).alias(c) for c in ("id", "zone")])
