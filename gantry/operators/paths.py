"""Path patterns over labelled edges: which ends each origin reaches by hops of stated kinds, some repeated.

A pattern is a list of hops; its small automaton has a state between hops (and between the repeats of one). The search is
over the product of nodes and states: a frontier of nodes is joined with the edges once a step, all origins (BITS of them a
row, each a bit) and all states (a column each) side by side, and only bits that were not seen before go on. So a loop ends, a node that many paths reach is
followed once, and no pair is made that no path makes. An end counts once for an origin, however many paths lead to it.

Edges have src, dst and label; starts have origin and id (an origin may start at many nodes, as a zone does at its objects).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.operators.durable import bucketed, buckets_of, written
from gantry.operators.relational import sum_before

#: Origins that one row of marks holds.
BITS = 62


@dataclass(frozen=True)
class Hop:
    """Edges of these labels (all, if None), along them, against them or both ways, `least` to `most` times (None: any number)."""

    labels: tuple[str, ...] | None = None
    way: str = "out"
    least: int = 1
    most: int | None = 1

    def __post_init__(self) -> None:
        if self.way not in ("out", "in", "both") or self.least < 0 or (self.most is not None and self.most < max(1, self.least)):
            raise ValueError(f"not a hop: {self}")


def automaton(pattern: list[Hop]) -> tuple[list[tuple[int, int, Hop]], list[tuple[int, int]], int]:
    """((state, next, hop), (state, next) without a hop, last state); the first state is 0."""
    moves: list[tuple[int, int, Hop]] = []
    free: list[tuple[int, int]] = []
    at = 0
    for hop in pattern:
        for _ in range(hop.least):
            moves.append((at, at + 1, hop))
            at += 1
        if hop.most is None:
            free.append((at, at + 1))  # a state of its own, so that the loop is not shared with the hop before
            at += 1
            moves.append((at, at, hop))
        else:
            for _ in range(hop.most - hop.least):
                moves.append((at, at + 1, hop))
                free.append((at, at + 1))
                at += 1
    return moves, free, at


def reached(free: list[tuple[int, int]], state: int) -> list[int]:
    """The states that a state stands for: itself and those behind moves without a hop."""
    out = [state]
    for s in out:
        out += [b for a, b in free if a == s and b not in out]
    return sorted(out)


def ends(edges: DataFrame, starts: DataFrame, pattern: list[Hop]) -> DataFrame:
    """(origin, id): the nodes at which a path of the pattern from a start of the origin ends, each once."""
    moves, free, last = automaton(pattern)
    edges = written(edges.select("src", "dst", "label"))
    of = written(sum_before(starts.select("origin").distinct(), F.lit(1).cast("bigint"), ["origin"], "number").select("origin", F.floor(F.col("number") / BITS).alias("block"), (F.col("number") % BITS).cast("int").alias("bit")))
    own = starts.select("origin", "id").join(of.withColumnRenamed("origin", "of"), F.col("origin").eqNullSafe(F.col("of")))
    states = range(last + 1)
    begin = reached(free, 0)
    marks = own.groupBy("id", "block").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("m"))
    none = F.lit(0).cast("bigint")
    seen = written(marks.select("id", "block", *[c for s in states for c in ((F.col("m") if s in begin else none).alias(f"s{s}"), (F.col("m") if s in begin else none).alias(f"n{s}"))]))
    ways = {w for _, _, h in moves for w in (("out", "in") if h.way == "both" else (h.way,))}
    steps = None
    for w in sorted(ways):
        a, b = ("src", "dst") if w == "out" else ("dst", "src")
        made = edges.select(F.col(a).alias("at"), F.col(b).alias("to"), "label", F.lit(w).alias("way"))
        steps = made if steps is None else steps.unionByName(made)
    if steps is not None:
        steps = bucketed(steps, "at", buckets_of(edges, len(ways) * edges.count()))
    from_states = sorted({s for s, _, _ in moves})
    while steps is not None:
        grown = F.lit(False)
        for s in from_states:
            grown = grown | (F.col(f"n{s}") != 0)
        new = seen.where(grown).select(F.col("id").alias("from"), "block", *[f"n{s}" for s in from_states])
        if new.isEmpty():
            break
        far = {s: none for s in states}
        for state, to, hop in moves:
            fits = F.lit(True) if hop.labels is None else F.coalesce(F.col("label").isin(*hop.labels), F.lit(False))
            fits = fits if hop.way == "both" else fits & (F.col("way") == hop.way)
            for s in reached(free, to):
                far[s] = far[s].bitwiseOR(F.when(fits, F.col(f"n{state}")).otherwise(none))
        told = steps.join(new.hint("shuffle_hash"), F.col("at") == F.col("from")).where("to IS NOT NULL")
        told = told.groupBy(F.col("to").alias("t"), F.col("block").alias("tb")).agg(*[F.bit_or(far[s]).alias(f"m{s}") for s in states])
        both = seen.join(told, (F.col("id") == F.col("t")) & (F.col("block") == F.col("tb")), "full")
        columns = [F.coalesce("id", "t").alias("id"), F.coalesce("block", "tb").alias("block")]
        for s in states:
            was, more = F.coalesce(f"s{s}", none), F.coalesce(f"m{s}", none)
            columns += [was.bitwiseOR(more).alias(f"s{s}"), more.bitwiseAND(F.bitwise_not(was)).alias(f"n{s}")]
        seen = written(both.select(*columns))
    ended = seen.where(F.col(f"s{last}") != 0).select("id", F.col("block").alias("b"), F.col(f"s{last}").alias("m"))
    ended = ended.select("id", "b", F.explode(F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda k: F.getbit("m", k) == 1)).alias("at"))
    return ended.join(of, (F.col("b") == F.col("block")) & (F.col("at") == F.col("bit"))).select("origin", "id")
