"""A profile of wide tables: moments of all pairs of numeric columns from one scan, and what they warn of.

Each task sums products of its rows as matrices, about a shift of its own (a value of each column), so that sums stay exact
where values are large and close together. A row a task and pair leaves it; Spark merges those by the rule for means and
centred sums of parts. Pairs are over the rows that have both values; NaN and infinities count as missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.operators.durable import written

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
_PAIR = ["a", "b", "n", "mean_a", "mean_b", "caa", "cbb", "cab"]


@dataclass(frozen=True)
class Limits:
    """From what on a share of missing or zero values, a skew or a correlation is told."""

    missing: float = 0.2
    zeros: float = 0.5
    skew: float = 2.0
    correlation: float = 0.9


def co_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, n, mean_a, mean_b, caa, cbb, cab) for each pair a <= b in the order of the columns: rows with both, their means, centred sums of squares and of products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, shift = len(columns), None
        n, sa, saa, sab = (np.zeros((k, k)) for _ in range(4))
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in b.columns])
            here = np.isfinite(x)
            if shift is None:
                shift = np.zeros(k)
                known = np.zeros(k, bool)
            first = here.argmax(axis=0)
            new = ~known & here.any(axis=0)
            shift[new] = x[first[new], np.flatnonzero(new)]
            known |= new
            d = np.where(here, x - shift, 0.0)
            m = here.astype(np.float64)
            n += m.T @ m
            sa += d.T @ m
            saa += (d * d).T @ m
            sab += d.T @ d
        if shift is None:
            return
        i, j = np.triu_indices(k)
        seen = n[i, j] > 0
        i, j = i[seen], j[seen]
        count, a, b = n[i, j], sa[i, j], sa[j, i]
        columns_of = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(count.astype(np.int64)), pa.array(shift[i] + a / count), pa.array(shift[j] + b / count), pa.array(saa[i, j] - a * a / count), pa.array(saa[j, i] - b * b / count), pa.array(sab[i, j] - a * b / count)]
        yield pa.record_batch(columns_of, _PAIR)

    parts = written(df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)]).mapInArrow(run, "a int, b int, n bigint, mean_a double, mean_b double, caa double, cbb double, cab double"))
    whole = parts.groupBy(F.col("a").alias("p"), F.col("b").alias("q")).agg(F.sum("n").alias("all"), *[(F.sum(F.col("n") * F.col(m)) / F.sum("n")).alias(f"whole_{m}") for m in ("mean_a", "mean_b")])
    met = parts.join(whole, (F.col("a") == F.col("p")) & (F.col("b") == F.col("q")))
    da, db = F.col("mean_a") - F.col("whole_mean_a"), F.col("mean_b") - F.col("whole_mean_b")
    sums = [F.sum(F.col(c) + F.col("n") * x).alias(c) for c, x in (("caa", da * da), ("cbb", db * db), ("cab", da * db))]
    names = F.array(*[F.lit(c) for c in columns])
    made = met.groupBy("p", "q").agg(F.max("all").alias("n"), F.max("whole_mean_a").alias("mean_a"), F.max("whole_mean_b").alias("mean_b"), *sums)
    return made.select(F.get(names, F.col("p")).alias("a"), F.get(names, F.col("q")).alias("b"), "n", "mean_a", "mean_b", "caa", "cbb", "cab")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, n, correlation) of each pair a < b; NULL where one of them is constant."""
    pairs = co_moments(df, columns).where("a <> b")
    size = F.sqrt(F.col("caa")) * F.sqrt(F.col("cbb"))
    return pairs.select("a", "b", "n", F.when(size > 0, F.col("cab") / size).alias("correlation"))


def alerts(df: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(kind, column, other, value): columns that are constant, missing, zero or skewed, and pairs that say the same.

    All columns are looked at for missing values, numeric ones for the rest; one scan for single columns, one for pairs.
    """
    numbers = [c for c, t in df.dtypes if t in NUMBERS]
    out = []
    for c, _ in df.dtypes:
        x = F.col(f"`{c}`")
        missing = F.avg(x.isNull().cast("double"))

        def told(kind: str, value: Column, when: Column, name: str = c) -> Column:
            return F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("column"), value.alias("value"), when.alias("told"))

        out.append(told("missing", missing, missing >= limits.missing))
        if c in numbers:
            v = x.cast("double")
            v = F.when(F.abs(v) < float("inf"), v)
            zeros, skew = F.avg((v == 0).cast("double")), F.skewness(v)
            out += [told("constant", F.max(v), F.min(v) == F.max(v)), told("zeros", zeros, zeros >= limits.zeros), told("skewed", skew, F.abs(skew) >= limits.skew)]
    single = df.agg(F.array(*out).alias("x")).select(F.inline("x")).where("told").select("kind", "column", F.lit(None).cast("string").alias("other"), "value")
    pairs = correlations(df, numbers).where(F.abs("correlation") >= limits.correlation)
    return single.unionByName(pairs.select(F.lit("correlated").alias("kind"), F.col("a").alias("column"), F.col("b").alias("other"), F.col("correlation").alias("value")))
