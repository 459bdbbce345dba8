"""Importance resampling towards a target distribution, over hashed runs of words.

Each task holds a DuckDB connection and works through its rows in batches of bounded size: SQL splits, unnests and
windows the words into runs, a registered zlib CRC-32 turns runs into buckets, and SQL counts them by document. These
counts are spilled to Parquet in the shared folder by Spark's own writer, so a lost executor costs its tasks only. Spark
then merges them to corpus counts (partial sums, at most a row a task and bucket), derives a gain for each bucket, scores
every document from its spilled counts, and draws the highest scores with a rank that no single task makes.

A text over PIECE_BYTES is cut between words, and each piece sees the words that follow it, so a document of any length
is counted whole in bounded memory. Nothing is kept on an executor's own disk.

Null and empty texts, and texts without a word, have no features and a weight of 0. A null key counts as the empty string
in the hash. Repeated rows are documents of their own. Ties in score go to the smaller key, null first; rows that agree in
that too are told apart by weight and size, and are otherwise alike. An empty table gives an empty result, an empty target
gives gains from the corpus alone. Columns other than key and text are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantry.llm.common import ascii_lower, bound_batches, durable, give_back

#: Fixed value: what separates words, once A-Z are lowered.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
#: Bytes of text in one SQL statement, and in one piece of a longer text.
SQL_BYTES, PIECE_BYTES = 4 << 20, 1 << 20
_WORD, _SEPARATOR = re.compile(b"[^" + SEPARATORS.encode() + b"]+"), re.compile(b"[" + SEPARATORS.encode() + b"]")


@dataclass(frozen=True)
class Draw:
    """Runs of 1 to `longest` words in `buckets` buckets; of documents with `least_words` words, `percent` of 100 are drawn."""

    longest: int = 2
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7


def crc32_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The CRC-32 of each string's bytes, read from Arrow's own buffers."""
    found: list[int] = []
    for a in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        wide = pa.types.is_large_string(a.type)
        _, offsets, data = a.buffers()
        at = np.frombuffer(offsets, np.int64 if wide else np.int32)[a.offset : a.offset + len(a) + 1].tolist() if len(a) else [0]
        raw = memoryview(data) if data is not None else b""
        found += [zlib.crc32(raw[i:j]) for i, j in zip(at, at[1:], strict=False)]
    return pa.array(found, pa.uint32())


def pieces(text: bytes, longest: int, size: int = PIECE_BYTES) -> Iterator[tuple[str, str]]:
    """(own, next): the text in pieces that end between words, each with the longest - 1 words that follow it."""
    start = 0
    while True:
        end = _SEPARATOR.search(text, start + size) if start + size < len(text) else None
        cut = end.start() if end else len(text)
        after = []
        while len(after) < longest - 1 and (w := _WORD.search(text, after[-1].end() if after else cut)):
            after.append(w)
        yield text[start:cut].decode(), b" ".join(w[0] for w in after).decode()
        if not end:
            return
        start = cut


def statement(longest: int, buckets: int) -> str:
    """SQL over rows (r, own, next): for each r its words, features, buckets and their counts; without a word, no row."""
    runs = ", ".join(["word", *(f"word || ' ' || {" || ' ' || ".join(f'w{k}' for k in range(1, n))}" for n in range(2, longest + 1))])
    leads = "".join(f", lead(word, {k}) OVER (PARTITION BY r, p ORDER BY i) AS w{k}" for k in range(1, longest))
    return f"""
        WITH lists AS MATERIALIZED (SELECT r, p, regexp_extract_all(own, '[^{SEPARATORS}]+') AS own, regexp_extract_all(next, '[^{SEPARATORS}]+') AS next FROM batch),
        words AS (SELECT r, p, n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (SELECT r, p, len(own) AS n, list_concat(own, next) AS w FROM lists)),
        ahead AS (SELECT r, i, n, word{leads} FROM words),
        runs AS (SELECT r, unnest(list_filter([{runs}], lambda x: x IS NOT NULL)) AS run FROM ahead WHERE i <= n),
        counted AS (SELECT r, (zlib_crc(run) % {buckets})::INTEGER AS bucket, count(*) AS n FROM runs GROUP BY ALL),
        sizes AS (SELECT r, sum(len(own))::BIGINT AS n_words FROM lists GROUP BY r)
        SELECT r, any_value(n_words) AS n_words, sum(n)::BIGINT AS n_features, list(bucket) AS buckets, list(n) AS counts
        FROM counted JOIN sizes USING (r) GROUP BY r"""


def bucket_counts(docs: DataFrame, draw: Draw, key: str | None = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_features, buckets, counts) of every row, spilled to Parquet; without a key, the key is NULL."""
    sql, longest, most = statement(draw.longest, draw.buckets), draw.longest, draw.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        con = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        con.create_function("zlib_crc", crc32_of, ["VARCHAR"], "UINTEGER", type="arrow")

        def count(rows: list[tuple[int, int, str, str]]) -> dict[int, tuple]:
            con.register("batch", pa.table([pa.array(x) for x in zip(*rows, strict=True)], ["r", "p", "own", "next"]))
            found = con.sql(sql).to_arrow_table()
            return {r: (w, n, b.values.to_numpy(), c.values.to_numpy()) for r, w, n, b, c in zip(*(found[x].to_pylist() for x in ("r", "n_words", "n_features")), found["buckets"], found["counts"], strict=True)}

        def long(text: bytes) -> tuple:
            """Of a text in many pieces, a few at a time."""
            total, words, features = np.zeros(most, np.int64), 0, 0
            rows: list[tuple[int, int, str, str]] = []
            for p, (own, following) in enumerate(pieces(text, longest)):
                rows.append((0, p, own, following))
                if len(rows) * PIECE_BYTES >= SQL_BYTES:
                    for w, n, b, c in count(rows).values():
                        total[b] += c
                        words, features = words + w, features + n
                    rows = []
            for w, n, b, c in (count(rows) if rows else {}).values():
                total[b] += c
                words, features = words + w, features + n
            at = np.flatnonzero(total)
            return words, features, at, total[at]

        try:
            for b in batches:
                texts = b.column("text")
                found: dict[int, tuple] = {}
                rows, held = [], 0
                for r in range(b.num_rows):
                    t = texts[r].as_buffer()
                    if t.size > PIECE_BYTES:
                        found[r] = long(t.to_pybytes())
                        continue
                    rows.append((r, 0, t.to_pybytes().decode(), ""))
                    held += t.size
                    if held > SQL_BYTES:
                        found |= count(rows)
                        rows, held = [], 0
                if rows:
                    found |= count(rows)
                made = [found.get(r, (0, 0, (), ())) for r in range(b.num_rows)]
                columns = [pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.list_(pa.int32())), pa.array([m[3] for m in made], pa.list_(pa.int64()))]
                yield pa.record_batch([b.column("key"), *columns], ["key", "n_words", "n_features", "buckets", "counts"])
        finally:
            con.close()

    bound_batches(docs.sparkSession)
    k = docs[key] if key else F.lit(None).cast("bigint")
    plain = docs.select(k.alias("key"), ascii_lower(F.coalesce(docs[text], F.lit(""))).alias("text"))
    kind = plain.schema["key"].dataType.simpleString()
    return durable(plain.mapInArrow(run, f"key {kind}, n_words bigint, n_features bigint, buckets array<int>, counts array<bigint>"), "bucket-counts")


def merged(spilled: DataFrame) -> DataFrame:
    """(bucket, n): the corpus's count of each bucket that it has."""
    each = spilled.select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
    return each.groupBy(F.col("x.buckets").alias("bucket")).agg(F.sum("x.counts").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """One row with one list: of each bucket, 1,000 times the log of how much likelier the target is, add-one smoothed, rounded down."""
    every = source.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    every = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    s, t = (every.agg(F.sum(c)).scalar().cast("double") for c in ("s", "t"))
    ratio = (F.col("t").cast("double") + 1.0) * (s + float(buckets)) / ((F.col("s").cast("double") + 1.0) * (t + float(buckets)))
    rows = every.select("bucket", F.floor(1000.0 * F.ln(ratio)).cast("bigint").alias("gain"))
    return rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "gain"))), lambda x: x["gain"]).alias("gains"))


def noise(key: Column, seed: int) -> Column:
    """A draw from the Gumbel distribution by the SHA-256 of seed and key, in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("bigint")


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """With `place` from 1 in this order: rows are dealt by ranges, each task numbers its own, and counts of the ranges before complete them."""
    dealt = durable(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "score-ranges")
    counts = dealt.groupBy("part").agg(F.count("*").alias("rows"))  # a row for each partition
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.select("part", before.cast("bigint").alias("before"))
    numbered = dealt.withColumn("own", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    return numbered.join(F.broadcast(base), "part").withColumn("place", F.col("own") + F.col("before")).drop("part", "own", "before")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", draw: Draw = Draw()) -> DataFrame:
    """(key, n_features, weight, score, rank) of every row: rank 1, 2, 3... of the rows drawn, NULL of the others."""
    spilled = bucket_counts(docs, draw, key, text)
    wanted = bucket_counts(target, draw, None, target_text)
    # `buckets` numbers, a parameter, however large the corpus
    gain = np.array(gains(merged(spilled), merged(wanted), draw.buckets).first()["gains"], np.int64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, n = b.column("buckets"), b.column("n_features").to_numpy()
            products = gain[own.flatten().to_numpy()] * b.column("counts").flatten().to_numpy()
            size = pa.compute.list_value_length(own).to_numpy()
            upto = np.concatenate([[0], np.cumsum(products)])
            end = np.cumsum(size)
            weight = (upto[end] - upto[end - size]) // np.maximum(n, 1)
            yield pa.record_batch([b.column("key"), b.column("n_words"), b.column("n_features"), pa.array(weight)], ["key", "n_words", "n_features", "weight"])

    kind = spilled.schema["key"].dataType.simpleString()
    scored = spilled.mapInArrow(weigh, f"key {kind}, n_words bigint, n_features bigint, weight bigint")
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("key"), draw.seed))
    able = F.col("n_words") >= draw.least_words
    drawn = F.floor(spilled.where(able).agg(F.count("*")).scalar() * draw.percent / 100).cast("bigint")
    order = [F.desc("score"), F.asc("key"), F.desc("weight"), F.desc("n_features")]
    places = ranked(scored.where(able), order)
    inside = places.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("bigint"))
    return inside.unionByName(rest).select(F.col("key").alias(key), "n_features", "weight", "score", "rank")
