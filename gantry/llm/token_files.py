"""Token counts of flat token files: a separator scan with a prefix scan over blocks.

A token file is nothing but 16-bit ids, one document behind the other, each closed by an end-of-document id. Files are
cut into blocks by size alone. Each block is searched for the separator in one vectorised pass and tells how many it
has, where its last one is, and the tokens of the documents that end in it. A prefix scan over a file's blocks (sum of
separators, greatest last separator so far) gives each block the tokens that were open before it and the number of
its first document, so documents may run over any number of blocks.

Empty documents count 0 tokens. Tokens behind the last separator are a document that is not closed. An empty file or
folder gives no rows. A last odd byte of a file is half an id: it is not read and counts as nothing; block sizes are
rounded down to whole ids. A document of any length runs over as many blocks as it needs. Files listed twice are
counted once. In the round trip, null and empty texts have no tokens, repeated rows and rows of one
key are written and counted each, and columns other than key and text are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gantry.llm.common import by_bytes, durable, key_and_text, new_dir
from gantry.llm.packing import WordTokenizer

#: The vocabulary's own end-of-document id, which no text gives.
SEPARATOR = 49407
ITEM = np.dtype("<u2")
#: Bytes of a block, and those after which a writing task begins a new file.
BLOCK_BYTES, FILE_BYTES = 4 << 20, 256 << 20


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, separator: int = SEPARATOR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, bytes, ordinal, key): where each row went. bytes is set once a file, on its first document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer.kept(tokenizer, literal=True)  # no text may give the separator
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, path, n = None, "", 0
        for b in (x for whole in batches for x in by_bytes([whole], "text")):
            if out is not None and out.tell() >= FILE_BYTES:
                yield _closed(out, path, b)
                out = None
            if out is None:
                path, n = f"{folder}/{uuid.uuid4().hex}.tokens", 0
                out = store.open_output_stream(f"{root}/{path.rpartition('/')[2]}", compression=None)
            ids, bounds = words.encode_all(b.column("text"))
            if len(ids) and int(ids.max()) >= separator:
                raise ValueError("a text gives the separator or an id past 16 bits")
            out.write(np.insert(ids.astype(ITEM), bounds[1:], ITEM.type(separator)).tobytes())
            rows = b.num_rows
            yield pa.record_batch([pa.array([path] * rows), pa.nulls(rows, pa.int64()), pa.array(np.arange(n, n + rows)), b.column("key")], ["path", "bytes", "ordinal", "key"])
            n += rows
        if out is not None:
            yield _closed(out, path, b)

    kind = docs.schema[key].dataType.simpleString()
    return key_and_text(docs, key, text).mapInArrow(run, f"path string, bytes bigint, ordinal bigint, key {kind}")


def _closed(out, path: str, like: pa.RecordBatch) -> pa.RecordBatch:
    """A row that tells a finished file's size; ordinal -1."""
    size = out.tell()
    out.close()
    return pa.record_batch([pa.array([path]), pa.array([size], pa.int64()), pa.array([-1], pa.int64()), pa.nulls(1, like.column("key").type)], ["path", "bytes", "ordinal", "key"])


def scan_block(ids: np.ndarray, separator: int) -> tuple[int, int, np.ndarray]:
    """(separators, place of the last or -1, tokens of the documents that end here; the first as if it began here)."""
    at = np.flatnonzero(ids == separator)
    return len(at), int(at[-1]) if len(at) else -1, np.diff(at, prepend=-1) - 1


def count_tokens(files: DataFrame, separator: int = SEPARATOR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, ordinal, n_tokens, closed) of files (path, bytes)."""
    block_bytes = max(ITEM.itemsize, block_bytes // ITEM.itemsize * ITEM.itemsize)
    files = files.distinct().select("path", (F.col("bytes") - F.col("bytes") % ITEM.itemsize).alias("bytes"))
    blocks = files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(block_bytes).cast("bigint"))).alias("offset"))
    blocks = blocks.select("path", "offset", F.least(F.lit(block_bytes), F.col("bytes") - F.col("offset")).alias("size")).repartition("path", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, offset, size in zip(*[b.column(c).to_pylist() for c in ("path", "offset", "size")], strict=True):
                store, at = fs.FileSystem.from_uri(path)
                with store.open_input_file(at) as f:
                    ids = np.frombuffer(f.read_at(size, offset), ITEM)
                n, last, counts = scan_block(ids, separator)
                made = [[path], [offset // ITEM.itemsize], [len(ids)], [n], [last], [counts.tolist()]]
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                yield pa.record_batch([pa.array(x, t) for x, t in zip(made, kinds, strict=True)], ["path", "start", "tokens", "found", "last", "counts"])

    scanned = durable(blocks.mapInArrow(run, "path string, start bigint, tokens bigint, found bigint, last bigint, counts array<bigint>"), "blocks")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    last_at = F.when(F.col("found") > 0, F.col("start") + F.col("last"))
    light = scanned.select(
        F.col("path").alias("in_path"), F.col("start").alias("in_start"),
        F.coalesce(F.sum("found").over(before), F.lit(0)).alias("first"),
        (F.col("start") - F.coalesce(F.max(last_at).over(before), F.lit(-1)) - 1).alias("open"),
    )
    whole = scanned.join(light, (scanned["path"] == light["in_path"]) & (scanned["start"] == light["in_start"]))
    ended = whole.select("path", "first", "open", F.posexplode("counts").alias("k", "n"))
    ended = ended.select("path", (F.col("first") + F.col("k")).alias("ordinal"), (F.col("n") + F.when(F.col("k") == 0, F.col("open")).otherwise(0)).alias("n_tokens"), F.lit(True).alias("closed"))
    rest = scanned.groupBy("path").agg(F.sum("found").alias("ordinal"), (F.max(F.col("start") + F.col("tokens")) - F.coalesce(F.max(last_at), F.lit(-1)) - 1).alias("n_tokens"))
    return ended.unionByName(rest.where("n_tokens > 0").withColumn("closed", F.lit(False)))


def counted(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, n_tokens): writes the documents as token files, counts from the files alone, and brings the keys back by place."""
    rows = durable(write_tokens(docs, new_dir(docs.sparkSession, "tokens"), tokenizer, SEPARATOR, key, text), "token-rows")
    counts = count_tokens(rows.where("ordinal < 0").select("path", "bytes"), SEPARATOR, block_bytes)
    names = rows.where("ordinal >= 0").select(F.col("path").alias("key_path"), F.col("ordinal").alias("key_ordinal"), "key")
    joined = names.join(counts, (F.col("key_path") == counts["path"]) & (F.col("key_ordinal") == counts["ordinal"]))
    return joined.select(F.col("key").alias(key), "n_tokens")
