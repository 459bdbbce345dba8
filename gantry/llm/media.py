"""Media columns: content-addressed payloads in tar shards.

Each task writes its payloads into a tar shard of its own; an entry's name is the SHA-256 of the payload, and a
payload that the task knows to be written is not written again. Where tasks have stored one payload each, the digests
(not the payloads) are brought together and all rows refer to one entry, the least by shard and offset; so equal
payloads have one address, and the other entries are referred to by none. Rows carry digest, shard, offset and length. Metadata columns (format, width, height, bit depth) come from range reads of
the entry's first HEADER_BYTES alone; features from a range read of the whole entry, decoded.

A payload is the text in UTF-8, padded with spaces to a positive multiple of ROW_BYTES, and is stored as an 8-bit grey
PNG of width ROW_BYTES, which is lossless. A very long text is one image, held whole by the tasks that write and read it. Null and empty texts give one row of spaces. Repeated rows and equal texts
give equal values. An empty table gives an empty result. Columns other than key and text are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import by_bytes, durable, key_and_text, new_dir

ROW_BYTES = 192
#: Signature and IHDR of a PNG.
HEADER_BYTES = 33
SHARD_BYTES = 256 << 20
#: Digests that a writing task knows of before it begins anew (a copy is then stored once more).
KNOWN_DIGESTS = 200_000
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def padded(text: str | None) -> tuple[bytes, int]:
    """The payload and its length before padding."""
    raw = (text or "").encode()
    return raw + b" " * (max(ROW_BYTES, -(-len(raw) // ROW_BYTES) * ROW_BYTES) - len(raw)), len(raw)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """Each row of ROW_BYTES samples behind filter byte 0."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW_BYTES)
    lines = np.zeros((len(rows), ROW_BYTES + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", ROW_BYTES, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 4)) + _chunk(b"IEND", b"")


def header_of(head: bytes) -> tuple[str, int, int, int]:
    """(format, width, height, bit depth) from the first HEADER_BYTES of an entry."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a PNG entry")
    width, height, depth = struct.unpack(">IIB", head[16:25])
    return "png", width, height, depth


def from_png(stored: bytes) -> bytes:
    """The samples of a grey 8-bit PNG whose rows are unfiltered, as to_png writes it."""
    _, width, height, _ = header_of(stored)
    at, parts = 8, []
    while at < len(stored):
        (n,) = struct.unpack(">I", stored[at : at + 4])
        if stored[at + 4 : at + 8] == b"IDAT":
            parts.append(stored[at + 8 : at + 8 + n])
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("filtered rows")
    return lines[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """An average hash: 64 near-equal spans of the samples, a bit for each whose mean is over that of all; 16 hex digits."""
    x = np.frombuffer(payload, np.uint8)
    cuts = np.arange(65) * len(x) // 64
    upto = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    sums, sizes = upto[cuts[1:]] - upto[cuts[:-1]], np.diff(cuts)
    return np.packbits(sums * len(x) > upto[-1] * sizes).tobytes().hex()


def write_shards(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, digest, shard, offset, length) for each row; the payloads are in tar files under folder.

    Only shards of finished tasks are referred to; what a lost task left is not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, known = None, "", {}
        for b in (x for whole in batches for x in by_bytes([whole], "text")):
            rows = []
            for t in b.column("text"):
                payload, n = padded(t.as_py())
                digest = hashlib.sha256(payload).hexdigest()
                if digest not in known:
                    if out is None or out.tell() >= SHARD_BYTES:
                        _end(out)
                        name = f"{uuid.uuid4().hex}.tar"
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    if len(known) >= KNOWN_DIGESTS:
                        known.clear()
                    stored = to_png(payload)
                    entry = tarfile.TarInfo(f"{digest}.png")
                    entry.size = len(stored)
                    out.write(entry.tobuf(tarfile.USTAR_FORMAT if len(stored) < 8 << 30 else tarfile.GNU_FORMAT))
                    known[digest] = (name, out.tell(), len(stored))
                    out.write(stored + b"\0" * (-len(stored) % 512))
                rows.append((n, digest, *known[digest]))
            columns = [b.column("key"), *[pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)]]
            yield pa.record_batch(columns, ["key", "n_bytes", "digest", "shard", "offset", "length"])
        _end(out)

    kind = docs.schema[key].dataType.simpleString()
    return key_and_text(docs, key, text).mapInArrow(run, f"key {kind}, n_bytes bigint, digest string, shard string, offset bigint, length bigint")


def _end(out) -> None:
    if out is not None:
        out.write(b"\0" * 1024)
        out.close()


class Shards:
    """Range reads of entries; one shard is held open."""

    def __init__(self, folder: str) -> None:
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.name, self.file = None, None

    def read(self, shard: str, offset: int, n: int) -> bytes:
        if shard != self.name:
            if self.file is not None:
                self.file.close()
            self.name, self.file = shard, self.store.open_input_file(f"{self.root}/{shard}")
        return self.file.read_at(n, offset)


def metadata(rows: DataFrame, folder: str) -> DataFrame:
    """rows with format, width, height and bit_depth, from header-only range reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(folder)
        for b in batches:
            at = list(zip(b.column("shard").to_pylist(), b.column("offset").to_pylist(), strict=True))
            seen = {x: header_of(shards.read(*x, HEADER_BYTES)) for x in sorted(set(at))}
            got = [pa.array([seen[x][k] for x in at], pa.string() if k == 0 else pa.int64()) for k in range(4)]
            yield pa.record_batch([*b.columns, *got], [*b.schema.names, "format", "width", "height", "bit_depth"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, format string, width bigint, height bigint, bit_depth bigint")


def features(rows: DataFrame, folder: str) -> DataFrame:
    """rows with payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256 and feature, from the stored bytes."""
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def of(stored: bytes) -> tuple:
        payload = from_png(stored)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(folder)
        for b in batches:
            at = list(zip(*[b.column(c).to_pylist() for c in ("shard", "offset", "length")], strict=True))
            seen = {x: of(shards.read(*x)) for x in sorted(set(at))}
            got = [pa.array([seen[x][k] for x in at], t) for k, t in enumerate(kinds)]
            yield pa.record_batch([*b.columns, *got], [*b.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")


def media_columns(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stores the payloads, then reads them back: a row for each row of docs."""
    folder = new_dir(docs.sparkSession, "media")
    rows = addressed(durable(write_shards(docs, folder, key, text), "media-rows"))
    return features(metadata(rows, folder), folder).withColumnRenamed("key", key)


def addressed(rows: DataFrame) -> DataFrame:
    """rows with one (shard, offset, length) for each digest, dealt so that a task reads few shards from front to back."""
    place = F.struct("shard", "offset", "length")
    one = rows.groupBy("digest").agg(F.min(place).alias("place"), F.max(place).alias("last")).where("place <> last")
    moved = durable(one.select(F.col("digest").alias("moved_digest"), "place"), "media-moved")
    at = {c: F.coalesce(F.col("place")[c], F.col(c)) for c in ("shard", "offset", "length")}
    named = rows.join(moved, rows["digest"] == moved["moved_digest"], "left").withColumns(at).select(rows.columns)
    return named.repartitionByRange("shard", "offset", F.xxhash64("key")).sortWithinPartitions("shard", "offset")
