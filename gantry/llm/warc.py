"""WARC: a writer with revisit records, and a Python data source that parses headers first.

Records are gzip members of their own, each with the length of the member in its header ('sl' extra field, WARC annex
D), so a reader that does not want a record's payload goes on to the next member without inflating it. The data source
plans partitions over files, takes filters on record type and header columns, and inflates a payload only if the
option `payload` is true and the record has passed them.

Null urls have no target header, null texts an empty payload, null page ids the id "null" and count as less than all
others. Repeated rows are written each. An empty table gives no records. Other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, StringStartsWith

from gantry.llm.common import bound_batches, by_bytes, durable, new_dir

#: Payloads under this many bytes are never revisits.
LEAST_SHARED = 1000
#: Bytes after which a task begins a new file, and bytes of small files that are read by one task.
FILE_BYTES, PARTITION_BYTES = 128 << 20, 16 << 20
#: Bytes of payload in one Arrow batch, and of compressed input read at once.
BATCH_BYTES, READ_BYTES = 4 << 20, 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


# writing ---------------------------------------------------------------------------------------------------------


def member(record: bytes, level: int = 1) -> bytes:
    """A gzip member with its own length and that of the record in the 'sl' field; zeros where they pass 32 bits."""
    made = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = made.compress(record) + made.flush()
    size = 24 + len(body) + 8
    sizes = (size, len(record)) if max(size, len(record)) < 1 << 32 else (0, 0)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, *sizes)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record(kind: str, record_id: str, uri: str | None, digest: str, payload: bytes, size: int, refers_to: str | None, date: str = "2000-01-01T00:00:00Z") -> bytes:
    """One response or revisit record; of a revisit only the HTTP header, which still has the payload's length."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + uri.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_urn(page_id: object) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def write(rows: DataFrame, path: str) -> list[str]:
    """Writes (page_id, url, payload, digest, size, refers_to, revisit) as WARC files; returns the files of finished tasks.

    A task that was lost may have left other files in the folder; they are not in the list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_fs(path)
        store.create_dir(root, recursive=True)
        out, name, done = None, "", []
        for b in (x for whole in batches for x in by_bytes([whole], "payload", BATCH_BYTES)):
            for page_id, url, payload, digest, size, refers_to, revisit in zip(*[b.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "size", "refers_to", "revisit")], strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                kind = "revisit" if revisit else "response"
                out.write(member(record(kind, page_urn(page_id), url, digest, payload or b"", size, page_urn(refers_to) if revisit else None)))
                if out.tell() >= FILE_BYTES:
                    out.close()
                    done.append(name)
                    out = None
        if out is not None:
            out.close()
            done.append(name)
        yield pa.record_batch([pa.array([f"{path}/{x}" for x in done], pa.string())], ["path"])

    made = durable(rows.mapInArrow(run, "path string"), "warc-files")
    return sorted(r["path"] for r in made.collect())


def archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> list[str]:
    """Writes a record for each page; of equal payloads of LEAST_SHARED bytes or more, all but that of the greatest key revisit it."""
    body = F.coalesce(pages[html], F.lit("")).cast("binary")
    rows = pages.select(pages[key].alias("page_id"), pages[url].alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.length("payload").cast("bigint")})
    light = durable(rows.where(F.col("size") >= LEAST_SHARED).select("page_id", "digest"), "payload-digests")
    kept = light.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    shared = light.join(kept.withColumnRenamed("digest", "kept_digest"), light["digest"] == F.col("kept_digest")).where("NOT page_id <=> refers_to")
    again = durable(shared.select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to").distinct(), "revisits")
    rows = rows.join(again, rows["page_id"].eqNullSafe(again["again_id"]) & (rows["digest"] == again["again_digest"]), "left")
    revisit = F.col("refers_to").isNotNull()
    return write(rows.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "digest", "size", "refers_to", revisit.alias("revisit")), path)


# reading ---------------------------------------------------------------------------------------------------------


class Files(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        super().__init__(paths)
        self.paths = paths


class Members:
    """Gzip members of a stream: open one, inflate as much of it as is asked for, go to the next.

    A member with its length in the 'sl' field is taken out of the stream whole, compressed, and is dropped as cheaply;
    of any other the end is found by inflating.
    """

    def __init__(self, stream) -> None:
        self.stream, self.held, self.at = stream, b"", 0

    def _fill(self, n: int) -> bool:
        """Holds n bytes from `at` on, if the stream has them."""
        while len(self.held) - self.at < n:
            more = self.stream.read(max(READ_BYTES, n))
            if not more:
                return False
            self.held, self.at = self.held[self.at :] + more, 0
        return True

    def open(self) -> bool:
        """Begins the next member; false at the end of the file."""
        if not self._fill(1):
            return False
        self._fill(24)
        head = self.held[self.at : self.at + 24]
        size = struct.unpack("<I", head[16:20])[0] if head[3:4] == b"\x04" and head[12:14] == b"sl" else 0
        self.inflate, self.out, self.whole = zlib.decompressobj(31), b"", size > 0
        if self.whole:
            if not self._fill(size):
                raise EOFError("a gzip member breaks off")
            self.data = self.held[self.at : self.at + size]
            self.at += size
        else:
            self.data = b""
        return True

    def upto(self, mark: bytes) -> bytes:
        """The member's bytes up to and with the mark."""
        while (at := self.out.find(mark)) < 0 and self._more(2048):
            pass
        at = len(self.out) if at < 0 else at + len(mark)
        got, self.out = self.out[:at], self.out[at:]
        return got

    def take(self, n: int) -> bytes:
        parts, size = [self.out], len(self.out)
        self.out = b""
        while size < n and self._more(max(1 << 16, n - size)):
            parts.append(self.out)
            size += len(self.out)
            self.out = b""
        got = b"".join(parts)
        self.out = got[n:]
        return got[:n]

    def _more(self, most: int) -> bool:
        while not self.inflate.eof:
            if not self.data:
                if self.whole or not self._fill(1):
                    raise EOFError("a gzip member breaks off")
                self.data = self.held[self.at : self.at + (1 << 14)]
                self.at += len(self.data)
            made = self.inflate.decompress(self.data, most)
            self.data = self.inflate.unconsumed_tail
            if made:
                self.out += made
                return True
        return False

    def close(self) -> None:
        """Goes to the end of the member."""
        if self.whole:
            self.data = b""
            return
        while self._more(1 << 16):
            self.out = b""
        self.at -= len(self.inflate.unused_data)


def headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.paths = json.loads(options["paths"]) if "paths" in options else None
        self.path, self.payload = options.get("path"), str(options.get("payload", "false")).lower() == "true"
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) else ""
            known = column in ("record_id", "record_type", "target_uri", "refers_to", "payload_digest") and len(f.attribute) == 1
            if known and isinstance(f, EqualTo):
                self.wanted.append(("equal", column, f.value))
            elif known and isinstance(f, In):
                self.wanted.append(("in", column, list(f.value)))
            elif known and isinstance(f, StringStartsWith):
                self.wanted.append(("prefix", column, f.value))
            elif known and isinstance(f, IsNotNull):
                self.wanted.append(("set", column, None))
            elif known and isinstance(f, IsNull):
                self.wanted.append(("unset", column, None))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        """Whole files, small ones together up to PARTITION_BYTES."""
        if self.paths is not None:
            found = []
            for p in self.paths:
                store, at = open_fs(p)
                found.append((store.get_file_info(at).size, p))
        else:
            store, root = open_fs(self.path)
            base = self.path.rstrip("/")
            infos = store.get_file_info(fs.FileSelector(root, recursive=False))
            found = sorted((i.size, f"{base}/{i.base_name}") for i in infos if i.base_name.endswith(".warc.gz"))
        out: list[Files] = []
        held, size = [], 0
        for n, p in found:
            if held and size + n > PARTITION_BYTES:
                out.append(Files(held))
                held, size = [], 0
            held.append(p)
            size += n
        return [*out, Files(held)] if held or not out else out

    def _fits(self, row: dict[str, object]) -> bool:
        for how, column, value in self.wanted:
            x = row[column]
            if how == "equal" and x != value or how == "in" and x not in value or how == "prefix" and not (x or "").startswith(value) or how == "set" and x is None or how == "unset" and x is not None:
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for path in partition.paths:
            store, at = open_fs(path)
            with store.open_input_stream(at, compression=None) as stream:
                members = Members(stream)
                while members.open():
                    row = self._record(members)
                    members.close()
                    if row is not None:
                        rows.append(row)
                        size += 200 + len(row["payload"] or b"")
                    if size > BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _record(self, members: Members) -> dict[str, object] | None:
        h = headers(members.upto(b"\r\n\r\n"))
        bare = lambda x: None if x is None else x.strip("<>")
        digest, uri = h.get("warc-payload-digest"), h.get("warc-target-uri")
        row: dict[str, object] = {
            "record_id": bare(h.get("warc-record-id")), "record_type": h.get("warc-type"),
            "target_uri": None if uri is None else uri.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%"),
            "refers_to": bare(h.get("warc-refers-to")), "payload_digest": None if digest is None else digest.partition(":")[2] or digest,
            "payload_bytes": None, "payload": None,
        }
        if not self._fits(row):
            return None
        if h.get("content-type", "").startswith("application/http"):
            http = members.upto(b"\r\n\r\n")
            row["payload_bytes"] = int(headers(http).get("content-length", 0))
            if self.payload and row["record_type"] == "response":
                row["payload"] = members.take(int(h["content-length"]) - len(http))
        elif self.payload:
            row["payload"] = members.take(int(h["content-length"]))
        return row


def _batch(rows: list[dict[str, object]]) -> pa.RecordBatch:
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    return pa.record_batch([pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in rows[0]], list(rows[0]))


class WarcDataSource(DataSource):
    """spark.read.format("warc"): options path (a folder) or paths (a JSON list of files), and payload (true or false)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read(spark: SparkSession, paths: list[str], payload: bool = False) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("paths", json.dumps(paths)).option("payload", str(payload).lower()).load()


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Archives the pages, reads the archives back: (key, payload_bytes, payload_digest, record_type, refers_to).

    Lengths and digests of responses are those of the payload as read; revisits have them in their headers.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    files = archive(pages, new_dir(spark, "warc"), key, url, html)
    # two scans: payloads are decoded for responses only, revisits are known by their headers
    responses = read(spark, files, payload=True).where("record_type = 'response'")
    records = responses.unionByName(read(spark, files).where("record_type = 'revisit'"))
    kind = pages.schema[key].dataType
    number = lambda c: F.regexp_extract(c, "^urn:page:(.*)$", 1)
    full = F.col("record_type") == "response"
    return records.select(
        F.expr("try_cast(regexp_extract(record_id, '^urn:page:(.*)$', 1) AS " + kind.simpleString() + ")").alias(key),
        F.when(full, F.length("payload").cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.when(F.col("refers_to").isNotNull(), number(F.col("refers_to")).cast(kind)).alias("refers_to"),
    )
