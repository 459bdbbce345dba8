"""What the operators of this package share: durable tables, byte-bounded batches, words."""

from __future__ import annotations

import atexit
import ctypes
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import gantry

# Executors need not have this package on their path: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(gantry)

#: Java regex for one run of the six white-space bytes that separate words.
SPACES = r"[\x20\x09-\x0D]+"

#: Most bytes of text that a Python worker holds as one batch.
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir, or a temporary one where it is unset and the master is local (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isDefined():
            return jsc.getCheckpointDir().get()
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster, name a folder there that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="gantry-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(remove_dir, spark, path)
    return path


def remove_dir(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM may have gone before the driver's Python
        pass


def durable(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: cuts the lineage, survives lost executors."""
    path = new_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, most: str = "8m") -> None:
    """Lets Spark hand at most about `most` to Python at once (its default is 64 MB), for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def key_and_text(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The two columns an operator needs, under its own names; other columns may have any names."""
    bound_batches(docs.sparkSession)
    return docs.select(docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lowered; bytes.lower() and bytes.split() know ASCII only, which is the contract."""
    return (text or "").encode().lower().split()


def shelf(name: str) -> dict:
    """A dictionary of this worker process that outlives a task: this package travels with each task and is made anew there."""
    held = sys.modules.setdefault("_gantry_shelf", types.ModuleType("_gantry_shelf"))
    return vars(held).setdefault(name, {})


def give_back() -> None:
    """Returns to the system what earlier tasks of this Python worker have freed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that the strings of one column come to about `most` bytes; one longer row stands alone."""
    for b in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(b.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield b.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < b.num_rows:
            yield b.slice(start)
