"""Cutting lineage with a reliable checkpoint or a written table, which outlive lost executors and are removed when the driver ends."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def _shared(df: DataFrame) -> str:
    """The checkpoint folder (a temporary one where it is unset and the master is local, as in tests)."""
    context = df.sparkSession.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        spark = df.sparkSession
        found, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
        if not found and (not master.startswith("local") or master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster, name a folder there that all executors share")
        spark.sparkContext.setCheckpointDir(found or tempfile.mkdtemp(prefix="gantry-"))
    folder = context.getCheckpointDir().get()
    if folder not in _checkpoints:  # Spark makes one of its own under the folder that is set, for this driver alone
        _checkpoints.add(folder)
        atexit.register(_remove, df.sparkSession, folder)
    return folder


_checkpoints: set[str] = set()


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may have gone before the driver's Python
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut(df: DataFrame) -> DataFrame:
    """df, computed and kept in the folder of spark.checkpoint.dir."""
    _shared(df)
    return df.checkpoint(eager=True)


def new_folder(df: DataFrame) -> str:
    """A fresh path among the kept tables, for files of another form."""
    return f"{_shared(df)}/{uuid.uuid4().hex}"


@contextlib.contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What a write has shuffled is removed when it is done, and not when the driver's memory is next cleared."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame) -> DataFrame:
    """As cut(), for loops of many rounds: a table knows its size, where a checkpoint's guess is the product of all rounds before."""
    path = new_folder(df)
    with _shuffles_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a bucket.
ROWS_A_BUCKET = 1_000_000


def buckets_of(df: DataFrame, rows: int) -> int:
    """Buckets for so many rows: never fewer than a shuffle has tasks, as a join would deal the rows anew then."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_BUCKET))


def bucketed(df: DataFrame, key: str, n: int, then: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """As written(), in n buckets by the key, so that rounds of joins by it do not move these rows again; `then` is done to the rows once they are dealt."""
    path, name = new_folder(df), f"kept_{uuid.uuid4().hex}"
    with _shuffles_go(df.sparkSession):
        then(df.repartition(n, key)).write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(name)
    atexit.register(_drop, df.sparkSession, name)
    return df.sparkSession.table(name)


def _drop(spark: SparkSession, name: str) -> None:
    with contextlib.suppress(Exception):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
