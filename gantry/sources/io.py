"""Sources and sinks: declared schemas, renames, Parquet, CSV, JSON lines, N-Triples, graph CSV, optional sheets."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterable, Iterator
from contextlib import closing

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gantry.functions.text import rename_all

#: Fixed value: the parent of a root in the hierarchy source.
EMPTY_GUID = "00000000-0000-0000-0000-000000000000"


def read_csv(spark: SparkSession, path: str, schema: StructType | str, names: dict[str, str] | None = None, drop: Iterable[str] = (), strict: bool = False) -> DataFrame:
    """A CSV with a header under a declared schema; NaN becomes NULL, columns get their canonical names."""
    df = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").csv(path, header=True).drop(*drop)
    clean = {c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")}
    return rename_all(df.withColumns(clean) if clean else df, names)


def read_hierarchy(spark: SparkSession, path: str) -> DataFrame:
    """(object_id, parent_id, level): roots have a NULL parent; text that is no number has a NULL level."""
    df = spark.read.schema("ObjectId string, ParentId string, Level string").csv(path, header=True)
    return df.select(F.col("ObjectId").alias("object_id"), F.nullif("ParentId", F.lit(EMPTY_GUID)).alias("parent_id"), F.col("Level").try_cast("double").try_cast("bigint").alias("level"))


def read_parquet(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """One or several files as one table; only the named columns are read."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    return df.select(*columns) if columns else df


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_sheet(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """A spreadsheet's sheet through pandas on the driver; needs openpyxl."""
    import pandas as pd

    return rename_all(spark.createDataFrame(pd.read_excel(path, sheet_name=sheet, dtype=str)))


def files(spark: SparkSession, path: str, pattern: str, done: DataFrame | None = None) -> DataFrame:
    """(path, length) of the files under a folder that are not in done(path); contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "length")
    return found if done is None else found.join(done.select("path"), "path", "left_anti")


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns, missing ones as NULL, so that no column is written without a type."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV parts with a header each, in UTF-8."""
    df.write.mode("overwrite").csv(path, header=True)


def write_csv_with_bom(df: DataFrame, path: str) -> None:
    """CSV parts for spreadsheets: each begins with the byte order mark of UTF-8, in front of its header."""
    first = df.columns[0]
    df.withColumnRenamed(first, "\ufeff" + first).write.mode("overwrite").csv(path, header=True)


def csv_profile(spark: SparkSession, path: str, rows: int = 100) -> tuple[int, StructType]:
    """Rows of a CSV with a header, and its schema as its first `rows` rows have it; only those are parsed for the schema.

    Rows are counted as parsed, so a quoted line break does not make two; a file is then one task's.
    """
    whole = spark.read.csv(path, header=True, multiLine=True)
    head = whole.limit(rows)
    text = head.select(F.to_csv(F.struct("*")).alias("value")).rdd.map(lambda r: r[0])
    kinds = spark.read.csv(text, inferSchema=True, multiLine=True).schema
    schema = StructType([StructField(n, f.dataType) for n, f in zip(head.columns, kinds, strict=True)])
    return whole.count(), schema


def parquet_footers(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, column, physical_type, logical_type) from the footers alone, read where the tasks run."""
    found = [(f,) for f in spark.read.parquet(path).inputFiles()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column("file").to_pylist():
                store, at = fs.FileSystem.from_uri(name)
                meta = pq.read_metadata(at, filesystem=store)
                own = [meta.schema.column(k) for k in range(meta.num_columns)]
                columns = [[name] * len(own), [meta.num_rows] * len(own), [c.path for c in own], [c.physical_type for c in own], [str(c.logical_type) for c in own]]
                yield pa.record_batch([pa.array(c) for c in columns], ["file", "rows", "column", "physical_type", "logical_type"])

    files = spark.createDataFrame(found, "file string").repartition(max(1, min(len(found), 200)))
    return files.mapInArrow(read, "file string, rows bigint, column string, physical_type string, logical_type string")


def write_sqlite(tables: dict[str, DataFrame], path: str, indexes: dict[str, list[str]] | None = None) -> dict[str, int]:
    """Replaces tables of one database file (on the driver, as the format is one file); rows pass through a partition at a time.

    indexes names the columns of each table to index. Returns the rows of each table.
    """
    kinds = {"int": "INTEGER", "bigint": "INTEGER", "boolean": "INTEGER", "double": "REAL", "float": "REAL", "binary": "BLOB"}
    out = {}
    with closing(sqlite3.connect(path)) as db:
        for name, df in tables.items():
            cols = ", ".join(f'"{c}" {kinds.get(t, "TEXT")}' for c, t in df.dtypes)
            plain = df.select(*[F.col(c) if t in kinds else F.col(c).cast("string") for c, t in df.dtypes])
            db.execute(f'DROP TABLE IF EXISTS "{name}"')
            db.execute(f'CREATE TABLE "{name}" ({cols})')
            rows = (tuple(r) for r in plain.toLocalIterator())
            done = db.executemany(f'INSERT INTO "{name}" VALUES ({", ".join("?" * len(df.columns))})', rows)
            out[name] = max(0, done.rowcount)
            for c in (indexes or {}).get(name, []):
                db.execute(f'CREATE INDEX "{name}_{c}" ON "{name}" ("{c}")')
            db.commit()
    return out


def read_sqlite(spark: SparkSession, path: str, statement: str, schema: str, most: int = 1_000_000) -> DataFrame:
    """Rows of one statement on a database file that is opened read-only; more than `most` rows raise, none are dropped."""
    with closing(sqlite3.connect(f"file:{path}?mode=ro", uri=True)) as db:
        rows = db.execute(statement).fetchmany(most + 1)
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: read tables of that size from Parquet")
    return spark.createDataFrame(rows, schema)


def write_graph_csv(df: DataFrame, path: str, heads: dict[str, str]) -> None:
    """Node or edge files with typed heads (":ID", ":LABEL", ":START_ID", ":END_ID", ":TYPE", "x:double")."""
    df.select(*[F.col(c).alias(h) for c, h in heads.items()]).write.mode("overwrite").csv(path, header=True)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def for_upload(df: DataFrame) -> DataFrame:
    """Whole numbers as doubles, times as ISO text, NULL texts as ''."""
    out = {}
    for c, t in df.dtypes:
        if t in ("int", "bigint"):
            out[c] = F.col(c).cast("double")
        elif t.startswith("timestamp"):
            out[c] = F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))
        elif t in ("string", "void"):
            out[c] = F.coalesce(F.col(c).cast("string"), F.lit(""))
    return df.withColumns(out)
