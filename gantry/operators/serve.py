"""The read-only query surface: SQL with parameters, full text, neighbours, KPIs; errors are values at this edge only."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.functions.text import tokens

_READS = re.compile(r"^\s*(SELECT|WITH)\b", re.IGNORECASE)
_WRITES = re.compile(r"\b(INSERT|UPDATE|DELETE|MERGE|DROP|CREATE|ALTER|TRUNCATE|REFRESH|CACHE|SET)\b", re.IGNORECASE)


def run_sql(spark: SparkSession, text: str, args: dict[str, object] | None = None, limit: int = 100) -> dict[str, object]:
    """{"rows": [JSON]} of one SELECT or WITH statement, at most `limit` rows taken in the plan, or {"error": message}."""
    bare = re.sub(r"'(?:[^']|'')*'", "''", text)
    if not _READS.match(bare) or _WRITES.search(bare) or ";" in bare.rstrip().rstrip(";"):
        return {"error": "only one SELECT or WITH statement is allowed"}
    try:
        return {"rows": [r[0] for r in spark.sql(text.rstrip().rstrip(";"), args or {}).limit(limit).select(F.to_json(F.struct("*"))).collect()]}
    except PySparkException as e:
        return {"error": str(e).splitlines()[0]}


def token_index(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(token, key): once for each row and token of the columns; write it to search again without a scan of the texts."""
    return df.select(key, F.explode(tokens(F.concat_ws(" ", *columns))).alias("token"))


def text_search(index: DataFrame, key: str, words: str, limit: int = 30) -> DataFrame:
    """Keys of the rows that have every word, the least keys first."""
    wanted = sorted(set(re.findall(r"[a-z0-9_]+", words.lower())))
    return index.where(F.col("token").isin(wanted)).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") == len(wanted)).select(key).orderBy(key).limit(limit)


def list_objects(objects: DataFrame, cls: str | None = None, group: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    out = objects
    for column, value in (("cls", cls), ("grp", group)):
        if value is not None:
            out = out.where(F.col(column) == value)
    return out.orderBy("id").offset(offset).limit(min(limit, 500))


def get_object(objects: DataFrame, key: object) -> dict[str, object]:
    row = objects.where(F.col("id") == key).first()
    return row.asDict() if row is not None else {"error": "404"}


def neighbors(symmetric: DataFrame, objects: DataFrame, key: object, relation: str | None = None, limit: int = 100) -> DataFrame:
    out = symmetric.where(F.col("src") == key)
    if relation is not None:
        out = out.where(F.col("relation") == relation)
    return out.join(objects.select(F.col("id").alias("dst"), "name", "cls"), "dst").orderBy("dst").limit(min(limit, 100))


def by_name(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows of that name; without one, rows of it in another case."""
    ranked = df.where(F.lower(column) == name.lower()).withColumn("_exact", F.col(column) == name)
    best = ranked.agg(F.max("_exact")).scalar()
    return ranked.where(F.col("_exact") == best).drop("_exact")
