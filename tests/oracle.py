"""Runs a query in Spark and its SQL in DuckDB, and compares the rows in any order."""

from __future__ import annotations

import glob
import os

import duckdb


def plain(value):
    if value is None or value != value:
        return "NULL"
    if hasattr(value, "tolist"):
        value = value.tolist()
    return repr(float(value)) if isinstance(value, float) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, want.fetchall())
