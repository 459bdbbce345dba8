"""Lineage events and catalog reports about tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from gantry.operators.graph import closure
from gantry.operators.relational import column_stats


def events(job: str, inputs: dict[str, DataFrame], outputs: dict[str, DataFrame], when: str, columns: dict[str, list[str]] | None = None) -> list[str]:
    """START and COMPLETE events of one run as JSON lines, with schema, row count and column lineage facets."""
    run = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{job}/{when}"))

    def dataset(name: str, df: DataFrame, counted: bool) -> dict[str, object]:
        facets: dict[str, object] = {"schema": {"fields": [{"name": n, "type": t} for n, t in df.dtypes]}}
        if counted:
            facets["outputStatistics"] = {"rowCount": df.count()}
            facets["columnLineage"] = {"fields": columns or {}}
        return {"name": name, "facets": facets}

    base = {"job": {"name": job, "facets": {"jobType": {"processingType": "BATCH"}}}, "run": {"runId": run}, "eventTime": when, "inputs": [dataset(n, d, False) for n, d in inputs.items()]}
    return [json.dumps(base | {"eventType": "START", "outputs": []}), json.dumps(base | {"eventType": "COMPLETE", "outputs": [dataset(n, d, True) for n, d in outputs.items()]})]


def summary(lines: list[str]) -> str:
    """What a set of events tells, as one JSON text: runs, events of each type, and rows of each output."""
    told = [json.loads(x) for x in lines]
    kinds = sorted({e["eventType"] for e in told})
    rows = {o["name"]: o["facets"]["outputStatistics"]["rowCount"] for e in told if e["eventType"] == "COMPLETE" for o in e["outputs"]}
    return json.dumps({"jobs": sorted({e["job"]["name"] for e in told}), "runs": len({e["run"]["runId"] for e in told}), "events": {k: sum(e["eventType"] == k for e in told) for k in kinds}, "rows": rows}, ensure_ascii=False)


def upstream(job_inputs: DataFrame) -> DataFrame:
    """(node, ancestor, depth) over (job, dataset) links given as child and parent."""
    return closure(job_inputs, "child", "parent")


def dot(links: list[tuple[str, str]]) -> str:
    return "digraph lineage {\n" + "".join(f'  "{a}" -> "{b}";\n' for a, b in sorted(links)) + "}\n"


def catalog_report(spark: SparkSession, tables: dict[str, DataFrame]) -> str:
    """A Markdown section for each table: rows, and nulls and distinct values of every column."""
    lines = []
    for name, df in tables.items():
        n = df.count()
        lines += [f"## {name}", "", f"{n} rows", "", "| column | type | nulls | distinct |", "|---|---|---|---|"]
        kinds = dict(df.dtypes)
        lines += [f"| {r['column']} | {kinds[r['column']]} | {r['nulls']} | {r['distinct_values']} |" for r in column_stats(df).collect()] + [""]
    return "\n".join(lines)
