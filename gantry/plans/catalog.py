"""All registered queries over the driver's tables, with their DuckDB twins."""

from __future__ import annotations

from gantry.plans import base, extra, gold, graphs, knowledge, rollups, scalars, silver, structure  # noqa: F401

QUERIES, ORACLES = base.QUERIES, base.ORACLES
