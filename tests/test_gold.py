"""The build of the asset table on small frames of our own."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gantry.functions import text
from gantry.operators import gold
from gantry.operators import relational as rel

BASE = "object_id string, mesh_quality string, adjacency_count bigint, display_name string, has_real_mesh boolean, bbox_volume_m3 double"


def test_flags(spark):
    rows = [("a", "skipped_container", 0, "x", None, None), ("b", "skipped_container", None, "x", False, 1.0), ("c", "skipped_container", 3, "x", True, 9.0), ("d", "box_placeholder", 1, "INSULATION volume", True, 5.0),
            ("e", None, None, None, None, 8.9), ("f", "full_mesh", 1, "ok", True, 1.0), ("g", None, None, None, False, 100.0)]
    got = {r["object_id"]: r for r in gold.add_flags(spark.createDataFrame(rows, BASE)).collect()}
    assert [k for k, r in got.items() if r["is_container"]] == ["a", "b"]
    assert [k for k, r in got.items() if r["is_parent_box"]] == ["g"]  # the bound is 8.92, of 1, 5 and 9
    assert [k for k, r in got.items() if r["is_analysis_volume"]] == ["d"] == [k for k, r in got.items() if r["is_bbox_placeholder"]]
    assert [k for k, r in got.items() if r["graph_participant"]] == ["c", "e", "f"]
    assert not got["e"]["has_own_geometry"] and got["c"]["has_own_geometry"]
    none = gold.add_flags(spark.createDataFrame([("a", None, None, None, None, 1.0)], BASE)).first()
    assert none["is_parent_box"]  # nothing has a mesh: the bound is 0
    assert gold.add_flags(spark.createDataFrame([], BASE)).collect() == []


def test_si_units_of_absent_columns(spark):
    df = gold.add_si_units(spark.createDataFrame([("178.55 lbm", "4in x 0"), (None, "")], "sp3d_dry_weight string, sp3d_npd string"))
    first, second = df.collect()
    assert first["dry_weight_kg"] == pytest.approx(80.989, abs=1e-3) and (first["npd_end1_m"], first["npd_end2_m"]) == (pytest.approx(0.1016), 0.0)
    assert all(first[c] is None for c in ("wet_weight_kg", "length_m", "design_pressure_kpa")) and all(second[c] is None for c in gold.SI_COLUMNS)


CONFIDENCE = [
    ("Structure", None, None, None, "HIGH", "xlsx_class_clean"), (None, "P", "c", "x", "HIGH", "xlsx_class_clean"), ("Piping", "P", "c", "Pipe Rack", "HIGH", "piping_has_pipeline_and_metadata"),
    ("Piping", "P", None, None, "LOW", "piping_pipeline_only"), ("Piping", "", "", None, "LOW", "piping_metadata_only"), ("Piping", None, None, "A > PIPE rack", "LIKELY_BUG", "piping_no_metadata_pipe_rack_folder"),
    ("Piping", "", None, "Pipe Rack > PipeTrench", "LIKELY_BUG", "piping_no_metadata_pipe_trench_folder"), ("Piping", None, None, "steel pipelines", "LIKELY_BUG", "piping_no_metadata_pipeline_folder"),
    ("Piping", None, None, "Steel", "LIKELY_BUG", "piping_no_metadata_steel_tee_substring"), ("Piping", None, None, None, "LIKELY_BUG", "piping_no_metadata_unknown"),
]


def test_confidence(spark):
    rows = [(i, c, p, m, path) for i, (c, p, m, path, *_) in enumerate(CONFIDENCE)]
    df = spark.createDataFrame(rows, "i int, refined_class string, sp3d_pipeline string, sp3d_commodity_code string, system_path string")
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("sp3d_short_code", "sp3d_spec_name", "sp3d_npd")})
    got = [(r["classification_confidence"], r["classification_confidence_reason"]) for r in gold.add_confidence(df).orderBy("i").collect()]
    assert got == [x[4:] for x in CONFIDENCE]


CLASSES = [
    ([("Item|Class", "DisplayString: Piping")], "", "", "Piping"), ([("__Class", "no"), ("classDisplayName", "Any Thing")], "", "pump", "Any Thing"), ([("Class", "displaystring:  "), ("X|Pipeline", "")], "", "", "Piping"),
    ([("Equipment Name", ""), ("PipeRun", "")], "", "", "Piping"), ([("Eqp Type 3", "")], "pipe", "", "Equipment"), ([("__pipeline", "")], "", "Valve-3", "Piping"),
    ([], "A\\Pipe Rack", "", "Other"), ([], "A\\Pipe  Rack\\steel", "", "Structure"), (None, "pipe", "pump", "Piping"), ([], "", "Tank beam", "Equipment"), ([], "Beam_Block", None, "Other"),
    ([("cable", "")], None, None, "Electrical"), ([], "duct", "instrument", "HVAC"), ([], "instrument", "", "Instrumentation"), ([], "", "ventilation", "Other"),
]


def test_infer_class(spark):
    rows = [(i, p, s, n) for i, (p, s, n, _) in enumerate(CLASSES)]
    df = spark.createDataFrame(rows, "i int, properties array<struct<key:string,value:string>>, path string, name string")
    got = df.select("i", gold.infer_class(F.col("properties"), F.col("path"), F.col("name")).alias("c")).orderBy("i").collect()
    assert [r["c"] for r in got] == [x[3] for x in CLASSES]


def test_build_checks_its_joins(spark):
    one = spark.createDataFrame([("a", 1), ("a", 2)], "object_id string, v int")
    with pytest.raises(ValueError, match="not unique"):
        gold.build(one.drop("v"), [], "r", "1", "now")
    with pytest.raises(ValueError, match="a side"):
        gold.build(one.select("object_id").distinct(), [(one, "object_id")], "r", "1", "now")


def test_rollup_without_weights(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, 3.0)], "i int, w double, x double")
    got = df.agg(rel.weighted_mean(F.col("x"), F.coalesce("w", F.lit(0.0))).alias("m"), rel.positive_sum(F.coalesce("w", F.lit(0.0))).alias("s")).first()
    assert got["m"] == 2.0 and got["s"] is None


@pytest.mark.parametrize(("raw", "want"), [("P-101", "P-101"), ("P_101", "P_101"), (" a  b/c ", "a_b_c"), ("__", "unknown"), ("a__b", "a_b"), ("배관 1", "1"), ("-", "-")])
def test_uri_safe(spark, raw, want):
    assert spark.range(1).select(text.uri_safe(F.lit(raw))).first()[0] == want


@pytest.mark.parametrize(("raw", "want"), [("Class", "class_raw"), ("SmartPlant 3D|Dry Weight", "sp3d_dry_weight"), ("SmartPlant 3D|A|B", "sp3d_a_b"), ("Nav Item|GUID", "nav_item_guid"), ("Eqp_ Type", "eqp_type"), ("재질|이름", "재질_이름"), ("DryCGX", "dry_cgx"), ("HTTPServer2Go", "http_server2_go")])
def test_headers(spark, raw, want):
    assert text.header(raw) == want
    assert spark.range(1).select(text.header_column(F.lit(raw))).first()[0] == want


def test_exact_quantiles(spark, monkeypatch):
    monkeypatch.setattr(rel, "BINS", 7)
    rng = random.Random(3)
    for values in ([1.0], [2.0, 2.0, 2.0], [rng.choice([0.0, 1.0, 1e9]) for _ in range(50)], [rng.gauss(0, 1) for _ in range(301)], [-1e300, 0.0, 1e-300, 5.0, math.nan]):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
        shares = (0.0, 0.25, 0.5, 0.9, 0.99, 1.0)
        real = [v for v in values if not math.isnan(v)]
        assert rel.exact_quantiles(df, "v", shares) == pytest.approx(np.quantile(real, shares).tolist(), rel=1e-12)
    assert rel.exact_quantile(df.limit(0), "v", 0.5) is None


def test_place_in(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2]), rng.random(), i) for i in range(500)]
    got = rel.place_in(spark.createDataFrame(rows, "k int, x double, i int").repartition(5), "k", [F.col("x"), F.col("i")], "place").collect()
    for key in (None, 1, 2):
        own = sorted((r["x"], r["i"], r["place"]) for r in got if r["k"] == key)
        assert [p for *_, p in own] == list(range(1, len(own) + 1))
