import pytest
from pyspark.sql import functions as F

from gantry.functions import text, units


def value(spark, raw, f):
    return spark.createDataFrame([(raw,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "metres"),
    [("21 ft  4.00 in", 6.5024), ("24 ft  0  in", 7.3152), ("2 1/2 in", 0.0635), ("3/4 in", 0.01905), ("24 ft   .43 in", 7.326122), ("200 mm", 0.2), ("3 ft", 0.9144), ("1/0 in", None), ("2.5 1/2 in", None), ("", None), (None, None), ("none", None), ("1.5 ft 6 in", 0.6096), ("-2 ft", -0.6096), ("-2 1/2 in", None), ("2 ft 1/0 in", None), ("5. in", None), ("-.5 in", -0.0127), ("2 ft -3 in", 0.5334), ("\u00a04\u2003in ", 0.1016), ("7 / 8 in", None), ("1 ft", 0.3048), ("3 ft 5", None)],
)
def test_length(spark, raw, metres):
    assert value(spark, raw, units.length_m) == (metres if metres is None else pytest.approx(metres, abs=1e-6))


@pytest.mark.parametrize(
    ("f", "raw", "want"),
    [
        (units.weight_kg, "178.55 lbm", 80.98892), (units.weight_kg, "1 LBM", 0.45359237), (units.weight_kg, ".5 lbm", None), (units.weight_kg, "24 kg", None),
        (units.pressure_kpa, "0.00 psi", 0.0), (units.pressure_kpa, None, None), (units.temperature_c, "492.80 F", 256.0), (units.temperature_c, "492.80 f", None), (units.npd_inches, "25.4mm pipe", 1.0),
        (units.weight_kg, "-2 lbm", -0.90718), (units.weight_kg, "5. lbm", None), (units.pressure_kpa, "-1.5 psi", -10.3421355), (units.pressure_kpa, "5. psi", None), (units.pressure_kpa, ".5 psi", None),
        (units.temperature_c, "-40 F", -40.0), (units.temperature_c, "5. F", None), (units.npd_inches, "-2 in x", -2.0), (units.npd_inches, "x 2 in", None),
    ],
)
def test_units(spark, f, raw, want):
    assert value(spark, raw, f) == (want if want is None else pytest.approx(want, abs=1e-4))


@pytest.mark.parametrize(("raw", "want"), [("4in x 6in", (0.1016, 0.1524)), ("4in x 0", (0.1016, 0.0)), ("100mm x 50mm", (0.1, 0.05)), ("4 in", (0.1016, 0.1016)), ("4in x 50mm", None), ("", None), ("-4in x .5in", (-0.1016, 0.0127)), ("4.in", None), ("100mm x 0", (0.1, 0.0)), ("4in x 0.0", None), (".5 MM", (0.0005, 0.0005))])
def test_npd(spark, raw, want):
    got = value(spark, raw, units.npd_m)
    assert got == want if want is None else tuple(got) == pytest.approx(want)


@pytest.mark.parametrize(("raw", "want"), [("PipeRun", "pipe_run"), ("DryCGX", "dry_cgx"), ("Eqp Type 0", "eqp_type_0"), ("__A-b__", "a_b")])
def test_snake_case(spark, raw, want):
    assert text.snake_case(raw) == want
    assert value(spark, raw, text.snake_case_column) == want


def test_names(spark):
    assert value(spark, "DisplayString: x ", text.clean_prefix) == "x"
    assert value(spark, " x ", text.clean_prefix) == " x "
    assert value(spark, None, text.clean_prefix) == ""
    assert value(spark, "A|b|c", text.after_bar) == "b|c"
    assert value(spark, "abc", text.after_bar) == "abc"
    assert value(spark, "a b//c", text.uri_safe) == "a_b_c"
    assert value(spark, "##", text.uri_safe) == "unknown"
    assert value(spark, "x ASTM-a312-tp304", text.astm_grade) == "A312-TP304"
    assert value(spark, "steel", text.astm_grade) is None


def test_rename_collision(spark):
    with pytest.raises(ValueError, match="collide"):
        text.rename_all(spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int"))
