"""Unit strings to SI, as Column expressions. Text that does not parse gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres and kilograms of the units, kilopascals of one psi.
FOOT, INCH, MILLIMETRE, POUND, PSI = 0.3048, 0.0254, 0.001, 0.45359237, 6.894757

#: The grammar of numbers. A number may be negative and may lead with its point, but not end with it; weights,
#: pressures and temperatures have a digit before the point. Inches may have a fraction beside a number or alone.
NUMBER = r"-?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)"
PLAIN_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?"
INCHES = rf"(?:{NUMBER}(?:\s+[0-9]+/[0-9]+)?|[0-9]+/[0-9]+)"


def _whole(form: str, exact_case: bool = False) -> str:
    """A pattern of a whole text: any white space about it, and either case unless exact_case."""
    return f"(?{'U' if exact_case else 'iU'})^\\s*{form}\\s*$"


def _get(text: Column, pattern: str, group: int) -> Column:
    """A group as a double, NULL where the text does not match or the group is absent."""
    return F.regexp_extract(text, pattern, group).try_cast("double")


def inches(token: Column) -> Column:
    """A number, n/d, or a whole number and n/d; NULL for a zero denominator, and for a fraction beside a negative or decimal number."""
    mixed, bare = _whole("([0-9]+)\\s+([0-9]+)\\s*/\\s*([0-9]+)"), _whole("([0-9]+)\\s*/\\s*([0-9]+)")
    return F.coalesce(
        _get(token, mixed, 1) + _get(token, mixed, 2) / F.nullif(_get(token, mixed, 3), F.lit(0.0)),
        _get(token, bare, 1) / F.nullif(_get(token, bare, 2), F.lit(0.0)),
        _get(token, _whole(f"({NUMBER})"), 1),
    )


def length_m(text: Column) -> Column:
    """Feet and inches, inches, feet or millimetres, tried in that order, to metres; the first form that fits decides, also where it gives NULL."""
    both, inch = _whole(f"({NUMBER})\\s*ft\\s+({INCHES})\\s*in"), _whole(f"({INCHES})\\s*in")
    foot, mm = _whole(f"({NUMBER})\\s*ft"), _whole(f"({NUMBER})\\s*mm")
    return (
        F.when(text.rlike(both), _get(text, both, 1) * FOOT + inches(F.regexp_extract(text, both, 2)) * INCH)
        .when(text.rlike(inch), inches(F.regexp_extract(text, inch, 1)) * INCH)
        .otherwise(F.coalesce(_get(text, foot, 1) * FOOT, _get(text, mm, 1) * MILLIMETRE))
    )


def weight_kg(text: Column) -> Column:
    return _get(text, _whole(f"({PLAIN_NUMBER})\\s*lbm"), 1) * POUND


def pressure_kpa(text: Column) -> Column:
    return _get(text, _whole(f"({PLAIN_NUMBER})\\s*psi"), 1) * PSI


def temperature_c(text: Column) -> Column:
    """The unit letter is upper case only."""
    return (_get(text, _whole(f"({PLAIN_NUMBER})\\s*F", exact_case=True), 1) - 32) * 5 / 9


def npd_m(text: Column) -> Column:
    """struct(end1, end2) in metres: one size for both ends, or two of one unit, the second perhaps a bare 0."""
    out = None
    for unit, to_m in (("in", INCH), ("mm", MILLIMETRE)):
        one = _whole(f"({NUMBER})\\s*{unit}")
        two = _whole(f"({NUMBER})\\s*{unit}\\s*x\\s*({NUMBER})\\s*{unit}")
        zero = _whole(f"({NUMBER})\\s*{unit}\\s*x\\s*0")
        for pattern, second in ((two, 2), (zero, None), (one, 1)):
            end2 = F.lit(0.0) if second is None else _get(text, pattern, second) * to_m
            made = F.struct((_get(text, pattern, 1) * to_m).alias("end1"), end2.alias("end2"))
            out = F.when(text.rlike(pattern), made) if out is None else out.when(text.rlike(pattern), made)
    return out


def npd_inches(text: Column) -> Column:
    """The first size in inches; only the start of the text need match."""
    inch, mm = rf"(?iU)^\s*({NUMBER})\s*in", rf"(?iU)^\s*({NUMBER})\s*mm"
    return F.coalesce(_get(text, inch, 1), _get(text, mm, 1) / 25.4)
