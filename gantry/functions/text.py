"""Names, labels, classes and material grades, as Column expressions (and plain functions for column names)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Source headers that have names of their own.
HEADERS = {"Class": "class_raw", "ObjectId(GUID)": "object_id", "DisplayName": "display_name", "System Path": "system_path", "Level": "level"}


def snake_case(name: str) -> str:
    """Words (by case and by anything but letters and digits of any script) in lower case, one _ between two."""
    name = re.sub(r"[\W_]+", "_", name)
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    return name.strip("_").lower()


def snake_case_column(c: Column) -> Column:
    """snake_case of each value."""
    c = F.regexp_replace(c, r"(?U)[\W_]+", "_")
    c = F.regexp_replace(c, "(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_")
    return F.lower(F.regexp_replace(c, "^_|_$", ""))


def header(name: str, names: dict[str, str] | None = None) -> str:
    """A column's name: a given one; sp3d_ and the property of the modelling tool; category and property; or snake case."""
    names = HEADERS if names is None else names
    if name in names:
        return names[name]
    category, bar, own = name.partition("|")
    if not bar:
        return snake_case(name)
    return ("sp3d" if category == "SmartPlant 3D" else snake_case(category)) + "_" + snake_case(own)


def header_column(c: Column, names: dict[str, str] | None = None) -> Column:
    """header of each value."""
    names = HEADERS if names is None else names
    out = None
    for k, v in names.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    category = F.substring_index(c, "|", 1)
    prefix = F.when(category == "SmartPlant 3D", "sp3d").otherwise(snake_case_column(category))
    made = F.when(c.contains("|"), F.concat(prefix, F.lit("_"), snake_case_column(after_bar(c)))).otherwise(snake_case_column(c))
    return made if out is None else out.otherwise(made)


def rename_all(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Every column by the given name or by header's rules; two columns of one new name raise."""
    new = {c: (names or {}).get(c) or header(c) for c in df.columns}
    if len(set(new.values())) < len(df.columns):
        raise ValueError(f"columns collide: {sorted(n for n in new.values() if list(new.values()).count(n) > 1)}")
    return df.withColumnsRenamed(new)


def clean_prefix(c: Column, prefix: str = "displaystring") -> Column:
    """Without the prefix and a colon, in any case, then trimmed; text without it stays; NULL gives ''."""
    pattern = rf"(?i)^{prefix}:\s*"
    return F.coalesce(F.when(c.rlike(pattern), F.trim(F.regexp_replace(c, pattern, ""))).otherwise(c), F.lit(""))


def after_bar(c: Column) -> Column:
    """What follows the first |, or all."""
    return F.regexp_replace(c, r"^[^|]*\|", "")


def title_or_id(name: Column, key: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(name), F.lit("")), key)


def uri_safe(c: Column) -> Column:
    """A local name of an address: letters, digits, - and single _; unknown if nothing is left."""
    out = F.regexp_replace(F.regexp_replace(F.trim(c), r"[^A-Za-z0-9_-]", "_"), "_+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(out, "^_+|_+$", ""), F.lit("")), F.lit("unknown"))


def first_rule(c: Column, rules: Iterable[tuple[str, str]], default: str) -> Column:
    """The label of the first pattern that the text matches, in order."""
    out = None
    for pattern, label in rules:
        out = F.when(c.rlike(pattern), label) if out is None else out.when(c.rlike(pattern), label)
    return F.lit(default) if out is None else out.otherwise(default)


def astm_grade(c: Column) -> Column:
    """A number and grade from ASTM-Axxx-yyy, in upper case, or NULL."""
    pattern = r"(?i)ASTM-(A\d+)-?([A-Z0-9]+)?"
    joined = F.concat_ws("-", F.upper(F.regexp_extract(c, pattern, 1)), F.nullif(F.upper(F.regexp_extract(c, pattern, 2)), F.lit("")))
    return F.when(c.rlike(pattern), joined)


def tokens(c: Column) -> Column:
    """Distinct lower-case runs of letters, digits and _ ; for the token index."""
    return F.array_distinct(F.array_remove(F.split(F.lower(c), r"[^a-z0-9_]+"), ""))
