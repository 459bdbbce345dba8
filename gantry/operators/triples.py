"""Triples (s, p, o, o_kind, o_type): building, class closure, basic graph patterns, shape checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.operators.durable import cut
from gantry.operators.graph import closure

#: Literal types by Spark type.
XSD = {"string": "xsd:string", "bigint": "xsd:integer", "int": "xsd:integer", "double": "xsd:double", "boolean": "xsd:boolean"}


def literals(df: DataFrame, subject: Column, columns: dict[str, str]) -> DataFrame:
    """A triple for each column (name -> predicate) that is neither NULL nor blank text; one pass, no union."""
    kinds = dict(df.dtypes)
    rows = [F.struct(F.lit(p).alias("p"), F.col(c).cast("string").alias("o"), F.lit("literal").alias("o_kind"), F.lit(XSD[kinds[c]]).alias("o_type")) for c, p in columns.items()]
    made = df.select(subject.alias("s"), F.inline(F.array(*rows)))
    return made.where("o IS NOT NULL AND trim(o) <> ''")


def links(df: DataFrame, subject: Column, predicate: str, target: Column) -> DataFrame:
    made = df.select(subject.alias("s"), F.lit(predicate).alias("p"), target.alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_type"))
    return made.where("o IS NOT NULL")


def subclasses(triples: DataFrame) -> DataFrame:
    """(node, ancestor) over rdfs:subClassOf, every class being its own ancestor too."""
    direct = triples.where("p = 'rdfs:subClassOf'").select("s", "o")
    own = direct.select(F.explode(F.array("s", "o")).alias("node")).distinct().select("node", F.col("node").alias("ancestor"))
    return closure(direct, "s", "o").select("node", "ancestor").unionByName(own).distinct()


def match(triples: DataFrame, patterns: list[tuple[str, str, str]], not_exists: list[tuple[str, str, str]] = ()) -> DataFrame:
    """Solutions of a basic graph pattern: terms that begin with ? are variables; `subClassOf*` as a predicate is the closure.

    Patterns join on the variables they share, in order; a pattern that shares none raises, as it would be a cross join.
    Each pattern of not_exists takes out solutions that it fits.
    """

    def scan(pattern: tuple[str, str, str]) -> DataFrame:
        if pattern[1] == "subClassOf*":
            rows, names = subclasses(triples).select(F.col("node").alias("s"), F.col("ancestor").alias("o")), ("s", "o")
            terms = (pattern[0], pattern[2])
        else:
            rows, names, terms = triples.select("s", "p", "o"), ("s", "p", "o"), pattern
        for name, term in zip(names, terms, strict=True):
            if not term.startswith("?"):
                rows = rows.where(F.col(name) == term)
        seen: dict[str, str] = {}
        for name, term in zip(names, terms, strict=True):
            if term.startswith("?"):
                if term in seen:
                    rows = rows.where(F.col(name) == F.col(seen[term]))
                else:
                    seen[term] = name
        return rows.select(*[F.col(n).alias(t[1:]) for t, n in seen.items()])

    out = scan(patterns[0])
    for p in patterns[1:]:
        new = scan(p)
        shared = [c for c in new.columns if c in out.columns]
        if not shared:
            raise ValueError(f"pattern {p} shares no variable with those before it")
        out = out.join(new, shared)
    for p in not_exists:
        new = scan(p)
        out = out.join(new, [c for c in new.columns if c in out.columns], "left_anti")
    return out.distinct()


@dataclass(frozen=True)
class Shape:
    """A check of all nodes of a class (or a subclass): `path` must occur (min_count), equal `value`, be >= `least`, or have `datatype`."""

    name: str
    target: str
    path: str
    min_count: int = 0
    value: str | None = None
    least: float | None = None
    datatype: str | None = None


def targets(triples: DataFrame, cls: str, tree: DataFrame) -> DataFrame:
    """Nodes of a class or of one below it; tree is subclasses(triples)."""
    typed = triples.where("p = 'rdf:type'").select(F.col("s").alias("node"), F.col("o").alias("cls"))
    return typed.join(tree.where(F.col("ancestor") == cls).select(F.col("node").alias("cls")), "cls").select("node").distinct()


def violations(triples: DataFrame, shapes: list[Shape]) -> DataFrame:
    """(shape, node, value, severity): one row for each result."""
    out, tree = None, cut(subclasses(triples))
    for s in shapes:
        nodes = targets(triples, s.target, tree)
        values = nodes.join(triples.where(F.col("p") == s.path).select(F.col("s").alias("node"), "o", "o_type"), "node")
        found = []
        if s.min_count:
            n = nodes.join(values.groupBy("node").agg(F.count("*").alias("n")), "node", "left")
            found.append(n.where(F.coalesce("n", F.lit(0)) < s.min_count).select("node", F.lit(None).cast("string").alias("value")))
        if s.value is not None:
            found.append(nodes.join(values.where(F.col("o") == s.value), "node", "left_anti").select("node", F.lit(None).cast("string").alias("value")))
        if s.least is not None:
            number = F.col("o").try_cast("double")
            found.append(values.where(number.isNull() | (number < s.least)).select("node", F.col("o").alias("value")))
        if s.datatype is not None:
            found.append(values.where(~F.col("o_type").eqNullSafe(F.lit(s.datatype))).select("node", F.col("o").alias("value")))
        for f in found:
            f = f.select(F.lit(s.name).alias("shape"), "node", "value", F.lit("Violation").alias("severity"))
            out = f if out is None else out.unionByName(f)
    return out


def report(found: DataFrame) -> DataFrame:
    """(shape, severity, n) of the results; empty if all conforms."""
    return found.groupBy("shape", "severity").agg(F.count("*").alias("n"))


def n_triples(triples: DataFrame, base: str = "urn:asset:") -> DataFrame:
    """Lines of N-Triples, a subset of Turtle; write them with .write.text. Backslashes, quotes and line ends in literals are escaped."""
    iri = lambda c: F.concat(F.lit(f"<{base}"), c, F.lit(">"))
    escaped = F.regexp_replace("o", r'([\\"])', r"\\$1")
    for plain, letter in (("\n", "n"), ("\r", "r")):
        escaped = F.replace(escaped, F.lit(plain), F.lit("\\" + letter))
    literal = F.concat(F.lit('"'), escaped, F.lit('"^^'), iri(F.col("o_type")))
    return triples.select(F.concat(iri(F.col("s")), F.lit(" "), iri(F.col("p")), F.lit(" "), F.when(F.col("o_kind") == "iri", iri(F.col("o"))).otherwise(literal), F.lit(" .")).alias("value"))


def _unescaped(text: Column) -> Column:
    """Escapes resolved in one pass from the left, so that an escaped backslash is never the start of another escape."""
    marks = F.regexp_extract_all(text, F.lit(r"\\.|[^\\]+"), F.lit(0))
    back = F.lit("\\")
    one = lambda x: F.when(x == "\\n", "\n").when(x == "\\r", "\r").when(x == "\\t", "\t").when(F.startswith(x, back), F.substring(x, 2, 1)).otherwise(x)
    return F.array_join(F.transform(marks, one), "")


def read_n_triples(lines: DataFrame, base: str = "urn:asset:") -> DataFrame:
    """Triples of lines (column value) as n_triples writes them; several files are one set. Empty lines and comments are passed over.

    A line of any other form raises with its text when it is read: no triple is dropped.
    """
    pattern = rf'^<{base}([^>]*)> <{base}([^>]*)> (?:<{base}([^>]*)>|"((?:[^"\\]|\\.)*)"\^\^<{base}([^>]*)>) \.$'
    part = lambda i: F.regexp_extract("value", pattern, i)
    is_iri = F.col("value").rlike(r"^<[^>]*> <[^>]*> <[^>]*> \.$")
    known = F.when(F.col("value").rlike(pattern), F.when(is_iri, "iri").otherwise("literal")).otherwise(F.raise_error(F.concat(F.lit("this is no triple: "), F.col("value"))))
    rows = lines.where(~F.col("value").rlike(r"^\s*(#.*)?$"))
    made = rows.select(part(1).alias("s"), part(2).alias("p"), F.when(is_iri, part(3)).otherwise(_unescaped(part(4))).alias("o"), known.alias("o_kind"), F.when(~is_iri, part(5)).alias("o_type"))
    return made.dropDuplicates()
