"""Quality rules as a short-circuit cascade over native text statistics.

Rules are looked at in the order of rejection per cost, both estimated on a bounded sample. A statistic is computed
inside ``CASE WHEN no rule has rejected yet``, just before the first rule that reads it: a row that one rule rejects
has null for all that later rules would need, and costs nothing there. ``measure`` computes those statistics that its
result names for every row, and guards the others. The order changes the work and the name in ``rejected_by``, never
``kept``. The same table gives the same order: the sample is drawn by a hash of whole rows and cost is counted.

A null text counts as empty and fails; ties and repeated rows are judged each; an empty table gives an empty result;
other columns are ignored or, in ``keep``, passed through untouched. A text is worked on in its own row, whatever its
length: it needs some 30 bytes of memory for each word.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import SPACES, durable

#: Most rows that the order of the rules is estimated on.
SAMPLE_ROWS = 512
#: Nanoseconds that a statistic takes for each character and each word of a text, measured once on one core.
COSTS = {"q_words": (16, 0), "q_lines": (2, 0), "n_words": (0, 0), "word_chars": (7, 0), "n_symbols": (10, 0), "n_exclamations": (9, 0), "n_lines": (0, 0), "n_dup_lines": (1, 0), "n_repeat_words": (0, 490)}
#: Brings equal 3-word windows together; those that meet are compared by their words.
WINDOW_HASH = "xxhash64(q_words[i], q_words[i + 1], q_words[i + 2])"
#: What a statistic is computed from, besides the text.
NEEDS = {"n_words": ("q_words",), "word_chars": ("q_words",), "n_repeat_words": ("q_words", "n_words"), "n_lines": ("q_lines",), "n_dup_lines": ("q_lines",)}
#: The statistics of the result, computed for every row.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityRule:
    """Rejects where `when` (SQL over the statistics) is true; `needs` are the statistics it reads."""

    name: str
    when: str
    needs: tuple[str, ...]


RULES = (
    QualityRule("few_words", "n_words < 50", ("n_words",)),
    QualityRule("repeated_words", "100 * n_repeat_words > 50 * n_words", ("n_words", "n_repeat_words")),
    QualityRule("symbols", "10 * n_symbols > n_words", ("n_words", "n_symbols")),
    QualityRule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words", ("n_words", "word_chars")),
    QualityRule("repeated_lines", "10 * n_dup_lines > 4 * n_lines", ("n_lines", "n_dup_lines")),
    QualityRule("exclamations", "2 * n_exclamations > n_words", ("n_words", "n_exclamations")),
)

def _removed(pattern: str) -> Column:
    return (F.length("q_text") - F.length(F.regexp_replace("q_text", pattern, ""))).cast("long")


def _statistic(name: str) -> Column:
    """A statistic as it is computed from q_text and what NEEDS names."""
    match name:
        case "q_words":
            return F.array_remove(F.split("q_text", SPACES), "")
        case "q_lines":
            return F.filter(F.split("q_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        case "n_words":
            return F.size("q_words").cast("long")
        case "word_chars":
            return F.length(F.array_join("q_words", "")).cast("long")
        case "n_symbols":
            return _removed("[#*$%&|<>]")
        case "n_exclamations":
            return _removed("!")
        case "n_lines":
            return F.size("q_lines").cast("long")
        case "n_dup_lines":
            return (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long")
    raise ValueError(f"no statistic {name}")


def _guarded(alive: Column | None, c: Column) -> Column:
    return c if alive is None else F.when(alive, c)


def _repeats(df: DataFrame, alive: Column | None) -> DataFrame:
    """Adds n_repeat_words: positions covered by 3-word windows that occur twice or more.

    Windows are sorted by hash, with their position in the low bits, and neighbours compared; those whose hashes meet
    are sorted again by their words, so the count is exact. Positions found are sorted back; each covers three words
    less its overlap with the next. No explode and no shuffle: a text is worked on in its own row.
    """
    steps = {
        "q_shift": "cast(ceil(log2(n_words)) AS INT)",
        "q_sorted": f"CASE WHEN n_words >= 4 THEN sort_array(transform(sequence(0, n_words - 3), i -> shiftleft(shiftrightunsigned({WINDOW_HASH}, q_shift), q_shift) | i)) END",
        "q_met": """transform(filter(q_sorted, (x, k) -> shiftrightunsigned(x, q_shift) = shiftrightunsigned(get(q_sorted, k - 1), q_shift)
                              OR shiftrightunsigned(x, q_shift) = shiftrightunsigned(get(q_sorted, k + 1), q_shift)), x -> x & (shiftleft(1L, q_shift) - 1))""",
        "q_named": "CASE WHEN size(q_met) > 0 THEN sort_array(transform(q_met, i -> named_struct('w', concat_ws(' ', q_words[i], q_words[i + 1], q_words[i + 2]), 'i', i))) END",
        "q_at": "sort_array(transform(filter(q_named, (x, k) -> x.w = get(q_named, k - 1).w OR x.w = get(q_named, k + 1).w), x -> x.i))",
        "n_repeat_words": """CASE WHEN size(q_at) > 0 THEN aggregate(zip_with(q_at, slice(q_at, 2, greatest(size(q_at), 1)), (a, b) -> least(3L, coalesce(b - a, 3L))), 0L, (s, x) -> s + x)
                             ELSE 0L END""",
    }
    for name, sql in steps.items():
        df = df.withColumn(name, _guarded(alive, F.expr(sql)))
    return df.drop(*list(steps)[:-1])


def _with_needs(names: Iterable[str]) -> list[str]:
    """The names, each behind all that it is computed from."""
    out: list[str] = []
    for n in names:
        out += [x for x in (*_with_needs(NEEDS.get(n, ())), n) if x not in out]
    return out


def statistics(df: DataFrame, names: Iterable[str], alive: Column | None = None) -> DataFrame:
    """Adds the named statistics, and what they need, to a frame that has q_text; null where `alive` is false."""
    for n in _with_needs(names):
        if n not in df.columns:
            df = _repeats(df, alive) if n == "n_repeat_words" else df.withColumn(n, _guarded(alive, _statistic(n)))
    return df


def cascade(df: DataFrame, rules: tuple[QualityRule, ...], always: Iterable[str] = ()) -> DataFrame:
    """Adds q_rejected, the first rule that rejects or null, to a frame that has q_text; statistics come before the rule that first reads them.

    Those in `always` are computed for every row, all others only where no earlier rule has rejected.
    """
    df = statistics(df, always).withColumn("q_rejected", F.lit(None).cast("string"))
    for k, r in enumerate(rules):
        df = statistics(df, r.needs, F.col("q_rejected").isNull() if k else None)
        hit = F.when(F.expr(r.when), r.name)
        df = df.withColumn("q_rejected", F.coalesce("q_rejected", hit) if k else hit)
    return df


def _barrier() -> Column:
    """A random number that a filter looks at, and with it all later filters, stays above the statistics.

    Pushed below them, a filter would compute them anew for each of its uses.
    """
    return F.rand(0).alias("q_barrier")


def sample_of(docs: DataFrame, text: str, rows: int) -> DataFrame:
    """Column q_text of `rows` rows with the least hashes of all their columns (but maps), whatever their order.

    A threshold on the hash, from the count of rows, leaves some four times as many to be sorted.
    """
    total = docs.count()
    hashed = docs.select(F.xxhash64(*[docs[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString()]).alias("q_hash"), F.coalesce(docs[text], F.lit("")).alias("q_text"))
    if total > 4 * rows:
        hashed = hashed.where(F.col("q_hash") <= -(1 << 63) + int((1 << 64) * (4 * rows / total)))
    return durable(hashed.orderBy("q_hash", "q_text").limit(rows).select("q_text"), "quality-sample")


def order_rules(docs: DataFrame, text: str, rules: tuple[QualityRule, ...] = RULES, rows: int = SAMPLE_ROWS) -> tuple[QualityRule, ...]:
    """Rules by rejection per cost on a sample of at most `rows` rows.

    The next rule is always that which rejects most of the rows left for what its statistics cost on them, as COSTS
    counts it; statistics that an earlier rule has computed are free.
    """
    counted = statistics(sample_of(docs, text, rows), {n for r in rules for n in r.needs} | {"n_words"})
    hits = [F.coalesce(F.expr(r.when), F.lit(False)).alias(f"hit{k}") for k, r in enumerate(rules)]
    left = [(r["chars"], r["n_words"], r[2:]) for r in counted.select(F.length("q_text").alias("chars"), "n_words", *hits).collect()]
    order: list[int] = []
    known: set[str] = set()
    while len(order) < len(rules):

        def merit(k: int) -> tuple[float, str]:
            new = [COSTS.get(n, (10, 0)) for n in _with_needs(rules[k].needs) if n not in known]
            cost = sum(a * chars + b * words for a, b in new for chars, words, _ in left)
            return -(sum(hit[k] for *_, hit in left) + 0.5) / (cost + len(left) + 1), rules[k].name

        best = min((k for k in range(len(rules)) if k not in order), key=merit)
        order.append(best)
        known.update(_with_needs(rules[best].needs))
        left = [x for x in left if not x[2][best]]
    return tuple(rules[k] for k in order)


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[QualityRule, ...] | None = None) -> DataFrame:
    """(key, the statistics, base_failed, kept, rejected_by) for each row."""
    rules = order_rules(docs, text) if rules is None else rules
    df = cascade(docs.select(docs[key].alias("q_key"), F.coalesce(docs[text], F.lit("")).alias("q_text")), rules, REPORTED)
    df = df.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
    kept = ~F.col("base_failed") & F.col("q_rejected").isNull()
    out = df.select(F.col("q_key").alias(key), *REPORTED, "base_failed", kept.alias("kept"), F.col("q_rejected").alias("rejected_by"), _barrier())
    return out.where("q_barrier >= 0").drop("q_barrier")


def keep(docs: DataFrame, text: str = "text", rules: tuple[QualityRule, ...] | None = None) -> DataFrame:
    """The rows that no rule rejects, with all their columns. Columns are packed away meanwhile, so that no name clashes."""
    rules = order_rules(docs, text) if rules is None else rules
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("q_row"), F.coalesce(docs[text], F.lit("")).alias("q_text"))
    judged = cascade(packed, rules).select("q_row", "q_rejected", _barrier())
    return judged.where("q_rejected IS NULL AND q_barrier >= 0").select("q_row.*")
