"""Fill-in-the-middle: documents cut into prefix, middle and suffix at unit bounds, and put together in another order.

Units are relational. Each text is dealt once to the partition of its key; there its matches are exploded with their
ordinals, a window sums the unit lengths, the cut requests of the document (the ordinals of its two cuts) are joined to
the units, and their offsets are aggregated to one row a document, which substring then cuts by. Units, requests and
offsets stay in the partition of their text, so texts of the documents that are transformed are the only thing shuffled.
A window holds the units of one document, which is as much as one row held before.

Null texts are empty and plain. A null key counts as the empty string in the hash. Rows with equal key and text are
worked on once and returned as often as they came (copies are merged before the shuffle, so they make no hot
partition); rows with one key and different texts are separate documents. Texts that hold a marker stay plain, whatever
their hash says, so that every output can be taken apart again. Very long texts need a few times their own size in one
task. Columns other than key and text are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A unit is a word with the space before it, or space that no word follows; and the markers.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class Rates:
    """Of 100 documents how many are transformed, and of 100 of those how many have their suffix first."""

    transformed: int = 50
    suffix_first: int = 80
    seed: int = 42


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def planned(docs: DataFrame, key: str = "doc_id", text: str = "text", rates: Rates = Rates()) -> DataFrame:
    """(key, text, n, form, first_cut, last_cut): the form of each document and the ordinals of the units that its cuts follow."""
    d = docs.select(docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"))
    h1, h2, h3, h4 = draws(F.col("key"), rates.seed)
    d = d.select("key", "text", F.regexp_count("text", F.lit(UNIT)).cast("bigint").alias("n"), h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"))
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(m))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= rates.transformed)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < rates.suffix_first, "spm").otherwise("psm")
    one, other = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    return d.select("key", "text", "n", form.alias("form"), F.least(one, other).alias("first_cut"), F.greatest(one, other).alias("last_cut"))


def offsets(texts: DataFrame) -> DataFrame:
    """(a, b, row, copies, prefix_chars, middle_end) of texts (a, b, row, copies) dealt by a and b: where the cuts fall, in code points."""
    units = texts.select("a", "b", F.posexplode(F.regexp_extract_all("row.text", F.lit(UNIT), F.lit(0))).alias("place", "unit"))
    units = units.select("a", "b", (F.col("place") + 1).cast("bigint").alias("ordinal"), F.char_length("unit").cast("bigint").alias("chars"))
    upto = F.sum("chars").over(Window.partitionBy("a", "b").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0))
    ends = units.withColumn("end", upto).select(F.col("a").alias("a_"), F.col("b").alias("b_"), "ordinal", "end")
    asked = (F.col("ordinal") == F.col("row.first_cut")) | (F.col("ordinal") == F.col("row.last_cut"))
    # both sides lie by a and b already: a merge join adds no exchange, and no side is ever broadcast
    met = texts.join(ends.hint("merge"), (F.col("a") == F.col("a_")) & (F.col("b") == F.col("b_")) & asked, "left")

    def at(cut: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("ordinal") == F.col(f"row.{cut}"), F.col("end"))), F.lit(0)).cast("bigint")

    return met.groupBy("a", "b").agg(F.first("row").alias("row"), F.first("copies").alias("copies"), at("first_cut").alias("prefix_chars"), at("last_cut").alias("middle_end"))


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", rates: Rates = Rates()) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row: the document in its form; the two counts are NULL where it is plain."""
    every = planned(docs, key, text, rates)
    plain = every.where("form = 'plain'").select("key", "n", "form", *[F.lit(None).cast("bigint").alias(c) for c in ("prefix_chars", "middle_chars")], F.col("text").alias("output"))
    # 128 bits of hash name a row's key and text: copies are merged by it, and it deals the texts
    named = every.where("form <> 'plain'").withColumns({"a": F.xxhash64("key", "text"), "b": F.xxhash64(F.lit(1), "key", "text")})
    row = F.struct("key", "text", "n", "form", "first_cut", "last_cut")
    texts = named.groupBy("a", "b").agg(F.first(row).alias("row"), F.count("*").alias("copies"))
    # the condition, true of every row, keeps both columns in both uses of texts, so that they share one exchange
    found = offsets(texts.where("copies > 0 AND row IS NOT NULL")).select("row.*", "copies", "prefix_chars", (F.col("middle_end") - F.col("prefix_chars")).alias("middle_chars"))
    p, m = F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int")
    prefix, middle, suffix = F.substring("text", F.lit(1), p), F.substring("text", p + 1, m), F.substring("text", p + m + 1, F.char_length("text"))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    made = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    made = made.select("key", "n", "form", "prefix_chars", "middle_chars", F.when(F.col("form") == "psm", psm).otherwise(spm).alias("output"))
    return plain.unionByName(made).withColumnRenamed("key", key)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text, from an output and its form alone: no marker is in the text, and none can arise where parts meet."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(output, "<[PSM]>")
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)
