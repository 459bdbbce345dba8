"""URL filters: host-and-path rules, then a blocked Bloom filter with an exact join behind it. Native throughout.

Nulls: a null url, or one without ``://``, has empty host and path, fits no rule and is allowed. Repeated rows are
judged each; an empty table gives an empty result; other columns are ignored, whatever their names. Of rules of one
length that both fit, the first by name wins. A url of any length is one row's strings.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import ascii_lower, durable

#: Lanes of 64 bits in a block; every key sets two bits in each.
LANES = 4
#: Keys a block is sized for, and the most blocks: the broadcast side has at most that many rows of 40 bytes.
KEYS_PER_BLOCK, MOST_BLOCKS = 16, 1 << 20


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, with A-Z lowered."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www., path without .html and closing slashes; scheme, query and fragment go."""
    path = F.regexp_replace(path_of(url), r"(\.html)?/*$", "")
    return F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), path)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct(rule, verdict), or null. A rule fits its host and every subdomain."""
    best = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        made = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        best = F.when(fits, made) if best is None else best.when(fits, made)
    return best if best is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """Two bits a lane from one further hash."""
    h = F.xxhash64(F.lit(7), key)

    def bit(i: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))

    return [bit(2 * k).bitwiseOR(bit(2 * k + 1)) for k in range(LANES)]


def bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row for each block that has bits: (block, lane0..lane3). At most `blocks` rows, whatever the list's length."""
    return (
        listed.select(_block(F.col(key), blocks).alias("block"), *[m.alias(f"lane{k}") for k, m in enumerate(_masks(F.col(key)))])
        .groupBy("block")
        .agg(*[F.bit_or(f"lane{k}").alias(f"lane{k}") for k in range(LANES)])
    )


def blocks_for(keys: int) -> int:
    """A power of two with about KEYS_PER_BLOCK keys a block, MOST_BLOCKS (40 MB) at most; past that more hits are false, none is lost."""
    n = 64
    while n * KEYS_PER_BLOCK < keys and n < MOST_BLOCKS:
        n *= 2
    return n


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", listed_url: str = "url", blocks: int | None = None) -> DataFrame:
    """(key, host, path, rule, verdict, possible_hit, listed) for each row of pages.

    The filter is sized by the list's count unless `blocks` is given. Only rows that it lets through, and that no rule decides, reach the exact join; it is a sort-merge
    or hash join on the canonical url that adaptive execution splits where one url holds many rows.
    """
    names = durable(listed.select(canonical(listed[listed_url]).alias("canon")).where("canon <> ''").distinct(), "listed-urls")
    blocks = blocks or blocks_for(names.count())
    seen = pages.select(pages[key].alias("key"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"), canonical(pages[url]).alias("canon"))
    seen = seen.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)).withColumn("block", _block(F.col("canon"), blocks))
    probed = seen.join(F.broadcast(bloom(names, "canon", blocks)), "block", "left")
    inside = reduce(Column.__and__, [F.col(f"lane{k}").bitwiseAND(m) == m for k, m in enumerate(_masks(F.col("canon")))])
    probed = probed.withColumn("possible_hit", F.coalesce(inside, F.lit(False)) & F.col("fit").isNull())
    probed = durable(probed.select("key", "host", "path", "canon", "fit", "possible_hit"), "probed-urls")  # read twice, made once

    def out(df: DataFrame, is_listed: Column) -> DataFrame:
        verdict = F.coalesce(F.col("fit.verdict"), F.when(is_listed, "block").otherwise("allow"))
        return df.select(F.col("key").alias(key), "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "possible_hit", is_listed.alias("listed"))

    passed = out(probed.where(~F.col("possible_hit")), F.lit(False))
    checked = probed.where("possible_hit").join(names.withColumn("found", F.lit(True)).withColumnRenamed("canon", "listed_canon"), F.col("canon") == F.col("listed_canon"), "left")
    return passed.unionByName(out(checked, F.coalesce("found", F.lit(False))))
