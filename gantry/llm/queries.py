"""The registered queries of this package, each over its whole table, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.llm import fim, importance, lm, media, neighbours, packing, pieces, quality, simhash, substring, token_files, url_filter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# 6: quality rules ------------------------------------------------------------------------------------------------


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(_table(spark, sf_dir, "documents")).drop("rejected_by")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM documents
), p AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS n FROM p
), r AS (
  SELECT doc_id, count(DISTINCT i + o.k) AS n FROM g, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY doc_id
), s AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclamations,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN r ON d.doc_id = r.doc_id
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
         OR 10 * n_dup_lines > 4 * n_lines OR 2 * n_exclamations > n_words) AS kept
FROM b
"""


# 8: URL filters --------------------------------------------------------------------------------------------------

RULES = [
    url_filter.Rule("block", "com", "/en/"),
    url_filter.Rule("allow", "example.com", "/en/7"),
    url_filter.Rule("allow", "net", "/de/"),
    url_filter.Rule("block", "example.net", "/de/8"),
    url_filter.Rule("block", "org", "/es/"),
]
#: Host labels whose urls make up the list.
LISTED_LABELS = ("ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets")
_LISTED = r"(^|\.)(" + "|".join(LISTED_LABELS) + r")\."


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    listed = pages.where(url_filter.host_of(pages["url"]).rlike(_LISTED)).select("url")
    return url_filter.filter_urls(pages, listed, RULES).drop("possible_hit", "listed")


_FITS = [(r, f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN ") for r in sorted(RULES, key=lambda r: -len(r.name))]
_OP8_NAME = " ".join(f"{when}'{r.name}'" for r, when in _FITS)
_OP8_VERDICT = " ".join(f"{when}'{r.verdict}'" for r, when in _FITS)

OP8_SQL = rf"""
WITH h AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), c AS (SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '(\.html)?/*$', '') AS canon FROM h),
listed AS (SELECT DISTINCT canon FROM c WHERE regexp_matches(host, '{_LISTED}') AND canon <> '')
SELECT page_id, host, path, CASE {_OP8_NAME} END AS rule,
       coalesce(CASE {_OP8_VERDICT} END, CASE WHEN listed.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN listed ON c.canon = listed.canon
"""


QUERIES = {"op6_quality": op6_quality, "op8_url_filter": op8_url_filter}
ORACLES = {"op6_quality": OP6_SQL, "op8_url_filter": OP8_SQL}


# 2: SimHash near-duplicates --------------------------------------------------------------------------------------


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


QUERIES["op2_simhash"] = op2_simhash


# 10: best-fit packing --------------------------------------------------------------------------------------------

def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES["op10_packing"] = op10_packing


# 9: substring dedup ----------------------------------------------------------------------------------------------


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its repeated passages cut, and what was cut."""
    return substring.dedupe(_table(spark, sf_dir, "documents"), report=True)


QUERIES["op9_substring_dedup"] = op9_substring_dedup


# 7: WARC ---------------------------------------------------------------------------------------------------------


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


OP7_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS digest FROM p),
r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) END AS keeper FROM q)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM r
"""

QUERIES["op7_warc"] = op7_warc
ORACLES["op7_warc"] = OP7_SQL


# 5: media columns ------------------------------------------------------------------------------------------------


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media.media_columns(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "format", "width", "height", "bit_depth")


QUERIES["op5_media"] = op5_media


# 1: LM scoring ---------------------------------------------------------------------------------------------------


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


QUERIES["op1_lm_scoring"] = op1_lm_scoring


# 3: SentencePiece ------------------------------------------------------------------------------------------------


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ids=False)


QUERIES["op3_sentencepiece"] = op3_sentencepiece


# 4: token counts -------------------------------------------------------------------------------------------------


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.counted(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES["op4_token_counts"] = op4_token_counts


# 11: fill-in-middle ----------------------------------------------------------------------------------------------


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(_table(spark, sf_dir, "documents"))
    digests = [F.sha2(c.cast("binary"), 256).alias(name) for c, name in ((F.col("output"), "output_sha256"), (fim.restored(), "restored_sha256"))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id::VARCHAR) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), k AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
), c AS (
  SELECT doc_id, t, u, n, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM k
), o AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:lo], '') AS p, array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:], '') AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM o
"""

QUERIES["op11_fill_in_middle"] = op11_fill_in_middle
ORACLES["op11_fill_in_middle"] = OP11_SQL


# 12: target-distribution importance resampling -------------------------------------------------------------------


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES["op12_importance"] = op12_importance


# 13: embedding near-duplicates -----------------------------------------------------------------------------------


def op13_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(_table(spark, sf_dir, "embeddings"))


QUERIES["op13_embeddings"] = op13_embeddings
