"""The corpus pipeline: quality rules, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; run() writes each stage's rows
to the shared folder and reads them again. All but the last return the columns of documents, and pass other columns
through whatever their names. An empty table gives an empty result in each stage, and no text is too long for one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.llm import common, packing, quality, simhash, substring

#: Words in a shingle of the near-duplicate stage, and the least similarity of near-duplicates.
SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: The vocabulary file of the stage packed.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. Null and empty texts have no words and go; repeated rows are judged, and stay, each."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least doc_id; of rows with one doc_id, one.

    Null and empty texts are alike and form one group. Rows without a doc_id stay.
    """
    return simhash.keep_one(docs, simhash.near_copies(docs, width=SHINGLE_WORDS, similarity=SIMILARITY))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a lesser document has are cut; n_chars follows the text, and texts with no word left go.

    Null and empty texts go with those. Of rows with equal doc_id and text one keeps its text. Rows without a doc_id come last.
    """
    cut = substring.dedupe(docs).withColumn("n_chars", F.length("text").cast("bigint"))
    return cut.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece: its place in a sequence. Null and empty texts are one token, repeated rows are packed each.

    Small batches, as the executors still hold what earlier stages used.
    """
    return packing.pack(docs, TOKENIZER, text_bytes=2 << 20, cached=150_000)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("packed", packed)]

#: SQL can express neither the fingerprints' XXH64 nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
