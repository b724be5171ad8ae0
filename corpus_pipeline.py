"""The corpus pipeline: quality rules, line dedup, n-gram near-duplicates, privacy, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that the
stage before it kept; ``run`` writes each result to the shared checkpoint folder
and reads it again for the next stage.  All stages but the last return the
columns of ``documents``; ``n_chars`` follows a changed text.

The last stage returns the packed pieces.  Cutting and packing by token ids has
no SQL form, so ``ORACLE_SQL`` is None; the tests hold ``run`` against a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import line_dedup, ngram_join, packing, pii, quality_rules
from tessera.llm.common import stage, table, tokenizer_file

ORACLE_SQL = None


def _recount(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; copies count once, so that they keep their text."""
    return _recount(line_dedup.drop_boilerplate(docs, F.col("source")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that 5-word shingles link at a similarity of 0.8."""
    return ngram_join.keep_one_of_each(docs, width=16)  # 1024 bits: less memory for a row than op10's 2048


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data and secrets."""
    return _recount(pii.replace_entities(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens, with their token ids."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard", near_duplicates),
    ("pii", privacy),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"stage-{name}")
    return docs
