"""The ``opN_`` queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_views, decontaminate, line_dedup, merkle, ngram_join, packing, piece_codec, pii, prefix_trie, quality_model, quality_rules, toxicity, vector_dedup
from .common import table, tokenizer_file


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents, checked against the library."""
    return piece_codec.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"),
                                        with_ids=False, digests=True)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors among all embeddings."""
    return vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data and secrets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, count_col="n_replaced")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by a lexicon learned from ``labels``."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.learn_lexicon(docs, table(spark, sf_dir, "labels")))


def op5_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                                  with_ids=False)


def op6_chat_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's side; masks as text ``start-stop,...``."""
    views = chat_views.perspective_views(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("masks", lambda m: F.concat_ws("-", m["start"], m["stop"])), ",")
    return views.withColumn("masks", spans)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of all documents."""
    return quality_rules.quality_counts(table(spark, sf_dir, "documents"))


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by a classifier learned from ``labels``."""
    docs = table(spark, sf_dir, "documents")
    return quality_model.score_documents(docs, quality_model.train_model(docs, table(spark, sf_dir, "labels")))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their source's boilerplate lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, F.col("source"), dropped_col="n_dropped")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 3-word shingles and a similarity of 0.9."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of all documents by source, a fifth of them tampered with."""
    return merkle.document_manifest(table(spark, sf_dir, "documents")).drop("source")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt with shared heads."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of the benchmark in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("hits.n_hit") > 0).alias("contaminated"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_sentencepiece, op2_embedding_dedup, op3_pii_surrogates, op4_toxicity, op5_bestfit_packing,
           op6_chat_views, op7_quality_rules, op8_quality_model, op9_line_dedup, op10_ngram_jaccard, op11_merkle_manifest,
           op12_prefix_trie, op13_decontamination)
    return {f.__name__: f for f in own}
