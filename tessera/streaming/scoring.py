"""Scoring new documents against a stored vocabulary (V9/V10) as a stream.

The reference can transform new texts with a given vocabulary; here that runs
as a stateless Structured Streaming job: each micro-batch of new documents is
normalized like the corpus, and counted, looked up in the stored vocabulary
(``term_id``, ``idf``) and normalized in its row.  The batch operators run inside ``foreachBatch``; each batch is written to its own
folder (overwrite), so a replayed batch after a failure gives the same files.
No state is kept between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import CleanConfig, VectorizeConfig
from ..operators import clean as C
from ..operators import vectorize as V
from ..session import scratch_path


def score_batch(batch: DataFrame, vocab: V.Vocabulary, cfg: VectorizeConfig,
                id_col: str = "doc_id", text_col: str = "text", clean: bool = True,
                method: str = "tfidf") -> DataFrame:
    """One batch: ``(doc_id, term_id, term, value)`` against a fixed vocabulary."""
    docs = batch.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    if clean:
        docs = C.cleaned_documents(docs, CleanConfig(text_col="_t")).withColumnRenamed(C.CLEAN, "_t")
    terms = V.doc_terms(docs, "_t", cfg, V.BOW_PATTERN)
    return (V.vectorize_counts(terms, vocab) if method == "bow" else V.vectorize_weights(terms, vocab, cfg)).matrix


def start_scoring(spark: SparkSession, source_dir: str, schema, vocab: V.Vocabulary,
                  cfg: VectorizeConfig, sink_dir: str, id_col: str = "doc_id",
                  text_col: str = "text", method: str = "tfidf",
                  checkpoint_location: str | None = None,
                  available_now: bool = True) -> StreamingQuery:
    """Start the scoring stream over Parquet files arriving in ``source_dir``."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    table = vocab.table.select("term_id", "term", "idf").checkpoint(eager=True)
    fixed = vocab.with_table(table)

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = score_batch(batch, fixed, cfg, id_col, text_col, method=method)
        scored.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch={batch_id}")

    writer = (stream.writeStream.foreachBatch(write)
              .option("checkpointLocation", checkpoint_location or scratch_path(spark, "stream-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
