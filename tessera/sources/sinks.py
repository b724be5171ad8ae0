"""Report sinks (S6..S14).  Every writer is a Spark write to the output
folder; the JSON metadata is one row built by an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import topics as TP
from ..operators import vectorize as V
from ..operators.vectorize import Vectorized


def _path(outdir: str, name: str) -> str:
    return f"{outdir.rstrip('/')}/{name}"


def save_normalized(df: DataFrame, outdir: str, name: str = "normalized_texts") -> str:
    """The normalized corpus (without the temporary column)."""
    path = _path(outdir, name)
    df.drop("_normalized").write.mode("overwrite").parquet(path)
    return path


# --- fixed values: token patterns as the metadata spells them -----------------
BOW_SOURCE = r"(?u)\b[a-z]{2,}\b"
WORD_SOURCE = r"(?u)\b\w\w+\b"
# --- end of fixed values --------------------------------------------------------


def _typed(value):
    """A literal of the value's own type: numbers, booleans and lists stay such."""
    if value is None:
        return F.lit(None).cast("string")
    return F.array(*[F.lit(x) for x in value]) if isinstance(value, list) else F.lit(value)


def vectorization_meta(v: Vectorized) -> DataFrame:
    """S9 as a one-row DataFrame (the stamp is added at write time)."""
    params = {k: val for k, val in v.vocab.params.items()
              if v.method == "tfidf" or k not in V.TFIDF_PARAMS}
    params |= {"token_pattern": BOW_SOURCE if v.method == "bow" else WORD_SOURCE,
               "dtype": "int64" if v.method == "bow" else "float32"}
    nnz = v.matrix.agg(F.count(F.lit(1)).alias("nnz"))
    return nnz.select(
        F.lit(v.method).alias("method"),
        F.array(F.lit(v.n_docs).cast("long"), F.lit(v.vocab.size).cast("long")).alias("shape"),
        F.col("nnz").cast("long").alias("nnz"),
        F.lit(v.vocab.size).cast("long").alias("n_features"),
        F.lit(v.vectorizer_type).alias("vectorizer_type"),
        F.struct(*[_typed(val).alias(k) for k, val in sorted(params.items())])
        .alias("vectorizer_params"))


def save_vectorization(v: Vectorized, outdir: str, stamp: str) -> dict:
    """S7 (COO matrix, float32 values), S8 (feature list), S9 (metadata)."""
    v.matrix.select("doc_id", "term_id", F.col("value").cast("float").alias("value")) \
        .write.mode("overwrite").parquet(_path(outdir, f"X_{v.method}"))
    v.vocab.table.orderBy("term_id").select(F.col("term").alias("feature")) \
        .coalesce(1).write.mode("overwrite").option("header", True) \
        .csv(_path(outdir, f"features_{v.method}"))
    # one row: cached so the write and the returned dict share one aggregate
    meta = vectorization_meta(v).withColumn("created_utc", F.lit(stamp)).cache()
    meta.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False) \
        .json(_path(outdir, f"vectorization_{v.method}"))
    row = meta.first().asDict(recursive=True)
    meta.unpersist()
    return row


def save_topics(method: str, terms_long: DataFrame, doc_topic: DataFrame, k: int,
                outdir: str, stamp: str, top_k_overview: int = 10) -> dict:
    """S10..S13: topic terms, overview, doc-topic matrix (Parquet), metadata."""
    if terms_long.limit(1).count() == 0:
        raise ValueError(f"Unsupported or empty topics structure for method '{method}'")
    terms_long.write.mode("overwrite").option("header", True) \
        .csv(_path(outdir, f"topics_terms_{method}"))
    TP.topic_overview(terms_long, top_k_overview).coalesce(1).write.mode("overwrite") \
        .option("header", True).csv(_path(outdir, f"topics_overview_{method}"))
    dt_path = _path(outdir, f"doc_topic_{method}")
    TP.doc_topic_wide(doc_topic, k).write.mode("overwrite").parquet(dt_path)
    meta = TP.topics_meta(doc_topic.sparkSession.read.parquet(dt_path), method, k, dt_path) \
        .withColumn("created_utc", F.lit(stamp)).cache()
    meta.coalesce(1).write.mode("overwrite").json(_path(outdir, f"topics_{method}"))
    row = meta.first().asDict()
    meta.unpersist()
    return row


def save_report(report: DataFrame, outdir: str) -> None:
    """The comparison text, lines in order, one file."""
    report.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite") \
        .text(_path(outdir, "vectorization_comparison"))


def save_comparison(overview: DataFrame | None, outdir: str) -> None:
    """U1 sink: nothing is written when no overview exists."""
    if overview is None:
        return
    overview.coalesce(1).write.mode("overwrite").option("header", True) \
        .csv(_path(outdir, "topics_overview__comparison"))


def load_comparison_overview(spark, outdir: str, methods: list[str],
                             write: bool = True) -> DataFrame | None:
    """S15 + U1: read the overviews written for ``methods`` (missing ones are
    skipped), union them by column name, and write the comparison; None and
    nothing written when no overview exists."""
    from .corpus import stage_exists
    frames = []
    for m in methods:
        path = _path(outdir, f"topics_overview_{m}")
        if stage_exists(spark, path):  # the third column is named after the number of terms
            frame = spark.read.option("header", True).csv(path)
            frames.append(frame.withColumn("topic_id", F.col("topic_id").cast("long")))
    combined = TP.topics_comparison(frames)
    if combined is not None and write:
        save_comparison(combined.orderBy("method", "topic_id"), outdir)
    return combined
