"""Matrix statistics and the vectorization comparison (A1..A7, S14)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .vectorize import Vectorized


def matrix_stats(v: Vectorized, name: str) -> DataFrame:
    """A1..A4: shape, nnz, density (null on an empty shape), mean non-zero
    weight (0 when there is none), plus the report line."""
    n_rows, n_cols = v.n_docs, v.vocab.size
    agg = v.matrix.agg(F.count(F.lit(1)).alias("nnz"), F.avg("value").alias("_mean"))
    out = agg.select(
        F.lit(name).alias("name"),
        F.lit(n_rows).cast("long").alias("n_rows"),
        F.lit(n_cols).cast("long").alias("n_cols"),
        F.col("nnz").cast("long").alias("nnz"),
        F.try_divide(F.col("nnz").cast("double"),
                     F.lit(float(n_rows) * float(n_cols))).alias("density"),
        F.coalesce(F.col("_mean"), F.lit(0.0)).alias("mean_weight"))
    line = F.format_string("%s: shape=(%d, %d), nnz=%d, density=%.6f, mean_weight=%.6f",
                           "name", "n_rows", "n_cols", "nnz",
                           F.coalesce("density", F.lit(float("nan"))), "mean_weight")
    return out.withColumn("line", line)


def term_mean_weight(v: Vectorized) -> DataFrame:
    """A5: column mean per term over all documents (zeros included)."""
    n = float(v.n_docs)
    return (v.matrix.groupBy("term_id", "term")
            .agg((F.sum("value") / F.lit(n)).alias("mean_weight")))


def top_terms_by_mean(v: Vectorized, k: int = 5) -> DataFrame:
    """Top-k terms by mean weight; ties go to the later term (what a
    stable ascending argsort read from the end gives)."""
    means = term_mean_weight(v)
    top = means.orderBy(F.col("mean_weight").desc(), F.col("term").desc()).limit(k)
    w = Window.orderBy(F.col("mean_weight").desc(), F.col("term").desc())
    return top.withColumn("rank", F.row_number().over(w).cast("long")) \
              .select("rank", "term", "mean_weight")


def vectorization_report(bow: Vectorized, tfidf: Vectorized, k: int = 5) -> DataFrame:
    """The comparison report as ``(line_no, line)``."""
    spark = bow.matrix.sparkSession
    s_bow = matrix_stats(bow, "BoW").select(F.lit(2).alias("line_no"), "line")
    s_tf = matrix_stats(tfidf, "TF-IDF").select(F.lit(3).alias("line_no"), "line")

    def top_line(v, label, no):
        t = top_terms_by_mean(v, k)
        return t.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))),
                                              lambda x: x["term"]), ", ").alias("terms")) \
                .select(F.lit(no).alias("line_no"),
                        F.concat(F.lit(label), F.coalesce("terms", F.lit(""))).alias("line"))

    fixed = spark.createDataFrame(
        [(0, "=== VECTORISATION COMPARISON REPORT ==="), (1, ""), (4, ""),
         (5, "Top 5 terms by mean weight:" if k == 5 else f"Top {k} terms by mean weight:"),
         (6, "")], "line_no int, line string")
    parts = [fixed, s_bow, s_tf, top_line(bow, "BoW top-5 terms: ", 7),
             top_line(tfidf, "TF-IDF top-5 terms: ", 8)]
    return reduce(lambda a, b: a.unionByName(b), parts) \
        .select(F.col("line_no").cast("long").alias("line_no"), "line")


def feature_variance_total(v: Vectorized) -> DataFrame:
    """T12 denominator: sum over terms of the population variance of the
    column (all n documents, zeros included)."""
    n = float(v.n_docs)
    per_term = v.matrix.groupBy("term_id").agg(
        (F.sum(F.col("value") * F.col("value")) / F.lit(n)
         - F.pow(F.sum("value") / F.lit(n), 2)).alias("var"))
    return per_term.agg(F.coalesce(F.sum("var"), F.lit(0.0)).alias("total_variance"))
