"""Labelled training rows, apart from the rows held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, stage

FOLDS, HELD_OUT_FOLD = 4, 2


def held_out(id_col: str) -> Column:
    """Whether a document's label is never learned from; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int,
                  id_col: str = "doc_id", text_col: str = "text", seed: int = 11) -> DataFrame:
    """``label`` (0/1) and ``text`` of about ``max_rows`` labelled documents at most, none held out.

    Rows are chosen by a hash of their id, the same share of any number.
    """
    usable = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
              .groupBy(id_col).agg(F.max(label_col).cast("int").alias("label")))
    n = usable.count()
    if n > max_rows:
        usable = usable.where(F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1_000_000))
                              < int(1_000_000 * max_rows / n))
    usable = stage(usable, "labels")
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return stage(lookup_join(texts, usable, [id_col], "inner", min(n, max_rows)).select("label", "text"), "training")
