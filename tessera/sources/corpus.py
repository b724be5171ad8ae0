"""Corpus scans (S1..S5).

* Parquet is the working format: projected and filtered at the scan.
* CSV (S1) is read with a declared schema (the text column is never
  inferred), header, multi-line quoted fields and doubled-quote escapes; the
  reader's missing-value spellings are applied to the raw cell, as the
  reference's CSV reader does.  Multi-line CSV files cannot be split, so a CSV
  corpus should be converted once to Parquet (``write_stage``).
* Stage reuse (S5): a stage is written once under a path that hashes its
  config; a later run reads it if its success marker exists.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lexicon import CSV_NA_SPELLINGS


def balance(df: DataFrame) -> DataFrame:
    """Spread an under-split input over the cluster.

    A small file with one row group is one task however many cores there are.
    Only when the scan has fewer partitions than the default parallelism is it
    redistributed (round-robin); a large input already has enough splits and
    is left alone, so this never shuffles a big table.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD API on this session: leave the scan as it is
        return df
    if current < target:
        return df.repartition(target)
    return df


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None,
               rebalance: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    return balance(df) if rebalance else df


def read_csv_corpus(spark: SparkSession, path: str, schema: T.StructType | str,
                    text_col: str = "narrative") -> DataFrame:
    """CSV corpus scan with a declared schema.

    Missing-value spellings of the raw cell become null (whole-cell, exact),
    before any stripping (S1 + the reader half of N2).
    """
    df = (spark.read.option("header", True).option("multiLine", True)
          .option("quote", '"').option("escape", '"')
          .option("mode", "FAILFAST")
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .option("nullValue", "\u0000never\u0000")   # keep "" as text; nulls below
          .option("emptyValue", "")
          .schema(schema).csv(path))
    if text_col not in df.columns:
        raise KeyError(f"Column '{text_col}' not found. Available: {df.columns}")
    c = F.col(text_col)
    return df.withColumn(text_col, F.when(c.isin(list(CSV_NA_SPELLINGS)) | c.isNull(),
                                          F.lit(None).cast("string")).otherwise(c))


def write_csv_corpus(df: DataFrame, path: str) -> None:
    """Write a corpus as CSV with the quoting the scan expects."""
    (df.write.mode("errorifexists").option("header", True)
       .option("quote", '"').option("escape", '"').option("quoteAll", True)
       # the writer trims cells by default; texts must round-trip unchanged
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def config_hash(obj) -> str:
    payload = json.dumps(obj, sort_keys=True, default=str)
    return hashlib.sha256(payload.encode()).hexdigest()[:16]


def input_identity(df: DataFrame) -> str | None:
    """A digest of the files that ``df`` reads: path, size and modification
    time, combined where the files are read.  None if it reads no files."""
    try:
        files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        n, total = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()
    except AnalysisException:
        return None
    return f"{n}:{total}" if n else None


def stage_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def write_stage(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def load_or_build_stage(spark: SparkSession, base: str, name: str, cfg, build) -> tuple[DataFrame, bool]:
    """Read ``base/name-<hash(cfg)>`` if it was written, else build, write,
    and read it back.  Returns (table, reused)."""
    path = f"{base.rstrip('/')}/{name}-{config_hash(cfg)}"
    if stage_exists(spark, path):
        return spark.read.parquet(path), True
    write_stage(build(), path)
    return spark.read.parquet(path), False
