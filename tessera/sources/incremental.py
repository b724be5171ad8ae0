"""A stage that grows with its input.

A stage is a folder of generations.  Each holds ``rows`` (normalized rows with
the digest of their text), ``gone`` (rows of earlier generations that a new
row with a smaller id displaces) and, written last, ``files`` (path, size and
time of the input files it covers); a generation counts once ``files`` is
complete, so a run that is lost half way leaves nothing that is read.

* Only files that no generation covers are normalized.  Their rows meet the
  stage by digest: (digest, id) of both sides, never texts, so the stage's
  texts are not read.  The result is that of one run over all files.
* If a covered file is gone or changed, the stage starts anew from all files.
* After ``MAX_GENERATIONS`` additions the stage is written as one generation,
  from its own rows.

The folder's name is a hash of the configuration, the columns and the corpus
(``corpus``, else the folder that all input files share; a single file is a
corpus of its own).  A stage has one writer at a time.

Empty inputs: an input without files or without rows is normalized in full and
nothing is kept for it.  Rows that share text and id are one, the least by
their other columns, as in ``dedup_keep_first``.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import asdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CleanConfig
from ..operators import clean as C
from ..plans.joins import join_small
from ..session import scratch_path, shared_folder
from .corpus import config_hash, stage_exists, write_stage

#: Additions after which a stage is written as one generation.
MAX_GENERATIONS = 32

FILE = ["path", "size", "time"]
_NAME = re.compile(r"^gen-(\d{6})-(base|add)-[0-9a-f]+$")


def input_files(raw: DataFrame) -> DataFrame | None:
    """``(path, size, time)`` of the files that ``raw`` reads, None if it reads none."""
    try:
        return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
                          F.col("_metadata.file_modification_time").alias("time")).distinct()
    except AnalysisException:
        return None


def corpus_of(files: DataFrame) -> str | None:
    """The folder that all files share, or the one file; None without files."""
    first, last = files.agg(F.min("path"), F.max("path")).first()
    if first is None or first == last:
        return first
    shared = next((i for i, (a, b) in enumerate(zip(first, last)) if a != b), min(len(first), len(last)))
    return first[:first.rfind("/", 0, shared) + 1]


def _folders(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


class Stage:
    """The generations under ``path`` and the table they make up."""

    def __init__(self, spark: SparkSession, path: str, id_col: str):
        self.spark, self.path, self.id_col = spark, path.rstrip("/"), id_col

    def generations(self) -> list[tuple[int, str, str]]:
        """(number, kind, folder) from the last complete base on."""
        found = sorted((int(m[1]), m[2], f"{self.path}/{m[0]}") for m in map(_NAME.match, _folders(self.spark, self.path))
                       if m and stage_exists(self.spark, f"{self.path}/{m[0]}/files"))
        numbers = [n for n, _, _ in found]
        if len(set(numbers)) != len(numbers):
            raise RuntimeError(f"{self.path} was written by two runs at once: {found}")
        bases = [i for i, (_, kind, _) in enumerate(found) if kind == "base"]
        return found[bases[-1]:] if bases else []

    def _read(self, what: str) -> DataFrame:
        return self.spark.read.parquet(*[f"{folder}/{what}" for _, _, folder in self.generations()])

    def files(self) -> DataFrame:
        return self._read("files")

    def marked(self) -> DataFrame:
        """Rows that stand, with their digest and generation."""
        rows, gone = self._read("rows"), self._read("gone")
        if len(self.generations()) == 1:
            return rows
        gone = gone.select(*[F.col(c).alias(f"_gone{c}") for c in [*C.DIGEST, "_id", "_gen"]])
        met = F.col("_gone_gen") > F.col("_gen")
        for c in C.DIGEST:
            met &= F.col(c) == F.col(f"_gone{c}")
        met &= F.struct(F.col(self.id_col)) == F.col("_gone_id")
        return join_small(rows, gone, met, "left_anti")

    def add(self, kind: str, rows: DataFrame, gone: DataFrame | None, files: DataFrame) -> None:
        past = self.generations()
        number = past[-1][0] + 1 if past else 1
        folder = f"{self.path}/gen-{number:06d}-{kind}-{uuid.uuid4().hex[:12]}"
        write_stage(rows.withColumn("_gen", F.lit(number)), f"{folder}/rows")
        if gone is None:
            gone = rows.select(*C.DIGEST, F.struct(F.col(self.id_col)).alias("_id")).limit(0)
        write_stage(gone.withColumn("_gen", F.lit(number)), f"{folder}/gone")
        write_stage(files.select(*FILE), f"{folder}/files")


def reconcile(old: DataFrame, new: DataFrame, text_col: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """``(new rows that stand, (digest, _id) of old rows that go)``.

    Either side holds a text once, so a digest meets at most one row of the
    other side; the smaller id stays.  The same text under the same id is
    decided by the other columns.
    """
    ident = F.struct(F.col(id_col)).alias("_id")
    mine = new.select(*C.DIGEST, ident)
    theirs = old.select(*C.DIGEST, ident.alias("_old"))
    met = join_small(theirs, mine, C.DIGEST).checkpoint(eager=True)
    lost = met.filter(F.col("_old") < F.col("_id")).select(*C.DIGEST)
    gone = met.filter(F.col("_id") < F.col("_old")).select(*C.DIGEST, F.col("_old").alias("_id"))
    same = met.filter(F.col("_id") == F.col("_old")).select(*C.DIGEST)
    if same.limit(1).count():
        def whole(df: DataFrame, name: str) -> DataFrame:
            others = [c for c in new.columns if c not in (*C.DIGEST, id_col, C.CLEAN, text_col)]
            return join_small(df, same, C.DIGEST, "left_semi").select(*C.DIGEST, ident, F.struct(*others, text_col).alias(name))
        both = whole(old, "_theirs").join(whole(new, "_mine"), [*C.DIGEST, "_id"]).checkpoint(eager=True)
        lost = lost.unionByName(both.filter(F.col("_theirs") <= F.col("_mine")).select(*C.DIGEST))
        gone = gone.unionByName(both.filter(F.col("_mine") < F.col("_theirs")).select(*C.DIGEST, "_id"))
    return join_small(new, lost, C.DIGEST, "left_anti"), gone


def normalized(spark: SparkSession, raw: DataFrame, cfg: CleanConfig = CleanConfig(),
               base: str | None = None, corpus: str | None = None) -> DataFrame:
    """The normalized corpus (N18) through its stage under ``base``, by default
    in the folder that ``spark.checkpoint.dir`` names, where the next run finds it."""
    columns = [*raw.columns, C.CLEAN]

    def build(df: DataFrame) -> DataFrame:
        return C.with_digest(C.normalize_corpus(df, cfg), cfg.text_col)

    files = input_files(raw)
    files = files if files is None else files.checkpoint(eager=True)
    name = corpus or (corpus_of(files) if files is not None else None)
    if name is None:
        path = scratch_path(spark, "stage")
        write_stage(C.normalize_corpus(raw, cfg), path)
        return spark.read.parquet(path)

    key = config_hash({"clean": asdict(cfg), "schema": raw.schema.simpleString(), "corpus": name})
    stage = Stage(spark, f"{(base or shared_folder(spark) + '/tessera-stages').rstrip('/')}/normalized-{key}", cfg.id_col)
    known = stage.generations()
    if not known:
        stage.add("base", build(raw), None, files)
    elif stage.files().join(files, FILE, "left_anti").limit(1).count():
        stage.add("base", build(raw), None, files)
    else:
        fresh = files.join(stage.files(), FILE, "left_anti").checkpoint(eager=True)
        # names of files, which the scan of ``raw`` lists on the driver as well
        paths = [r.path for r in fresh.select("path").collect()]
        if paths:
            old = stage.marked()
            if len(known) > MAX_GENERATIONS:
                stage.add("base", old.drop("_gen"), None, stage.files())
                old = stage.marked()
            added = scratch_path(spark, "added")
            write_stage(build(raw.filter(F.col("_metadata.file_path").isin(paths))), added)
            rows, gone = reconcile(old, spark.read.parquet(added), cfg.text_col, cfg.id_col)
            stage.add("add", rows, gone, fresh)
    return stage.marked().select(*columns)
