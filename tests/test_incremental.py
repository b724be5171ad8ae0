"""A stage that grows: only added files are read, and the rows are those of a full run."""
import os
import tempfile

import pandas as pd
import pytest

from tessera.config import CleanConfig
from tessera.operators import clean as C
from tessera.sources import incremental as INC

CFG = CleanConfig(text_col="text")


def _write(folder, name, rows):
    pd.DataFrame(rows, columns=["doc_id", "text", "lang"]).astype({"doc_id": "int64"}).to_parquet(
        f"{folder}/{name}.parquet", index=False)


def _spoil(path):
    """Data pages made unreadable; footer, size and time stay."""
    before = os.stat(path)
    with open(path, "r+b") as f:
        body = f.read()
        pages = len(body) - 8 - int.from_bytes(body[-8:-4], "little")
        f.seek(4)
        f.write(b"\xff" * (pages - 4))
    os.utime(path, ns=(before.st_atime_ns, before.st_mtime_ns))


def _rows(df):
    return sorted((r.doc_id, r.text, r.lang, r.narrative_clean) for r in df.collect())


def _full(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return _rows(C.normalize_corpus(df, CFG))


FIRST = [(10, "Payments were late", "en"), (11, "  Payments were late ", "en"), (12, None, "en"),
         (13, "The fees doubled", "de"), (14, "n/a", "en"), (15, "same id", "b")]
SECOND = [(20, "The fees doubled", "fr"), (21, "Cards stolen", "en"), (22, "!!!", "en")]
THIRD = [(1, "Payments were late", "fr"), (30, "Cards stolen", "de"), (31, "A new complaint", "en"),
         (32, "A new complaint", "en"), (15, "same id", "a"), (33, "!!!", "en")]


@pytest.fixture()
def folders():
    base = tempfile.mkdtemp(prefix="tessera-inc-")
    os.mkdir(f"{base}/in")
    return f"{base}/in", f"{base}/stages"


def test_added_file_alone_is_read(spark, folders):
    src, base = folders
    _write(src, "a", FIRST)
    _write(src, "b", SECOND)
    first = INC.normalized(spark, spark.read.parquet(src), CFG, base)
    assert _rows(first) == _full(spark, FIRST + SECOND)
    _spoil(f"{src}/a.parquet")
    _spoil(f"{src}/b.parquet")
    with pytest.raises(Exception):                       # the old files cannot be read any more
        spark.read.parquet(src).collect()
    _write(src, "c", THIRD)
    grown = INC.normalized(spark, spark.read.parquet(src), CFG, base)
    assert _rows(grown) == _full(spark, FIRST + SECOND + THIRD)
    same = INC.normalized(spark, spark.read.parquet(src), CFG, base)   # nothing added: nothing read
    assert _rows(same) == _rows(grown)


def test_changed_or_removed_file_starts_anew(spark, folders):
    src, base = folders
    _write(src, "a", FIRST)
    _write(src, "b", SECOND)
    INC.normalized(spark, spark.read.parquet(src), CFG, base).count()
    _write(src, "b", THIRD)
    assert _rows(INC.normalized(spark, spark.read.parquet(src), CFG, base)) == _full(spark, FIRST + THIRD)


def test_many_additions_are_written_as_one(spark, folders, monkeypatch):
    monkeypatch.setattr(INC, "MAX_GENERATIONS", 2)
    src, base = folders
    _write(src, "a", FIRST)
    _write(src, "a2", [])
    told = list(FIRST)
    INC.normalized(spark, spark.read.parquet(src), CFG, base).count()
    for i in range(4):
        more = [(5 - i, "Payments were late", "en"), (100 + i, f"number {'x' * (i + 1)} complaint", "en")]
        told += more
        _write(src, f"more{i}", more)
        got = INC.normalized(spark, spark.read.parquet(src), CFG, base, corpus="corpus")
    assert _rows(got) == _full(spark, told)
    stage = [d for d in os.listdir(base)]
    kinds = [g for d in stage for g in os.listdir(f"{base}/{d}") if "-base-" in g]
    assert len(kinds) >= 3                                # two corpora names, and one rewrite


def test_half_written_generation_is_not_read(spark, folders):
    src, base = folders
    _write(src, "a", FIRST)
    _write(src, "b", SECOND)
    want = _rows(INC.normalized(spark, spark.read.parquet(src), CFG, base))
    stage = f"{base}/{os.listdir(base)[0]}"
    os.makedirs(f"{stage}/gen-000002-add-abcdef012345/rows")
    assert _rows(INC.normalized(spark, spark.read.parquet(src), CFG, base)) == want


def test_input_without_files(spark):
    df = spark.createDataFrame(FIRST, "doc_id long, text string, lang string")
    assert _rows(INC.normalized(spark, df, CFG)) == _full(spark, FIRST)


def test_default_folder_is_found_again(spark, folders):
    src, _ = folders
    _write(src, "a", FIRST)
    _write(src, "b", SECOND)
    want = _rows(INC.normalized(spark, spark.read.parquet(src), CFG))
    _spoil(f"{src}/a.parquet")
    assert _rows(INC.normalized(spark, spark.read.parquet(src), CFG)) == want
