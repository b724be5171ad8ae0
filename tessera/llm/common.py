"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Rows of a lookup side up to which a broadcast is asked for; beyond it the join is shuffled.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: what follows reads files that every executor sees and
    that outlive the executors that wrote them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup_join(df: DataFrame, side: DataFrame, on: list[str], how: str,
                side_rows: int) -> DataFrame:
    """Join with ``side``, broadcast only if its counted rows are few enough."""
    return df.join(F.broadcast(side) if side_rows <= BROADCAST_ROWS else side, on, how)


def word_array(text: str):
    """SQL column: words ``[^\\x20\\x09-\\x0D]+`` of column ``text`` (null: none)."""
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"),
                    lambda w: w != "")


class ChunkCache(dict):
    """Chunk -> encoded bytes, filled a batch at a time by ``encode_many(chunks) -> values``.

    It holds at most ``entries`` chunks beside those of the batch at work.
    """

    def __init__(self, encode_many, entries: int = 500_000):
        super().__init__()
        self.encode_many, self.entries = encode_many, entries

    def fill(self, lists: list[list[str]]) -> list[str]:
        """Make sure that every chunk of these lists is there; returns the new ones."""
        if len(self) > self.entries:
            self.clear()
        missing = list(set().union(*lists).difference(self))
        self.update(zip(missing, self.encode_many(missing)))
        return missing


class WordValues(dict):
    """Word -> value, by ``encode_many(words) -> values``, for blocks of distinct words.

    Two generations of about ``entries`` words are held: a word of the older one
    that is met again moves to the younger one, so frequent words stay, however
    many rare ones pass by.
    """

    def __init__(self, encode_many, entries: int = 200_000):
        super().__init__()
        self.encode_many, self.entries = encode_many, entries
        self.older: dict = {}

    def of(self, words: list[str]) -> list:
        """The values of distinct words."""
        out = list(map(self.get, words))
        lacking = [i for i, v in enumerate(out) if v is None]
        new = []
        for i in lacking:
            out[i] = self.older.get(words[i])
            if out[i] is None:
                new.append(i)
        for i, value in zip(new, self.encode_many([words[i] for i in new])):
            out[i] = value
        self.update((words[i], out[i]) for i in lacking)
        if len(self) > self.entries:
            self.older = dict(self)
            self.clear()
        return out


def text_blocks(texts: list[str], chars: int = 1 << 20):
    """Cut a list of texts into runs of about so many characters; yields (first, texts)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i == len(texts) - 1:
            yield first, texts[first:i + 1]
            first, size = i + 1, 0


def text_lots(column: pa.Array, size: int = 1 << 20):
    """Cut an Arrow column of texts into runs of about so many bytes; yields (first, texts of that run alone)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(ends):
        reached = int(ends[first - 1]) if first else 0
        stop = min(int(np.searchsorted(ends, reached + size)) + 1, len(ends))
        yield first, column.slice(first, stop - first).to_pylist()
        first = stop


@functools.lru_cache(maxsize=4)
def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)
