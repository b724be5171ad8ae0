"""Ranks and running sums inside keys of any size, without one task a key.

Rows are dealt out by ranges of (key, order), numbered where they lie, and
written.  A key that reaches over several ranges needs an offset in each of its
later ones.  Only the first key of a range can have begun before it, so the
first and the last key of every range tell all offsets: one row a range reaches
the driver and goes back, whatever the table's size.

Defined results: key columns must not be null; nulls in the order come first;
rows that are equal in key and order are numbered in any order; an empty table
gives an empty one; other columns ride along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def running_sums(df: DataFrame, key: list[str], order: list[str], rank: str, sums: dict[str, str] | None = None,
                 parts: int | None = None) -> DataFrame:
    """``df`` with ``rank`` (from 0) of a row in its key, and for each ``name -> column`` (long) of ``sums``
    the sum of that column over the earlier rows of the key.

    ``parts`` ranges are made, ``spark.sql.shuffle.partitions`` by default.
    """
    wanted = {rank: None} | (sums or {})
    cols = [*key, *order]
    dealt = df.repartitionByRange(parts, *cols) if parts else df.repartitionByRange(*cols)
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + "".join(f", `{n}` bigint" for n in wanted) + ", __range int, __at bigint"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        last, carried, at = None, [0] * len(wanted), 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            begins = np.zeros(n, dtype=bool)
            keys = [batch.column(batch.schema.get_field_index(k)) for k in key]
            for c in keys:
                begins[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            begins[0] = last is None or [c[0].as_py() for c in keys] != last
            start = np.maximum.accumulate(np.where(begins, np.arange(n), -1))
            out = []
            for i, column in enumerate(wanted.values()):
                x = (np.ones(n, dtype=np.int64) if column is None else
                     batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False).astype(np.int64))
                before = np.cumsum(x) - x
                own = before - np.where(start < 0, -carried[i], before[np.maximum(start, 0)])
                carried[i] = int(own[-1] + x[-1])
                out.append(pa.array(own))
            last = [c[n - 1].as_py() for c in keys]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *out, pa.array(np.full(n, here, dtype=np.int32)), pa.array(np.arange(at, at + n))],
                names=[*batch.schema.names, *wanted, "__range", "__at"])
            at += n

    numbered = stage(dealt.sortWithinPartitions(*cols).mapInArrow(number, schema), "numbered")
    first, last = F.struct(*key).alias("k"), F.struct(*key, *(
        (F.col(n) + (1 if c is None else F.col(c))).alias(f"__{n}") for n, c in wanted.items()))
    edges = numbered.groupBy("__range").agg(F.min_by(first, "__at").alias("first"), F.max_by(last, "__at").alias("last"))
    kinds = dict(df.dtypes)
    offsets = df.sparkSession.createDataFrame(
        _offsets(sorted(map(tuple, edges.collect())), len(key)),
        ", ".join(["__range int", *(f"`{k}` {kinds[k]}" for k in key), *(f"`__before_{n}` bigint" for n in wanted)]))
    joined = numbered.join(F.broadcast(offsets), ["__range", *key], "left")
    return joined.select(*df.columns, *((F.col(n) + F.coalesce(F.col(f"__before_{n}"), F.lit(0))).alias(n) for n in wanted))


def _offsets(edges: list[tuple], n_key: int) -> list[tuple]:
    """``(range, key, sums before it)`` of the ranges whose first key began in an earlier one."""
    out, carried_key, carried = [], None, ()
    for number, first, last in edges:
        first, last, sums = tuple(first), tuple(last[:n_key]), tuple(last[n_key:])
        if first == carried_key:
            out.append((number, *first, *carried))
            if last == first:  # the range holds this key alone
                sums = tuple(a + b for a, b in zip(carried, sums))
        carried_key, carried = last, sums
    return out
