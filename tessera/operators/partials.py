"""Sums that every task of a pass emits in part: one model-sized matrix a task, added over all tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of the matrix that travel in one row, as bytes: nothing is converted number by number.
BLOCK_ROWS = 512
#: Tasks that add the partial sums.
SUM_TASKS = 16


def list_column(rows: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as a list column."""
    n, width = rows.shape
    ends = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(rows, dtype=np.float64).reshape(-1)))


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block: a task holds one sum of each of its blocks, however many rows come."""
    sums, rows = {}, {}
    for batch in batches:
        for block, n, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            part = np.frombuffer(cells.as_buffer())
            if block in sums:
                sums[block] += part
                rows[block] += n
            else:
                sums[block], rows[block] = part.copy(), n
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int64()), pa.array(list(rows.values()), pa.int64()),
         pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "rows", "cells"])


#: Shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run meanwhile leave no shuffle files: a fit runs one a pass, each with model-sized sums a task."""
    try:
        before = spark.conf.get(SHUFFLE_CLEANUP)
    except Exception:  # a Spark without this setting
        yield
        return
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def summed_partials(rows: DataFrame, partial: Callable, shape: tuple[int, int]) -> tuple[np.ndarray, int]:
    """The sum of the matrices that ``partial`` makes of the batches of each task, and of its counts.

    ``partial(batches)`` gives a matrix of ``shape`` and a number.  Blocks of
    ``BLOCK_ROWS`` matrix rows are shuffled and added; the sum, of the size of
    one matrix, reaches the driver.
    """
    n, width = shape
    n_blocks = -(-n // BLOCK_ROWS)

    def run(batches):
        total, read = partial(batches)
        cells = [np.ascontiguousarray(total[a * BLOCK_ROWS:(a + 1) * BLOCK_ROWS]) for a in range(n_blocks)]
        used = [a for a in range(n_blocks) if cells[a].any()]
        # block -1 carries the number
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *used], pa.int64()), pa.array([read] + [0] * len(used), pa.int64()),
             pa.array([b"", *(cells[a].tobytes() for a in used)], pa.binary())], names=["block", "rows", "cells"])

    columns = "block bigint, rows bigint, cells binary"
    with _shuffles_go(rows.sparkSession):
        got = (rows.mapInArrow(run, columns).repartition(min(SUM_TASKS, n_blocks), "block")
               .mapInArrow(_add, columns).toArrow())
    out, read = np.zeros((n, width)), 0
    for block, number, cells in zip(got["block"].to_pylist(), got["rows"].to_pylist(), got["cells"]):  # model-sized
        if block < 0:
            read = number
        else:
            out[block * BLOCK_ROWS:(block + 1) * BLOCK_ROWS] = np.frombuffer(cells.as_buffer()).reshape(-1, width)
    return out, read
