"""Near-duplicate vectors by random-hyperplane sign hashing.

Each of ``tables`` hash tables keys a vector by the signs of its projections on
``bits`` random directions; vectors that share a key in some table are compared
by exact cosine in double precision, and pairs at or above the threshold link.
Two vectors at the threshold share a table with probability ``RECALL`` at
least: ``bits`` grows with the logarithm of the number of vectors, so that keys
hold few vectors, and ``tables`` follows from the two.

Equal vectors collapse into one representative before hashing.  A key that many
vectors share is cut into blocks of about ``BLOCK`` rows by a hash of the id,
and every pair of its blocks is a group of its own; a group is compared by
matrix products and hands on, per vector, how many it links with, and the links
of a spanning forest.  A pair that meets in several tables is counted in the
first.  So rows do not grow with the pairs of a group.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and stay; vectors of different lengths never
link; rows with a null id link with nothing; rows that share an id are one
node; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .components import connected_components

THRESHOLD = 0.95
RECALL = 0.995
BLOCK = 1024
SEED = 20


def hash_shape(n_vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits a key and number of tables."""
    bits = min(40, max(8, math.ceil(math.log2(max(n_vectors, 1))) - 2))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def _directions(size: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, bits * tables))


def _keyed(vectors: DataFrame, kind: str, bits: int, tables: int) -> DataFrame:
    """One row per vector and table: ``t``, ``key``, ``id``, ``copies``, ``keys`` (of all tables), ``v``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for whole in batches:
            for batch in (whole.slice(i, 2048) for i in range(0, whole.num_rows, 2048)):
                rows = batch.column(2).to_pylist()
                keys = np.zeros((len(rows), tables), dtype=np.int64)
                sizes = np.array([len(r) for r in rows])
                for size in np.unique(sizes):
                    if size not in directions:
                        directions[size] = _directions(int(size), bits, tables)
                    own = np.flatnonzero(sizes == size)
                    x = np.array([rows[i] for i in own], dtype=np.float64)
                    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow, signs stay
                    signs = (x @ directions[size] >= 0).reshape(len(own), tables, bits)
                    keys[own] = signs @ weights
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables), pa.int32()),
                                              pa.array(keys.reshape(-1))), batch.column(2)],
                    names=["id", "copies", "keys", "v"])

    found = vectors.select("id", "copies", "v").mapInArrow(
        run, f"id {kind}, copies bigint, keys array<bigint>, v array<double>")
    return found.select(F.posexplode("keys").alias("t", "key"), "id", "copies", "keys", "v")


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _group_links(t: int, apart: bool, side: np.ndarray, ids: np.ndarray, copies: np.ndarray, keys: np.ndarray,
                 vectors: list, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of a group: copies that each row links with, and the row its part of the group hangs from.

    ``side`` tells the two blocks of a group of two (``apart``) from each other.
    """
    n = len(ids)
    linked, root = np.zeros(n, dtype=np.int64), np.arange(n)
    sizes = np.array([len(v) for v in vectors])
    pairs = []
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        x = _unit([vectors[i] for i in own])
        for at in range(0, len(own), BLOCK):
            rows = own[at:at + BLOCK]
            a, b = np.nonzero(x[at:at + BLOCK] @ x.T >= threshold)
            a, b = rows[a], own[b]
            keep = (side[a] < side[b]) if apart else (a < b)
            a, b = a[keep], b[keep]
            new = ids[a] != ids[b]
            for earlier in range(t):
                new &= keys[a, earlier] != keys[b, earlier]
            pairs.append((a[new], b[new]))
    a, b = (np.concatenate(x) for x in zip(*pairs))
    np.add.at(linked, a, copies[b])
    np.add.at(linked, b, copies[a])
    while True:  # smallest row reachable
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if np.array_equal(before, root):
            return linked, root


def _links(groups: DataFrame, kind: str, threshold: float) -> DataFrame:
    """Rows ``id``, ``linked``, ``head`` of groups that lie sorted in their partitions."""
    names = ["t", "key", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None

        def flush() -> pa.RecordBatch | None:
            table = pa.Table.from_batches(held)
            if table.num_rows < 2:
                return None
            ids = table["id"].to_numpy()
            keys = np.array(table["keys"].to_pylist(), dtype=np.int64)
            linked, root = _group_links(current[0], current[2] != current[3], table["block"].to_numpy(), ids,
                                        table["copies"].to_numpy(), keys, table["v"].to_pylist(), threshold)
            got = np.flatnonzero((linked > 0) | (root != np.arange(len(ids))))
            if not len(got):
                return None
            return pa.RecordBatch.from_arrays([pa.array(ids[got]), pa.array(linked[got]), pa.array(ids[root[got]])],
                                              names=["id", "linked", "head"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in names]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            bounds = [0, *changes.tolist(), batch.num_rows]
            for lo, hi in zip(bounds, bounds[1:]):
                key = tuple(int(c[lo]) for c in cols)
                if key != current and held:
                    out = flush()
                    if out is not None:
                        yield out
                    held = []
                current = key
                held.append(batch.slice(lo, hi - lo))
        if held:
            out = flush()
            if out is not None:
                yield out

    return groups.mapInArrow(run, f"id {kind}, linked bigint, head {kind}")


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per vector: ``id_col``, ``n_links``, ``component_id`` and ``kept``."""
    kind = dict(vectors.dtypes)[id_col]
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v"))
    good = (F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
            & F.exists("v", lambda x: x != 0.0))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    same = stage(rows.where("good").groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "vectors")
    bits, tables = hash_shape(same.count(), threshold, recall)

    keyed = _keyed(same, kind, bits, tables)
    crowded = (keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
               .select("t", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    placed = keyed.join(crowded, ["t", "key"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # a block meets itself and every other block of its key
    groups = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "t", "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "id", "copies", "keys", "v")
    order = ["t", "key", "lo", "hi"]
    met = stage(_links(groups.repartition(*order).sortWithinPartitions(*order), kind, threshold), "links")

    counts = met.groupBy("id").agg(F.sum("linked").alias("linked"))
    heads = connected_components(met.select(F.col("id").alias("a"), F.col("head").alias("b")))
    found = (same.join(counts, "id", "left").join(heads.withColumnRenamed("node", "id"), "id", "left")
             .select(F.col("v"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "id").alias("component_id")))
    component = F.when(F.col("good"), F.col("component_id")).otherwise(F.col("id"))
    return (rows.join(found, "v", "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("good"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept")))
