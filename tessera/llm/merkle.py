"""Merkle manifest of a table: SHA-256 trees with retained midstates.

A leaf is the hash of a row's fields.  The leaves of a group (a source), in the
order of their ids, become nodes of 16 consecutive children each, level by
level, until one is left: the group's subroot.  The subroots, in the order of
the groups, become the root in the same way.

A parent retains a copy of its hash state before each child slot.  To fold a
changed child the matching state is resumed with the replacement and the right
siblings alone; what stands left of it is never hashed again.

Two levels at a time are built in one row: a *block* of 256 consecutive nodes of
a group.  So no task ever holds more of a group than a block, however many rows
the group has, and a tier of the tree has a 256th of the rows of the tier below.
On the way down a block gets the path above it: per level the text left and
right of its own digest.  Its state is restored from the left text once a block
and resumed for each of the block's leaves.

Defined results: null fields are ``-`` in a leaf, unlike empty ones; a null
group is the first group; null ids come first in a group; rows that share an id
stand in the order of their leaves; repeated rows are leaves of their own, equal
in all but their place; texts of any length are hashed whole; an empty table has
no rows and no root; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .ordered import running_sums

ARITY = 16
BLOCK = ARITY * ARITY

_PATH = "array<struct<left: string, right: string>>"
_ARROW_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def leaf_hash(*fields: Column) -> Column:
    """SHA-256 of the fields, each ``-`` or its UTF-8 byte count, ``:`` and its text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts)), 256)


class Parent:
    """The parent of a run of digests, with its hash state before each child slot."""

    __slots__ = ("children", "before", "digest")

    def __init__(self, children: list[bytes]):
        self.children, self.before = children, []
        state = sha256()
        for c in children:
            self.before.append(state.copy())
            state.update(c)
        self.digest = state.hexdigest().encode()

    def fold(self, slot: int, digest: bytes) -> bytes:
        """The parent's digest with another digest in this slot."""
        state = self.before[slot].copy()
        state.update(digest + b"".join(self.children[slot + 1:]))
        return state.hexdigest().encode()

    def sides(self, slot: int) -> tuple[bytes, bytes]:
        return b"".join(self.children[:slot]), b"".join(self.children[slot + 1:])


class Ancestor:
    """One level above a block: the retained state before the block's digest, and what is right of it."""

    __slots__ = ("before", "right", "siblings")

    def __init__(self, left: bytes, right: bytes):
        self.before, self.right, self.siblings = sha256(left), right, left + right

    def fold(self, digest: bytes) -> bytes:
        state = self.before.copy()
        state.update(digest + self.right)
        return state.hexdigest().encode()


class Block:
    """Up to 256 consecutive nodes of a group and the levels above them."""

    def __init__(self, number: int, digests: list[bytes]):
        # a first block of one run is the whole group; of one node, it is its root already
        n_levels = 2 if number or len(digests) > ARITY else 1 if len(digests) > 1 else 0
        self.levels: list[list[Parent]] = []
        for _ in range(n_levels):
            self.levels.append([Parent(digests[i:i + ARITY]) for i in range(0, len(digests), ARITY)])
            digests = [p.digest for p in self.levels[-1]]
        self.digest = digests[0]

    def slots(self, at: int) -> Iterator[tuple[Parent, int]]:
        """Parents above a node, bottom up, each with the slot that leads to the node."""
        for parents in self.levels:
            at, slot = divmod(at, ARITY)
            yield parents[at], slot

    def sides(self, at: int) -> list[tuple[bytes, bytes]]:
        return [p.sides(slot) for p, slot in self.slots(at)]

    def fold(self, at: int, digest: bytes) -> bytes:
        for parent, slot in self.slots(at):
            digest = parent.fold(slot, digest)
        return digest


def _blocks(nodes: DataFrame, *columns: str) -> DataFrame:
    """``nodes`` (``g``, ``at``, the given columns) as one row a block: ``g``, ``block`` and sorted ``nodes``."""
    packed = nodes.withColumn("block", F.expr(f"at div {BLOCK}"))
    return stage(packed.groupBy("g", "block").agg(F.sort_array(F.collect_list(F.struct("at", *columns))).alias("nodes")),
                 "blocks")


def _parents(blocks: DataFrame) -> DataFrame:
    """One node a block: ``g``, ``at`` and ``digest``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Block(b, [d.encode() for d in ds]).digest.decode()
                     for b, ds in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())],
                                             names=["g", "at", "digest"])

    return stage(blocks.select("g", "block", F.col("nodes.digest").alias("d")).mapInArrow(
        run, "g string, at bigint, digest string"), "nodes")


def _paths_down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """``g``, ``at``, ``subroot`` and ``path`` (bottom up) of the nodes in ``blocks``; ``above`` has those of the blocks."""
    cut = (blocks.select("g", "block", F.col("nodes.digest").alias("d"))
           .join(above.withColumnRenamed("at", "block"), ["g", "block"]).select("g", "block", "d", "subroot", "path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, number, digests, subroot, path in zip(*(c.to_pylist() for c in batch.columns)):
                block = Block(number, [d.encode() for d in digests])
                n = len(digests)
                paths = [[{"left": a.decode(), "right": b.decode()} for a, b in block.sides(i)] + path for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * n, pa.string()), pa.array(range(number * BLOCK, number * BLOCK + n), pa.int64()),
                     pa.array([subroot] * n, pa.string()), pa.array(paths, _ARROW_PATH)],
                    names=["g", "at", "subroot", "path"])

    return stage(cut.mapInArrow(run, f"g string, at bigint, subroot string, path {_PATH}"), "paths")


def _up(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of blocks over ``nodes`` (``g``, ``at``, ``digest``, a written table), and one node a group, its root."""
    tiers: list[DataFrame] = []
    while nodes.agg(F.max("at")).first()[0]:
        tiers.append(_blocks(nodes, "digest"))
        nodes = _parents(tiers[-1])
    return tiers, nodes


def _down(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The paths of the nodes under the tiers, from those of the groups' roots (``g``, ``at`` 0, ``subroot``, ``path``)."""
    for blocks in reversed(tiers):
        tops = _paths_down(blocks, tops)
    return tops


def manifest(rows: DataFrame, id_col: str = "id", group_col: str = "group", leaf_col: str = "leaf",
             tampered_col: str = "tampered") -> DataFrame:
    """Per row: ``id``, ``group``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    ``tampered_col`` is the leaf that a reader of the row computes, null where
    it is the original one.  ``folded_root`` is the root with that leaf in the
    place of the original; the row is verified if this is the root.
    ``proof_sha256`` is the hash of the siblings on the way to the root.
    """
    id_type = dict(rows.dtypes)[id_col]
    group = F.col(group_col).cast("string")
    leaves = rows.select(F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("g"), F.col(id_col).alias("id"),
                         F.col(leaf_col).alias("digest"), F.col(tampered_col).alias("tampered"))
    leaves = running_sums(stage(leaves, "leaves"), ["g"], ["id", "digest", "tampered"], "at")
    ground = _blocks(leaves, "id", "digest", "tampered")
    group_tiers, subroots = _up(_parents(ground))
    subroots = stage(running_sums(subroots.select(F.lit("").alias("one"), "g", "digest"), ["one"], ["g"], "at"), "subroots")
    root_tiers, roots = _up(subroots.select(F.col("one").alias("g"), "at", "digest"))
    root = roots.first()  # the only one
    no_path = F.array().cast(_PATH).alias("path")
    to_root = _down(root_tiers, roots.select("g", "at", F.col("digest").alias("subroot"), no_path))
    tops = (subroots.join(to_root.select("at", "path"), "at")
            .select("g", F.lit(0).cast("bigint").alias("at"), F.col("digest").alias("subroot"), "path"))
    paths = _down(group_tiers, tops)
    whole = root["digest"] if root else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for k, (g, number, digests, tampered, subroot, path) in enumerate(
                    zip(*(c.to_pylist() for c in batch.columns[1:]))):
                block = Block(number, [d.encode() for d in digests])
                up = [Ancestor(s["left"].encode(), s["right"].encode()) for s in path]
                rest = b"".join(a.siblings for a in up)
                proofs, folded = [], []
                for i, (own, other) in enumerate(zip(digests, tampered)):
                    proof = sha256()
                    for left, right in block.sides(i):
                        proof.update(left + right)
                    proof.update(rest)
                    proofs.append(proof.hexdigest())
                    digest = block.fold(i, (own if other is None else other).encode())
                    for a in up:
                        digest = a.fold(digest)
                    folded.append(digest.decode())
                n = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [ids[k].values, pa.array([g[1:] if g else None] * n, pa.string()), pa.array(digests, pa.string()),
                     pa.array([subroot] * n, pa.string()), pa.array([whole] * n, pa.string()),
                     pa.array(proofs, pa.string()), pa.array(folded, pa.string()),
                     pa.array([f == whole for f in folded], pa.bool_())],
                    names=["id", "group", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    placed = (ground.join(paths.withColumnRenamed("at", "block"), ["g", "block"])
              .select(F.col("nodes.id").alias("ids"), "g", "block", F.col("nodes.digest").alias("digests"),
                      F.col("nodes.tampered").alias("tampered"), "subroot", "path"))
    return placed.mapInArrow(run, f"id {id_type}, group string, leaf string, subroot string, root string, "
                                  "proof_sha256 string, folded_root string, verified boolean")


def tampered_text(text: Column) -> Column:
    """What the tampering of the query does: A-Z in lower case, null stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def document_manifest(docs: DataFrame, every: int = 5) -> DataFrame:
    """The manifest of ``documents`` by source, where documents of which ``every`` divides the crc32 of the id are tampered with."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    rows = docs.select(F.col("doc_id"), F.col("source"), leaf_hash(*fields).alias("leaf"),
                       F.when(hit, leaf_hash(*fields[:4], tampered_text(fields[4]))).alias("tampered"))
    return manifest(rows, "doc_id", "source").withColumnsRenamed({"id": "doc_id", "group": "source"})
