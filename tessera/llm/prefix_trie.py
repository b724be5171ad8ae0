"""Prefix trie of conversations by an Euler tour that is ranked as a distributed list.

Every distinct run of first turns of a conversation is a node; the empty run is
the root.  The tour walks the trie: each node has an arc that enters it and one
that leaves it, and each arc names the arc after it.  Once every arc knows its
place in the tour, a node's subtree is what lies between its two arcs, so sums
over subtrees are differences of prefix sums at arc places.

1. Turns are numbered in their conversations; a prefix is known by its depth and
   a 128-bit sum of hashes of (place, role, text), a running sum like any other.
2. Equal prefixes are one node; nodes are numbered by (smallest member, depth),
   which is nearly the order of the tour.
3. Children of a node are numbered by their smallest member.  Parents are looked
   up in lots of ``LOT`` children, so a node that a third of all conversations
   share is not one task.
4. The list is ranked by contraction: the arcs of a range of nodes are joined
   into chains where they lie (pointer doubling in numpy), then the chains are a
   shorter list.  As the nodes' order is nearly the tour's, chains are few; a
   list that ranges do not shorten is ranked by pointer doubling over joins.
5. Ranking carries weights along, so each arc gets its place and the sums of
   leaves and savings over all places before it.

Defined results: a null turn number comes first; turns equal in number stand in
the order of role and text, repeated rows are turns of their own; null role or
text is empty; rows without a conversation id belong to none and are left out;
texts are hashed whole; an empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, stage
from .ordered import running_sums

#: Children that look their parent up together.
LOT = 256
#: Nodes whose arcs are joined into chains in one task, at most.
RANGE_NODES = 1 << 17
#: Chains that one task joins at the end.
LAST_CHAINS = 1 << 16
#: Conversation ids that are written out as one piece of text.
IDS_A_PIECE = 1024

_KEY = ["depth", "p", "q"]
_LOW = (1 << 32) - 1


def turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """``conv``, ``turn`` (from 0), ``digest`` and ``n_bytes`` (of the text) of every turn, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    bare = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("__turn"), role.alias("__role"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        text.alias("__text"), F.octet_length(text).cast("long").alias("n_bytes"))
    # equal digests are equal turns, so ties need the texts only to be told apart in their order
    return running_sums(bare, ["conv"], ["__turn", "__role", "__text"], "turn").select("conv", "turn", "digest", "n_bytes")


def with_shared_heads(ordered: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Every conversation c with its first turns taken from conversation ``c - c % group``.

    It takes ``crc32(c) % most`` of them, all if there are fewer, none if that
    conversation does not exist; its own turns follow after as many of its own.
    """
    def taken(conv: Column) -> Column:
        return F.crc32(conv.cast("string").cast("binary")) % most

    ordered = stage(ordered, "turns")
    heads = (ordered.where(F.col("turn") < most - 1)
             .select(F.col("conv").alias("base"), "turn", "digest", "n_bytes"))
    convs = ordered.select("conv").distinct().withColumn("base", F.col("conv") - F.col("conv") % group)
    first = (convs.join(heads, "base").where(F.col("turn") < taken(F.col("conv")))
             .select("conv", F.lit(0).alias("part"), F.col("turn").alias("at"), "digest", "n_bytes"))
    own = (ordered.where(F.col("turn") >= taken(F.col("conv")))
           .select("conv", F.lit(1).alias("part"), F.col("turn").alias("at"), "digest", "n_bytes"))
    return running_sums(stage(first.union(own), "rebuilt"), ["conv"], ["part", "at"], "turn").drop("part", "at")


def _prefixes(ordered: DataFrame) -> DataFrame:
    """``conv``, ``depth``, ``p``/``q`` (the prefix up to this turn), ``up_p``/``up_q`` (the one before) and ``n_bytes``."""
    lanes = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), F.col("turn"), F.col("digest"))
        lanes += [F.shiftrightunsigned(h, 32).alias(f"h{seed}a"), h.bitwiseAND(F.lit(_LOW)).alias(f"h{seed}b")]
    names = ["h1a", "h1b", "h2a", "h2b"]
    summed = running_sums(ordered.select("conv", "turn", "n_bytes", *lanes), ["conv"], ["turn"], "__rank",
                          {f"s{n}": n for n in names})

    def key(before: bool, seed: int) -> Column:
        a, b = (F.col(f"sh{seed}{x}") + (0 if before else F.col(f"h{seed}{x}")) for x in "ab")
        return F.shiftleft(a.bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(b.bitwiseAND(F.lit(_LOW)))

    return stage(summed.select("conv", (F.col("turn") + 1).alias("depth"), key(False, 1).alias("p"), key(False, 2).alias("q"),
                               key(True, 1).alias("up_p"), key(True, 2).alias("up_q"), "n_bytes"), "prefixes")


def _numbered_nodes(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: its key, ``conv``, ``n_convs``, ``n_bytes``, ``no`` (by conv and depth), the parent's key and ``child_no``."""
    nodes = prefixes.groupBy(*_KEY).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"),
                                        F.min("n_bytes").alias("n_bytes"), F.min("up_p").alias("up_p"), F.min("up_q").alias("up_q"))
    zero = F.lit(0).cast("long")
    root = (convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where(F.col("n_convs") > 0)
            .select(zero.alias("depth"), zero.alias("p"), zero.alias("q"), "conv", "n_convs", zero.alias("n_bytes"),
                    F.lit(None).cast("long").alias("up_p"), F.lit(None).cast("long").alias("up_q")))
    nodes = stage(nodes.unionByName(root), "nodes")
    numbered = running_sums(nodes.withColumn("__one", F.lit(0)), ["__one"], ["conv", "depth"], "no").drop("__one")
    # the root is the only node of depth 0 and so the only child of a key of depth -1
    keyed = numbered.withColumns({"up_depth": F.col("depth") - 1, "up_p": F.coalesce("up_p", F.lit(0)),
                                  "up_q": F.coalesce("up_q", F.lit(0))})
    return stage(running_sums(stage(keyed, "nodes"), ["up_depth", "up_p", "up_q"], ["conv"], "child_no"), "nodes")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Nodes with ``n_children``, ``parent`` (its number) and ``parent_conv`` (null for the root)."""
    counts = (nodes.groupBy("up_depth", "up_p", "up_q").agg(F.count(F.lit(1)).alias("n_children"))
              .select(F.col("up_depth").alias("depth"), F.col("up_p").alias("p"), F.col("up_q").alias("q"), "n_children"))
    nodes = stage(nodes.join(counts, _KEY, "left").fillna(0, ["n_children"]), "nodes")
    parents = (nodes.where(F.col("n_children") > 0)
               .select(F.col("depth").alias("up_depth"), F.col("p").alias("up_p"), F.col("q").alias("up_q"),
                       F.col("no").alias("parent"), F.col("conv").alias("parent_conv"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_children - 1) div {LOT}"))).alias("lot")))
    return stage(nodes.withColumn("lot", F.expr(f"child_no div {LOT}"))
                 .join(parents, ["up_depth", "up_p", "up_q", "lot"], "left"), "nodes")


def euler_arcs(nodes: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``id``, ``next`` and the named values of two arcs a node (``no``, ``parent``, ``child_no``, ``n_children``).

    Arc ``2 * no`` enters a node and ``2 * no + 1`` leaves it; the last arc,
    which leaves the root, has a null ``next``.  A node's values are on the arc
    that leaves it.
    """
    enter, leave = F.col("no") * 2, F.col("no") * 2 + 1
    none = [F.lit(0).cast("long").alias(k) for k in values]
    to_first = nodes.where((F.col("child_no") == 0) & F.col("parent").isNotNull()).select(
        (F.col("parent") * 2).alias("id"), enter.alias("next"), *none)
    turn_back = nodes.where(F.col("n_children") == 0).select(enter.alias("id"), leave.alias("next"), *none)
    sibling = nodes.select("parent", (F.col("child_no") - 1).alias("child_no"), F.col("no").alias("sibling"))
    onward = (nodes.select("no", "parent", "child_no", *(v.cast("long").alias(k) for k, v in values.items()))
              .join(sibling, ["parent", "child_no"], "left")
              .select(leave.alias("id"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("next"), *values))
    return to_first.union(turn_back).union(onward)


def _chains(ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join sorted elements into chains: per element the index of its chain's tail, the steps to it, and whether it is a head."""
    n = len(ids)
    at = np.minimum(np.searchsorted(ids, after), n - 1)
    here = ids[at] == after
    tail = np.where(here, at, np.arange(n))
    left = here.astype(np.int64)
    while True:
        further = tail[tail]
        if (further == tail).all():
            break
        left += left[tail]
        tail = further
    heads = np.ones(n, dtype=bool)
    heads[at[here]] = False
    return tail, left, heads


def _join_chains(weights: list[str]):
    """A function of a partition's elements (``id``, ``next``, weights) that adds ``head`` and, in the chain, the sums
    before each element; heads get the chain's ``onward`` element and its ``total_`` weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got).sort_by("id")
        ids = rows["id"].to_numpy()
        after = rows["next"].fill_null(-1).to_numpy()
        tail, left, heads = _chains(ids, after)
        order = np.lexsort((-left, tail))  # chain by chain, from head to tail
        head_at = np.flatnonzero(heads[order])
        size = np.diff(np.append(head_at, len(ids)))
        head = np.empty(len(ids), dtype=np.int64)
        head[order] = np.repeat(ids[order][head_at], size)
        columns = [rows["id"], pa.chunked_array([head])]
        totals = []
        for w in weights:
            x = rows[w].to_numpy()[order]
            before = np.cumsum(x) - x
            own = np.empty(len(ids), dtype=np.int64)
            own[order] = before - np.repeat(before[head_at], size)
            total = np.zeros(len(ids), dtype=np.int64)
            total[order[head_at]] = np.add.reduceat(x, head_at)
            columns += [rows[w], pa.chunked_array([own])]
            totals.append(pa.chunked_array([total]))
        onward = np.full(len(ids), -1)
        onward[order[head_at]] = after[tail[order[head_at]]]
        table = pa.table([*columns, *totals, pa.chunked_array([pa.array(onward, mask=onward < 0)])],
                         names=[n.partition(" ")[0] for n in _chain_schema(weights).split(", ")])
        yield from table.combine_chunks().to_batches()

    return run


def _chain_schema(weights: list[str]) -> str:
    names = ["id", "head", *(c for w in weights for c in (w, f"before_{w}")), *(f"total_{w}" for w in weights), "onward"]
    return ", ".join(f"{n} bigint" for n in names)


def list_sums(elements: DataFrame, weights: list[str], n: int) -> DataFrame:
    """The ``n`` elements of one list (``id``, ``next``, null at its end, and weights) with the sums ``before_`` each
    of them in the list's order."""
    spark = elements.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // (2 * RANGE_NODES) + 1)
    joined = stage(elements.repartitionByRange(parts, "id").mapInArrow(_join_chains(weights), _chain_schema(weights)), "chains")
    chains = stage(joined.where(F.col("id") == F.col("head")).select(
        "id", F.col("onward").alias("next"), *(F.col(f"total_{w}").alias(w) for w in weights)), "list")
    m = chains.count()
    if m <= LAST_CHAINS:
        starts = chains.repartition(1).mapInArrow(_join_chains(weights), _chain_schema(weights))
    elif 2 * m <= n:
        starts = list_sums(chains, weights, m)
    else:
        starts = _doubled(chains, weights)
    starts = starts.select(F.col("id").alias("head"), *(F.col(f"before_{w}").alias(f"start_{w}") for w in weights))
    return (lookup_join(joined, stage(starts, "starts"), ["head"], "inner", m)
            .select("id", *weights, *((F.col(f"start_{w}") + F.col(f"before_{w}")).alias(f"before_{w}") for w in weights)))


def _doubled(elements: DataFrame, weights: list[str]) -> DataFrame:
    """Sums before each element of a list by pointer doubling: every round, an element adds what the one it points to
    has added up, and points where that one points."""
    totals = elements.agg(*(F.sum(w).alias(w) for w in weights)).first()
    while elements.where(F.col("next").isNotNull()).limit(1).count():
        ahead = elements.select(F.col("id").alias("next"), F.col("next").alias("next2"), *(F.col(w).alias(f"more_{w}") for w in weights))
        elements = stage(elements.join(ahead, "next", "left").select(
            "id", F.col("next2").alias("next"), *((F.col(w) + F.coalesce(f"more_{w}", F.lit(0))).alias(w) for w in weights)), "list")
    return elements.select("id", *((F.lit(totals[w]) - F.col(w)).alias(f"before_{w}") for w in weights))


def subtree_sums(nodes: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``no`` and, for each ``name -> value`` of a node, the sum over its subtree, itself included."""
    arcs = stage(euler_arcs(nodes, values).withColumn("place", F.lit(1).cast("long")), "arcs")
    summed = list_sums(arcs, ["place", *values], arcs.count())
    leaving = F.col("id") % 2 == 1
    return summed.groupBy(F.expr("id div 2").alias("no")).agg(*(
        F.sum(F.when(leaving, F.col(f"before_{k}") + F.col(k)).otherwise(-F.col(f"before_{k}"))).alias(k) for k in values))


def _end_hashes(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """Node key and ``ends_sha256``: the hash of the ids of the conversations that end there, in order, with commas.

    Ids are written out in pieces of ``IDS_A_PIECE``; a node's pieces then pass
    through one running hash, which holds no more than a piece.
    """
    none = convs.select("conv", *(F.lit(0).cast("long").alias(k) for k in _KEY))
    ends = prefixes.select("conv", *_KEY).union(none).groupBy("conv").agg(F.max(F.struct(*_KEY)).alias("k")).select("conv", "k.*")
    ranked = running_sums(stage(ends, "ends"), _KEY, ["conv"], "rank")
    pieces = (ranked.groupBy(*_KEY, F.expr(f"rank div {IDS_A_PIECE}").alias("piece"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in key), pa.array([state.hexdigest()])],
                                              names=[*_KEY, "ends_sha256"])
        for batch in batches:
            found: list[pa.RecordBatch] = []
            for *now, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if now != key:
                    if key is not None:
                        found.append(row())
                    key, state = now, sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if found:
                yield pa.Table.from_batches(found).combine_chunks().to_batches()[0]
        if key is not None:
            yield row()

    return (pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece")
            .mapInArrow(run, "depth bigint, p bigint, q bigint, ends_sha256 string"))


def prefix_trie(ordered: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie's nodes with their members, children, leaves, savings and ends.

    ``ordered`` has the turns (``conv``, ``turn`` from 0, ``digest``,
    ``n_bytes``), ``convs`` one row a conversation (``conv``), turnless ones
    included.  ``saved_tokens`` sums, over a node's subtree, the bytes of each
    node's last text once for every member but the first.
    """
    prefixes = _prefixes(stage(ordered, "turns"))
    convs = stage(convs, "conversations")
    nodes = _with_parents(_numbered_nodes(prefixes, convs))
    sums = subtree_sums(nodes, {"n_leaves": (F.col("n_children") == 0).cast("long"),
                                "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")})
    return (nodes.join(sums, "no").join(_end_hashes(prefixes, convs), _KEY, "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs",
                    "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations``, each rebuilt with the head that its group of five shares."""
    ordered = turns(conversations)
    convs = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv")).distinct()
    return prefix_trie(with_shared_heads(ordered), convs)
