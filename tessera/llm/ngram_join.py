"""Jaccard self-join on word n-grams with adaptive multi-match prefixes.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of
distinct n-word shingles.  If they do, then for every l their l-prefixes (the
``size - least overlap + l`` rarest shingles in one global order) share at
least l shingles.  Each document picks its own l: it lengthens its prefix while
the estimated cost of its candidates falls, and a pair is verified only if the
two prefixes share at least the smaller of both l.

The global order is by how many documents hold a shingle, counted over all
documents in ``2**COUNT_BITS`` cells of the shingle's hash, then by hash; any
order gives the same links, a better one gives fewer candidates.

Work follows the links, not the pairs, of a group of near copies:

1. Texts with equal words collapse into one representative.
2. Every representative is held against the first one of each shared prefix
   shingle, and what links becomes a component.
3. Pairs across components that share prefix shingles are verified in full.
   Pairs inside a component cannot change it.

Before a pair becomes a row its parity bitmaps are compared: every bit in which
they differ stands for at least one shingle that only one of the two has, so
too many such bits rule a link out.  A group of many near copies that do not
link is so compared inside the join and hardly leaves rows.  A pair meets once
for every prefix shingle that it shares; it becomes a row at the first of them
alone, and only if it shares enough.

Shingles are 64-bit hashes of their words; links and sizes are counted on them.

Defined results: null or empty texts have no shingles and link with nothing; a
text of fewer than n words is one shingle; rows without an id link with
nothing; rows that share an id are one node; repeated rows are copies; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, stage, text_lots
from .components import connected_components

COUNT_BITS = 20
LANES = 16          # counts that travel in one row
BITMAP_WORDS = 32   # 64-bit words of a parity bitmap
MAX_MATCHES = 4     # longest prefix: this many shared shingles are asked for
#: Cost of verifying a candidate against that of reading one entry of a shingle's list.
VERIFY_COST = 8.0
WORD_ENTRIES = 100_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_ENTRIES:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def text_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case (what bytes do)."""
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)], dtype=np.uint64)
    each = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = len(words) - n + 1
    h = np.zeros(size, dtype=np.uint64)
    for k in range(n):  # wraps around at 64 bits
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + each[k:k + size]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(h ^ (h >> np.uint64(32)))


def _shingle_counts(docs: DataFrame, n: int) -> np.ndarray:
    """How many documents hold a shingle of each cell; sums of ``2**COUNT_BITS`` cells reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, dtype=np.int64)
        for batch in batches:
            for _, texts in text_lots(batch.column(0)):
                for text in texts:
                    cells = (shingles(text_words(text), n) >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
                    np.add.at(counts, cells, 1)
        rows = counts.reshape(-1, LANES)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(rows[used, k]) for k in range(LANES))],
                                         names=["block", *(f"c{k}" for k in range(LANES))])

    lanes = [f"c{k}" for k in range(LANES)]
    got = (docs.mapInArrow(run, "block bigint, " + ", ".join(f"{c} bigint" for c in lanes))
           .groupBy("block").agg(*(F.sum(c).alias(c) for c in lanes)).toArrow())
    out = np.zeros((1 << COUNT_BITS) // LANES * LANES, dtype=np.int64).reshape(-1, LANES)
    if got.num_rows:
        out[got["block"].to_numpy()] = np.stack([got[c].to_numpy() for c in lanes], axis=1)
    return out.reshape(-1)


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n must share with any set it links with."""
    return (percent * n + 99) // 100


def adaptive_prefix(hashes: np.ndarray, counts: np.ndarray, base: float, percent: int) -> tuple[int, np.ndarray]:
    """The l that a document picks, and its l-prefix.

    A prefix costs reading its shingles' lists, which hold the documents over
    the mean of a cell, and verifying the candidates; a candidate of an
    l-prefix uses up l entries of the lists.
    """
    n = len(hashes)
    first = n - least_overlap(n, percent) + 1
    most = min(MAX_MATCHES, n - first + 1)
    order = np.lexsort((hashes, counts))[:first + most - 1]
    entries = np.cumsum(np.maximum(counts[order] - base, 0.0))[first - 1:]
    matches = np.arange(1, most + 1)
    best = int(np.argmin(entries + VERIFY_COST * entries / matches))
    return best + 1, hashes[order[:first + best]]


def parity_bitmap(hashes: np.ndarray, width: int = BITMAP_WORDS) -> np.ndarray:
    """Bits that an odd number of the shingles fall on, as signed 64-bit words."""
    counts = np.bincount((hashes & np.uint64(64 * width - 1)).astype(np.int64), minlength=64 * width)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8")


def _bitmaps_fit(a: str, b: str, size_a: Column, size_b: Column, percent: int, width: int) -> Column:
    """Whether sets with these bitmaps can link: they differ in ``union - both`` shingles at most."""
    differ = sum((F.bit_count(F.get(F.col(a), F.lit(k)).bitwiseXOR(F.get(F.col(b), F.lit(k)))) for k in range(width)),
                 F.lit(0))
    return differ * (100 + percent) <= (size_a + size_b) * (100 - percent)


def prefix_table(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int,
                 width: int = BITMAP_WORDS) -> DataFrame:
    """Per row: ``id``, ``d1``/``d2`` (128-bit digest of its words), ``n``, ``need`` (its l), ``prefix`` and ``bits``."""
    counts = _shingle_counts(docs.select(F.col(text_col).cast("string")), n)
    sent = docs.sparkSession.sparkContext.broadcast(counts.astype(np.float64))
    base = float(np.median(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = sent.value
        for batch in batches:
            for first, texts in text_lots(batch.column(1)):
                digests, sizes, needs, prefixes, bits = [], [], [], [], []
                for text in texts:
                    words = text_words(text)
                    found = shingles(words, n)
                    need, prefix = adaptive_prefix(found, cells[(found >> np.uint64(64 - COUNT_BITS)).astype(np.int64)],
                                                   base, percent) if len(found) else (0, found)
                    digests.append(xxhash.xxh3_128_intdigest(b" ".join(words)))
                    sizes.append(len(found))
                    needs.append(need)
                    prefixes.append(prefix.view(np.int64))
                    bits.append(parity_bitmap(found, width))
                wide = np.array([(d >> 64, d & (2**64 - 1)) for d in digests], dtype=np.uint64).view(np.int64)
                ends = np.cumsum([0, *(len(p) for p in prefixes)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(wide[:, 0]), pa.array(wide[:, 1]),
                     pa.array(sizes, pa.int32()), pa.array(needs, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefixes))),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1) * width, pa.int32()),
                                              pa.array(np.concatenate(bits)))],
                    names=["id", "d1", "d2", "n", "need", "prefix", "bits"])

    kind = dict(docs.dtypes)[id_col]
    return stage(docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, f"id {kind}, d1 bigint, d2 bigint, n int, need int, prefix array<bigint>, bits array<bigint>"), "prefixes")


def shingle_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``id`` and ``shingles`` of the documents with these ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_lots(batch.column(1)):
                sets = [shingles(text_words(t), n).view(np.int64) for t in texts]
                ends = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))],
                    names=["id", "shingles"])

    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return lookup_join(texts, ids, ["id"], "left_semi", ids.count()).mapInArrow(
        run, f"id {kind}, shingles array<bigint>")


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can link."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _size_class(n: Column, percent: int) -> Column:
    """Sizes that can link are of one class or of neighbouring ones; the margin is for the rounding of logarithms."""
    step = max(math.log(100 / max(percent, 1)), 0.01) * (1 + 1e-6)
    return F.floor(F.log(n.cast("double")) / F.lit(step)).cast("int")


def with_partner(placed: DataFrame, percent: int) -> DataFrame:
    """The entries ``(shingle, n, component, ...)`` whose shingle is in another component as well, by sizes that can link.

    Both entries of a pair that can link stay, at every shingle that they share.
    """
    sized = placed.withColumn("size_class", _size_class(F.col("n"), percent))
    met = (sized.select("shingle", "component", F.explode(F.array(*(F.col("size_class") + k for k in (-1, 0, 1)))).alias("size_class"))
           .groupBy("shingle", "size_class").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
           .where(F.col("lo") != F.col("hi")).select("shingle", "size_class"))
    return sized.join(met, ["shingle", "size_class"], "left_semi").drop("size_class")


def _meet_here(a: str, b: str, need: Column) -> Column:
    """Whether two sorted prefixes share ``need`` shingles, of which ``shingle`` is the first."""
    common = F.array_intersect(a, b)
    return (F.size(common) >= need) & (F.get(common, F.lit(0)) == F.col("shingle"))


def verify_pairs(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """The rows ``a``, ``b`` of ``pairs`` (a written table) that link."""
    ids = stage(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "candidates")
    sets = stage(shingle_sets(docs, ids, id_col, text_col, n), "sets")
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b"))
    both = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"),
                       F.size(F.array_intersect("sa", "sb")).alias("both"))
    return both.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       n: int = 3, percent: int = 90, width: int = BITMAP_WORDS) -> DataFrame:
    """Per row: ``id_col``, ``n_shingles`` and ``component_id`` (smallest id reachable by links).

    ``width`` (64-bit words of a bitmap, a power of two) changes costs, never rows.
    """
    rows = prefix_table(docs, id_col, text_col, n, percent, width)
    real = rows.where(F.col("id").isNotNull() & (F.col("n") > 0))
    firsts = stage(real.groupBy("d1", "d2").agg(F.min("id").alias("id")), "firsts")
    reps = real.join(firsts, ["id", "d1", "d2"], "left_semi")

    facts = reps.select("id", "n", "need", "bits")
    lists = reps.select("id", F.explode("prefix").alias("shingle"))
    heads = (lists.groupBy("shingle").agg(F.min("id").alias("head"), F.max("id").alias("last"))
             .where(F.col("head") < F.col("last")).select("shingle", "head"))
    shared = stage(lists.join(heads, "shingle"), "lists")  # shingles of one document only are gone

    def side(of: str) -> DataFrame:
        return facts.select(F.col("id").alias(of), *(F.col(c).alias(c + of) for c in ("n", "need", "bits")))

    met = (shared.where(F.col("id") != F.col("head")).groupBy(F.col("id").alias("a"), F.col("head").alias("b"))
           .agg(F.count(F.lit(1)).alias("met")))
    to_head = stage(met.join(side("a"), "a").join(side("b"), "b")
                    .where((F.col("met") >= F.least("needa", "needb")) & _sizes_fit(F.col("na"), F.col("nb"), percent)
                           & _bitmaps_fit("bitsa", "bitsb", F.col("na"), F.col("nb"), percent, width)).select("a", "b"), "pairs")
    links = stage(verify_pairs(docs, to_head, id_col, text_col, n, percent), "links")
    joined = connected_components(links)

    placed = (shared.select("shingle", "id").join(facts.select("id", "n").distinct(), "id")
              .join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")))
    # bitmaps and prefixes only travel with entries that have someone to meet
    entries = stage(with_partner(placed, percent), "entries")
    # of a prefix only what others hold: most of it is in one document alone; and only up to the shingle if one is enough
    shares = entries.groupBy("id", "n").agg(F.array_sort(F.collect_set("shingle")).alias("prefix"))
    upto = F.when(F.col("need") > 1, F.col("prefix")).otherwise(F.slice("prefix", F.lit(1), F.array_position("prefix", F.col("shingle"))))
    across = stage(entries.join(facts, ["id", "n"]).join(shares, ["id", "n"]).withColumn("prefix", upto), "across")
    left, right = (across.select("shingle", *(F.col(c).alias(c + k) for c in ("id", "n", "need", "component", "bits", "prefix")))
                   for k in ("1", "2"))
    more = (left.join(right, "shingle")
            .where((F.col("id1") < F.col("id2")) & (F.col("component1") != F.col("component2"))
                   & _sizes_fit(F.col("n1"), F.col("n2"), percent)
                   & _bitmaps_fit("bits1", "bits2", F.col("n1"), F.col("n2"), percent, width)
                   & _meet_here("prefix1", "prefix2", F.least("need1", "need2")))
            .select(F.col("id2").alias("a"), F.col("id1").alias("b")))
    # a head is the smallest id of its list, so verified pairs have the larger id first as well
    more = stage(more.distinct().join(to_head, ["a", "b"], "left_anti"), "pairs")  # rows that share an id meet twice
    found = stage(verify_pairs(docs, more, id_col, text_col, n, percent), "links")
    components = connected_components(links.union(found)) if not found.isEmpty() else joined

    by_text = (firsts.join(components.withColumnRenamed("node", "id"), "id", "left")
               .select("d1", "d2", F.coalesce("component", "id").alias("component_id")))
    return (rows.join(by_text, ["d1", "d2"], "left")
            .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                    F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("component_id", "id"))
                    .otherwise(F.col("id")).alias("component_id")))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     n: int = 5, percent: int = 80, width: int = BITMAP_WORDS) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of every component.

    Rows without an id stay.  Of rows that share the id that stays, one stays.
    """
    found = stage(jaccard_components(docs, id_col, text_col, n, percent, width), "components")
    gone = found.where(F.col("component_id") < F.col(id_col)).select(id_col).distinct()
    kept = lookup_join(docs, gone, [id_col], "left_anti", gone.count())
    twice = stage(found.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col), "twice")
    if twice.isEmpty():
        return kept.select(docs.columns)
    size = twice.count()
    return (lookup_join(kept, twice, [id_col], "left_anti", size).select(docs.columns)
            .unionByName(lookup_join(kept, twice, [id_col], "left_semi", size).select(docs.columns).dropDuplicates([id_col])))
