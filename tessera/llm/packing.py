"""Best-fit packing of token documents into fixed-length sequences.

Large-item matching: pieces above one third of the capacity (at most two of
them fit one sequence) are paired greedily, longest first, each with the
longest partner that still fits; the remaining pieces go, longest first, to the
tightest gap that holds them, and open a new sequence only if there is none.

How pieces are packed depends on their lengths alone.  So the driver sees one
count per length (at most ``capacity`` of them, whatever the corpus size),
packs the counts, and sends back a bounded table of slots: which run of ranks
of a length goes to which run of sequences at which offset.  Ranks are dealt
out in parallel, in hashed lots of a length, so that a length that a third of
all pieces share is not ranked in one task: lots stay as small as they are,
however many pieces there are.  One number a lot passes through the driver.
Places are joined to the ranks, so pieces with their ids never leave the JVM again.

Defined results: null or empty text is the closing id alone; null ids stay
null; repeated rows are pieces of their own; an empty table packs to nothing.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .agenda import PairAgendas
from .common import WordValues, stage, text_lots

CAPACITY = 2048
CLOSING_ID = 0
#: Pieces of one length that are ranked together, about; a length has as many lots as it needs.
LOT_PIECES = 4096
#: Bytes of a word that is merged together with others.
LONGEST = 160


class ByteBpe:
    """A byte-level BPE tokenizer file, with a cache of encoded words.

    The pre-tokenizer of such a file cuts a text into words that are merged on
    their own by the ranks of the file's merge list.  New words of a batch are
    merged together (``agenda.PairAgendas``); what that does not cover goes to
    the tokenizers library: texts with the string of an added token, and very
    long words.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer, pre_tokenizers
        self.library = lib = Tokenizer.from_file(path)
        self.added = [t.content for t in lib.get_added_tokens_decoder().values()]
        self.all_words = regex.compile(public_tokenizers.PATTERN).findall
        # the same cut for texts of Latin letters and ASCII, in the faster module
        latin = "A-Za-zÀ-ÖØ-öø-ɏ"
        self.beyond = re.compile(f"[^\\x00-\\x1b\\x20-\\x7e{latin}]").search
        self.latin_words = re.compile(
            rf" ?[{latin}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\s0-9{latin}]+|\s+(?!\S)|\s+").findall
        model = json.loads(lib.to_str())["model"]
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.agendas = PairAgendas(max(vocab.values()) + 1, [
            (vocab[a], vocab[b], k, vocab[a + b]) for k, (a, b) in enumerate(merges)])
        stand_in = self._byte_characters(pre_tokenizers.ByteLevel.alphabet())
        self.byte_ids = np.array([vocab[stand_in[b]] for b in range(256)], dtype=np.int64)
        self.cache = WordValues(self.encode_words)

    @staticmethod
    def _byte_characters(alphabet: list[str]) -> dict[int, str]:
        """The character that stands for each byte: itself if it prints, else the next one from U+0100 on."""
        own = {ord(c): c for c in alphabet if ord(c) < 256}
        rest = sorted(c for c in alphabet if ord(c) >= 256)
        return own | dict(zip((b for b in range(256) if b not in own), rest))

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words, as bytes."""
        raw = [w.encode() for w in words]
        short = [r for r in raw if len(r) <= LONGEST]
        sizes = np.fromiter(map(len, short), dtype=np.int64, count=len(short))
        symbols = self.byte_ids[np.frombuffer(b"".join(short), dtype=np.uint8)]
        owner, ids, _ = self.agendas.merge(symbols, sizes) if short else (sizes, symbols, None)
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(short)))).tolist()
        body = ids.astype("<u4").tobytes()
        out = iter([body[a:b] for a, b in zip([0, *ends], ends)])
        return [next(out) if len(r) <= LONGEST else self.whole(w) for w, r in zip(words, raw)]

    def words(self, text: str) -> list[str]:
        return (self.all_words if self.beyond(text) else self.latin_words)(text)

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers.

        The words of all texts are numbered, each distinct one is looked up
        once, and the ids are gathered by the numbers.
        """
        lists = [[] if any(a in t for a in self.added) else self.words(t) for t in texts]
        coded = pa.array(list(chain.from_iterable(lists)), pa.string()).dictionary_encode()
        values = self.cache.of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(values), dtype="<u4")
        sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // 4
        word = coded.indices.to_numpy()
        size = sizes[word]
        stops = np.cumsum(size)
        # an id's place in its word, after the place of the word's first id
        body = ids[np.arange(len(ids) and stops[-1]) + np.repeat((np.cumsum(sizes) - sizes)[word] - stops + size, size)].tobytes()
        ends = np.append(0, 4 * stops)[np.cumsum([0, *map(len, lists)])].tolist()
        return [body[a:b] if w or not t else self.whole(t) for t, w, a, b in zip(texts, lists, ends, ends[1:])]


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Tokenize every whole text, close it with id 0, and cut what is longer than ``capacity``.

    All pieces of a cut document but the first are full.  Returns per piece:
    ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked
    for, ``ids``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(tokenizer_path)
        closing = np.array([CLOSING_ID], dtype="<u4").tobytes()
        for batch in batches:
            for first, texts in text_lots(batch.column(1)):
                part = batch.slice(first, len(texts))
                texts = [t or "" for t in texts]
                rows: list[int] = []
                cols: list[list] = [[], [], [], [], []]
                for row, raw in enumerate(bpe.encode_texts(texts)):
                    raw += closing
                    n, start, k = len(raw) // 4, 0, 0
                    while start < n:
                        size = (n % capacity or capacity) if k == 0 else capacity
                        body = raw[4 * start:4 * (start + size)]
                        rows.append(row)
                        for col, x in zip(cols, (k, start, size, zlib.crc32(body), body)):
                            col.append(x)
                        start, k = start + size, k + 1
                out = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int32()),
                       *(pa.array(c, pa.int64()) for c in cols[1:4])]
                if with_ids:
                    ends = np.cumsum([0, *cols[2]], dtype=np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(cols[4]), dtype="<i4"))))
                yield pa.RecordBatch.from_arrays(
                    out, names=["id", "piece", "start", "length", "ids_crc32", "ids"][:len(out)])

    kind = dict(docs.dtypes)[id_col]
    schema = (f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
              + ", ids array<int>" * with_ids)
    return (docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)
            .withColumnRenamed("id", id_col))


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pack ``counts`` of pieces by length.

    Returns slots ``(length, first_rank, n, first_sequence, offset)``: the ``n``
    pieces of that length from that rank on go to ``n`` successive sequences
    from ``first_sequence`` on, at that offset.
    """
    left = {k: v for k, v in counts.items() if v > 0}
    next_sequence = 0
    next_rank: dict[int, int] = defaultdict(int)
    slots: list[tuple[int, int, int, int, int]] = []
    #: gap -> runs of sequences (first, n) with that gap
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def put(length: int, n: int, first: int, offset: int) -> None:
        slots.append((length, next_rank[length], n, first, offset))
        next_rank[length] += n

    def run_of(gap: int, most: int) -> tuple[int, int]:
        """Take up to ``most`` sequences with this gap."""
        first, n = gaps[gap].pop()
        if n > most:
            gaps[gap].append((first + most, n - most))
            n = most
        return first, n

    large = sorted((k for k in left if 3 * k > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((b for b in large if left[b] and (b != a or left[a] > 1) and a + b <= capacity), None)
            n = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
            put(a, n, next_sequence, 0)
            left[a] -= n
            if b is not None:
                put(b, n, next_sequence, a)
                left[b] -= n
            gaps[capacity - a - (b or 0)].append((next_sequence, n))
            next_sequence += n
    for length in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[length]:
            gap = next((g for g in range(length, capacity) if gaps.get(g)), capacity)
            each = min(gap // length, left[length])  # this many go into one such sequence before any other
            most = left[length] // each
            if gap == capacity:
                first, n = next_sequence, most
                next_sequence += n
            else:
                first, n = run_of(gap, most)
            for k in range(each):
                put(length, n, first, capacity - gap + k * length)
            left[length] -= each * n
            gaps[gap - each * length].append((first, n))
    return slots


def spots_of(slots: list[tuple[int, int, int, int, int]], counted: np.ndarray) -> pa.Table:
    """Cut slots where lots end: one row for each run of ranks that share a lot and a slot.

    ``counted`` has (length, lot, pieces) by length and lot, no lot empty.  Ranks ``first`` to ``stop``
    (excluded) of a lot go to successive sequences from ``sequence`` on; there are
    at most as many rows as slots and lots together.
    """
    slots = np.array(sorted(slots), dtype=np.int64).reshape(-1, 5)
    before = np.cumsum(counted[:, 2]) - counted[:, 2]
    own = np.flatnonzero(np.diff(counted[:, 0], prepend=-1))  # first lot of every length
    before -= np.repeat(before[own], np.diff(np.append(own, len(counted))))
    lots, runs = counted[:, 0] * 2**44 + before, slots[:, 0] * 2**44 + slots[:, 1]
    starts = np.union1d(lots, runs)
    lot, run = (np.searchsorted(x, starts, side="right") - 1 for x in (lots, runs))
    ends = np.minimum(lots[lot] + counted[lot, 2], runs[run] + slots[run, 2])
    return pa.table({
        "__length": counted[lot, 0], "__lot": counted[lot, 1], "__first": starts - lots[lot], "__stop": ends - lots[lot],
        "__sequence": slots[run, 3] + starts - runs[run], "__offset": slots[run, 4]})


def pack(pieces: DataFrame, order_by: list[str], length_col: str = "length",
         capacity: int = CAPACITY) -> DataFrame:
    """Give each piece its ``sequence_id`` and ``offset``.

    ``pieces`` is read three times and must be a written table.  ``order_by`` orders
    pieces of equal length; rows equal in it are interchangeable.
    """
    spark = pieces.sparkSession
    totals = {int(r[0]): int(r[1]) for r in pieces.groupBy(length_col).count().collect()}  # at most ``capacity`` rows
    shares = spark.createDataFrame(pa.table({
        "__own": pa.array(totals, pa.int64()), "__lots": pa.array([k // LOT_PIECES + 1 for k in totals.values()], pa.int64())}))
    lot = F.pmod(F.xxhash64(*order_by), F.col("__lots"))
    dealt = (pieces.join(F.broadcast(shares), F.col(length_col) == F.col("__own"))
             .select(*pieces.columns, lot.alias("__in")))
    got = dealt.groupBy(F.col(length_col).alias("l"), F.col("__in").alias("lot")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    counted = np.stack([got[c].to_numpy().astype(np.int64) for c in ("l", "lot", "n")], axis=1)
    counted = counted[np.lexsort((counted[:, 1], counted[:, 0]))]
    spots = spark.createDataFrame(spots_of(pack_counts(totals, capacity), counted))
    rank = F.col("__rank")
    inside = Window.partitionBy(length_col, "__in").orderBy(*order_by)
    ranked = dealt.withColumn("__rank", F.row_number().over(inside).cast("bigint") - 1)
    return (ranked.join(F.broadcast(spots), (F.col(length_col) == F.col("__length")) & (F.col("__in") == F.col("__lot"))
                        & (rank >= F.col("__first")) & (rank < F.col("__stop")))
            .select(*pieces.columns, (F.col("__sequence") + rank - F.col("__first")).alias("sequence_id"),
                    F.col("__offset").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Tokenize, cut and pack whole documents; one row per piece.

    With ``with_ids`` the rows carry their ids: a sequence is its rows' ids in
    the order of ``offset``.
    """
    pieces = stage(token_pieces(docs, tokenizer_path, id_col, text_col, capacity, with_ids), "pieces")
    return pack(pieces, [id_col, "piece", "ids_crc32"], "length", capacity)
