"""Benchmark decontamination by word n-grams of the test items.

Texts and items are normalised alike: A-Z in lower case, words of letters,
digits and anything beyond ASCII, one space between words.  A *window* is
``n`` consecutive words of an item; an item of fewer words is one window.  The
windows are broadcast as a hash set, the words of every document are scanned
window by window, and what meets a hash is verified by its bytes.  A document
word inside any occurrence of a window is hit.

A window of a normalised text is one run of its bytes, so a prefix sum over the
bytes of a block of documents gives the hashes of all its windows at once.

The benchmark is broadcast in slices of about ``SLICE_BYTES`` of windows, cut by
their hashes.  Each slice is one scan, which adds what it finds to what the scan
before found; no size of the benchmark changes the result.

Defined results: null or empty text has no words and no hits; a null or wordless
item has no window; items without an id mark words, but are not listed; items
that share an id are one item; equal items are all listed; rows without a
document id, and repeated rows, are documents of their own; texts of any length
are scanned whole; empty tables give no hits; other columns ride along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_lots

N = 10
SLICE_BYTES = 64 << 20
#: Words whose windows are hashed together.
RUN_WORDS = 1 << 17

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[:128] = [chr(b).isdigit() or chr(b).isalpha() for b in range(128)]
_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordRuns:
    """Texts as one array of normalised bytes, with the place of every word."""

    def __init__(self, texts: list[bytes]):
        # a zero byte, no part of a word, closes every text
        raw = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
        word = _IS_WORD[raw]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        ends = ~word
        ends[1:] &= word[:-1]
        ends[0] = False
        self.raw_start, self.raw_stop = np.flatnonzero(begins), np.flatnonzero(ends)
        size = self.raw_stop - self.raw_start + 1  # with a space
        self.stop = np.cumsum(size) - 1
        self.start = self.stop - size + 1
        self.bytes = _FOLD[raw[word | ends]]
        self.bytes[self.stop] = 32
        self.text_start = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.text = np.searchsorted(self.text_start, self.raw_start, side="right") - 1

    def window(self, word: int, n: int) -> bytes:
        return self.bytes[self.start[word]:self.stop[word + n - 1]].tobytes()

    def hashes(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """First words of the windows of n words of one text each, and the windows' hashes."""
        for first in range(0, max(len(self.start) - n + 1, 0), RUN_WORDS):
            last = min(first + RUN_WORDS, len(self.start) - n + 1)
            at = np.arange(first, last)
            at = at[self.text[at] == self.text[at + n - 1]]
            if not len(at):
                continue
            low = self.start[first]
            body = self.bytes[low:self.stop[last + n - 2] + 1].astype(np.uint64)
            powers = np.full(len(body) + 1, _STEP)
            powers[0] = 1
            np.cumprod(powers, out=powers)  # wraps around at 64 bits, as all that follows
            sums = np.zeros(len(body) + 1, dtype=np.uint64)
            np.cumsum((body + np.uint64(1)) * powers[:-1], out=sums[1:])
            a, b = self.start[at] - low, self.stop[at + n - 1] - low
            # every window is brought to the same power
            yield at, _mixed((sums[b] - sums[a]) * powers[len(body) - a] * _inverse_power(len(body)))


def _inverse_power(size: int) -> np.uint64:
    """The inverse of the step's power ``size``, modulo 2**64."""
    return np.uint64(pow(pow(int(_STEP), size, 1 << 64), -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = N) -> DataFrame:
    """``words`` (their number), ``hash``, ``window`` (bytes) and ``ids`` (of the items that hold it, as strings) of all windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in text_lots(batch.column(1)):
                runs = WordRuns([(t or "").encode() for t in texts])
                sizes = np.bincount(runs.text, minlength=len(texts))
                rows: tuple[list, ...] = [], [], [], []
                for m in sorted(set(np.minimum(sizes[sizes > 0], n).tolist())):
                    for at, hashes in runs.hashes(m):
                        of = runs.text[at]
                        for k in np.flatnonzero((m == n) | (sizes[of] == m)).tolist():  # a shorter window is a whole item
                            for col, x in zip(rows, (m, int(hashes[k:k + 1].view(np.int64)[0]),
                                                     runs.window(at[k], m), ids[first + of[k]])):
                                col.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary()),
                     pa.array(rows[3], pa.string())], names=["words", "hash", "window", "id"])

    found = items.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(
        run, "words int, hash bigint, window binary, id string")
    return stage(found.groupBy("words", "hash", "window").agg(F.collect_set("id").alias("ids")), "windows")


class WindowSet:
    """Windows of a slice of the benchmark, for lookups by hash and then by bytes."""

    def __init__(self, rows: pa.Table):
        self.items: dict[tuple[int, bytes], list[str]] = {}
        by_size: dict[int, list[int]] = {}
        for m, h, window, ids in zip(*(rows[c].to_pylist() for c in ("words", "hash", "window", "ids"))):
            self.items[m, window] = ids
            by_size.setdefault(m, []).append(h)
        self.hashes: dict[int, tuple[np.ndarray, np.ndarray, np.uint64]] = {}
        for m, hs in by_size.items():
            known = np.unique(np.array(hs, dtype=np.int64).view(np.uint64))
            bits = max(16, len(known).bit_length() + 4)
            shift = np.uint64(64 - bits)
            cells = np.zeros(1 << bits, dtype=bool)
            cells[known >> shift] = True
            self.hashes[m] = known, cells, shift

    def find(self, runs: WordRuns) -> list[tuple[int, int, list[str]]]:
        """``(first word, words, ids)`` of every occurrence of a window."""
        out = []
        for m, (known, cells, shift) in self.hashes.items():
            for at, hashes in runs.hashes(m):
                near = np.flatnonzero(cells[hashes >> shift])
                hashes = hashes[near]
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                for word in at[near[known[place] == hashes]].tolist():
                    items = self.items.get((m, runs.window(word, m)))
                    if items is not None:
                        out.append((word, m, items))
        return out


def _slices(windows: DataFrame) -> Iterator[pa.Table]:
    """The windows in tables of about ``SLICE_BYTES``, one after the other; at least one."""
    size = F.sum(F.length("window") + 24 + F.aggregate("ids", F.lit(0), lambda a, i: a + F.length(i) + 8))
    n = (windows.agg(size).first()[0] or 0) // SLICE_BYTES + 1
    for k in range(n):
        yield windows.where(F.pmod("hash", F.lit(n)) == k).toArrow()


_HITS = "struct<n_words: bigint, n_hit: bigint, spans: array<struct<start: bigint, stop: bigint>>, items: array<string>>"
_ARROW_HITS = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.struct(
    [("start", pa.int64()), ("stop", pa.int64())]))), ("items", pa.list_(pa.string()))])


def find_passages(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", n: int = N, carry: list[str] | None = None, out: str = "hits") -> DataFrame:
    """``docs`` with a struct ``out``: ``n_words``, ``n_hit``, ``spans`` of hit words (``[start, stop)``) and ``items``
    (ids as strings, in order).  ``carry`` names the columns to keep, all by default.
    """
    carry = docs.columns if carry is None else carry
    found = docs.select(F.struct(*carry).alias("row"), F.col(text_col).cast("string").alias("text"),
                        F.lit(None).cast(_HITS).alias("hits"))
    for k, part in enumerate(_slices(item_windows(items, item_id_col, item_text_col, n))):
        found = _scan(stage(found, "passages") if k else found, part)
    return found.select("row.*", F.col("hits").alias(out))


def _scan(found: DataFrame, part: pa.Table) -> DataFrame:
    """``row``, ``text`` and ``hits`` with what the windows of a slice add to the hits."""
    sent = found.sparkSession.sparkContext.broadcast(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = WindowSet(sent.value)
        for batch in batches:
            for first, texts in text_lots(batch.column(1)):
                runs = WordRuns([(t or "").encode() for t in texts])
                n_words = np.bincount(runs.text, minlength=len(texts))
                word0 = np.cumsum(n_words) - n_words
                change = np.zeros(len(runs.start) + 1, dtype=np.int64)
                listed: dict[int, set[str]] = {}
                for word, m, ids in windows.find(runs):
                    change[word] += 1
                    change[word + m] -= 1
                    listed.setdefault(int(runs.text[word]), set()).update(ids)
                for k, old in enumerate(batch.column(2).slice(first, len(texts)).to_pylist()):
                    if old and old["n_hit"]:
                        for span in old["spans"]:
                            change[word0[k] + span["start"]] += 1
                            change[word0[k] + span["stop"]] -= 1
                        listed.setdefault(k, set()).update(old["items"])
                hit = np.cumsum(change)[:-1] > 0
                where = np.flatnonzero(hit)
                # a hit word begins a span if the word before it is not hit or of another text
                begins = np.ones(len(where), dtype=bool)
                begins[1:] = (np.diff(where) > 1) | (np.diff(runs.text[where]) > 0)
                spans: dict[int, list[dict]] = {}
                stops = np.append(where[np.flatnonzero(begins)[1:] - 1], where[-1:]) + 1
                for a, b in zip(where[begins].tolist(), stops.tolist()):
                    k = int(runs.text[a])
                    spans.setdefault(k, []).append({"start": a - int(word0[k]), "stop": b - int(word0[k])})
                hits = [{"n_words": int(n_words[k]), "n_hit": sum(s["stop"] - s["start"] for s in spans.get(k, ())),
                         "spans": spans.get(k, []), "items": sorted(listed.get(k, ()))} for k in range(len(texts))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)),
                     pa.array(hits, _ARROW_HITS)], names=["row", "text", "hits"])

    return found.mapInArrow(run, found.schema)


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "documents", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", n: int = N) -> DataFrame:
    """``docs`` without the ``documents`` that hold a window, or without the ``spans`` of text that windows cover.

    A span goes from the first character of its first word to the last one of
    its last word; what stands between spans stays as it is.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    found = find_passages(docs, items, text_col, item_id_col, item_text_col, n, out="__hits")
    if remove == "documents":
        return found.where(F.col("__hits.n_hit") == 0).drop("__hits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if spans:
                    raw = text.encode()
                    runs, body, at = WordRuns([raw]), [], 0
                    for span in spans:
                        body.append(raw[at:runs.raw_start[span["start"]]])
                        at = runs.raw_stop[span["stop"] - 1]
                    text = (b"".join(body) + raw[at:]).decode()
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row", "text"])

    others = [c for c in docs.columns if c != text_col]
    cut = found.select(F.struct(F.lit(0), *others).alias("row"), F.col(text_col).cast("string").alias("text"), "__hits.spans")
    cut = cut.mapInArrow(run, cut.select("row", "text").schema)
    return cut.select(*(F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
