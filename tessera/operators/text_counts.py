"""Term counts of whole blocks of texts, on words numbered inside a block.

The words of a block are numbered once (a dictionary of the block), an n-gram of
one or two words is a number made of theirs, and a term's place in its document
is found by one sort of (document, term) numbers; strings are only built for the
terms that leave a block.  Blocks are bounded in bytes, so a task holds one block
however many documents it reads.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.words import slices

#: Bytes of text that are counted at a time.
BLOCK_BYTES = 2 << 20
#: Texts of these alone are split at spaces; their words of two letters and more are the tokens of either pattern.
PLAIN = r"\A[a-z ]*\z"


def token_source(docs: DataFrame, text: Column, tokens, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, plain, tokens)``, and the columns to ``keep``: the text where it is made of a-z and spaces, else its tokens."""
    read = docs.select(F.col(id_col).alias("doc_id"), *keep, text.alias("_t"))
    plain = F.col("_t").rlike(PLAIN)
    return read.select("doc_id", *keep, F.when(plain, F.col("_t")).alias("plain"),
                       F.when(~plain, tokens(F.col("_t"))).alias("tokens"))


@dataclass
class Block:
    """The different terms of each document of a block: ``b`` is the second word, -1 for a single word."""

    words: pa.Array
    doc: np.ndarray
    a: np.ndarray
    b: np.ndarray
    tf: np.ndarray


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of an ordered array, and how often each occurs."""
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, dtype=np.int64)
    return ordered[starts], np.diff(np.r_[starts, len(ordered)])


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of every element of a list column, and the elements."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    return np.repeat(np.arange(len(column)), sizes), column.flatten()


def token_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.Array]]:
    """Slices of ``token_source`` rows with the document (place in the slice) and the word number of every token, and the words."""
    for batch in batches:
        size = sum(np.asarray(pc.fill_null(c, 0), dtype=np.int64) for c in (
            pc.binary_length(batch.column("plain")), pc.multiply(pc.list_value_length(batch.column("tokens")), 6)))
        for first, last in slices(size, BLOCK_BYTES):
            part = batch.slice(first, last - first)
            of, found = _lists(pc.split_pattern(part.column("plain"), " "))
            long = np.asarray(pc.binary_length(found)) >= 2
            of, found = of[long], found.filter(pa.array(long))
            if part.column("tokens").null_count < len(part):
                more, others = _lists(part.column("tokens"))
                of, found = np.concatenate([of, more]), pa.concat_arrays([found, others])
            coded = found.dictionary_encode()
            yield part, of, coded.indices.to_numpy(), coded.dictionary


def term_blocks(batches: Iterator[pa.RecordBatch], lo: int, hi: int) -> Iterator[Block]:
    """The terms of ``lo`` to ``hi`` words (one or two) of the documents, counted by document."""
    for _, of, word, words in token_blocks(batches):
        yield _counted(of, word, words, lo, hi)


def _counted(of: np.ndarray, word: np.ndarray, words: pa.Array, lo: int, hi: int) -> Block:
    # a block of several documents has under 2**21 words and 2**22 documents, and a single document has number 0
    bits = int(len(words)).bit_length()
    doc, first = of.astype(np.uint64) << np.uint64(2 * bits), word.astype(np.uint64)
    keys = []
    if lo == 1:
        keys.append(doc | first << np.uint64(bits))
    if hi == 2:
        beside = np.flatnonzero(of[1:] == of[:-1])
        keys.append(doc[beside] | first[beside] << np.uint64(bits) | first[beside + 1] + np.uint64(1))
    kept, tf = _runs(np.sort(np.concatenate(keys)))
    mask = np.uint64((1 << bits) - 1)
    return Block(words, (kept >> np.uint64(2 * bits)).astype(np.int64), (kept >> np.uint64(bits) & mask).astype(np.int64),
                 (kept & mask).astype(np.int64) - 1, tf)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of strings: a polynomial of the bytes, mixed."""
    wide = words.cast(pa.large_binary())
    ends = np.frombuffer(wide.buffers()[1], dtype=np.int64)[wide.offset:wide.offset + len(wide) + 1]
    if not len(wide) or ends[-1] == ends[0]:
        return _mixed(np.zeros(len(wide), dtype=np.uint64))
    data = np.frombuffer(wide.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]].astype(np.uint64) + np.uint64(1)
    sizes = np.diff(ends)
    place = np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], sizes)
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, dtype=np.uint64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(data * powers[place], dtype=np.uint64)])
    return _mixed(sums[ends[1:] - ends[0]] - sums[ends[:-1] - ends[0]])


def term_hashes(block: Block) -> np.ndarray:
    """64-bit hashes of a block's terms; they depend on the words alone."""
    if not len(block.words):
        return np.zeros(0, dtype=np.uint64)
    own = word_hashes(block.words)
    second = np.concatenate([own, [np.uint64(0)]])[block.b]  # the last one for single words
    return _mixed(own[block.a] * np.uint64(3) + second)


def term_strings(block: Block, at: np.ndarray) -> pa.Array:
    """The terms at some places of a block, words joined by a space."""
    a, b = block.a[at], block.b[at]
    single = pa.array(b < 0)
    first, second = block.words.take(pa.array(a)), block.words.take(pa.array(np.maximum(b, 0)))
    return pc.if_else(single, first, pc.binary_join_element_wise(first, second, " "))


def term_index(terms: list[str], lo: int, hi: int) -> dict:
    """The columns of a vocabulary's terms of one and two words; other terms are in no text.

    Plain data, as a broadcast is read where this package need not be installed.
    """
    split = [t.split(" ") for t in terms]
    wanted = [i for i, t in enumerate(split) if lo <= len(t) <= hi and all(t)]
    words = sorted({w for i in wanted for w in split[i]})
    number, n = {w: i for i, w in enumerate(words)}, len(words)
    # by word, the last place for words that are in no term: the word's own column, and whether pairs begin and end with it
    single = np.full(n + 1, -1, dtype=np.int64)
    begins, ends = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=bool)
    pairs = []
    for i in wanted:
        at = [number[w] for w in split[i]]
        if len(at) == 1:
            single[at[0]] = i
        else:
            begins[at[0]] = ends[at[1]] = True
            pairs.append((at[0] * n + at[1], i))
    pairs, columns = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2).T.copy()
    return {"size": len(terms), "words": words, "single": single, "begins": begins, "ends": ends, "pairs": pairs, "columns": columns}


def indexed_terms(index: dict, of: np.ndarray, word: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, column and count of the vocabulary's terms among a block's tokens, in this order."""
    listed = pa.array(index["words"], pa.string())
    known = np.asarray(pc.fill_null(pc.index_in(words, value_set=listed), -1)).astype(np.int64)[word]
    size, pairs = max(1, index["size"]), index["pairs"]
    column = index["single"][known]
    found = column >= 0
    keys = [of[found] * size + column[found]]
    if len(pairs):
        at = np.flatnonzero((of[1:] == of[:-1]) & index["begins"][known[:-1]] & index["ends"][known[1:]])
        pair = known[at] * len(listed) + known[at + 1]
        place = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
        hit = pairs[place] == pair
        keys.append(of[at[hit]] * size + index["columns"][place[hit]])
    kept, tf = _runs(np.sort(np.concatenate(keys)))
    return kept // size, kept % size, tf
