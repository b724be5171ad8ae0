"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

``PieceCodec`` keeps an agenda of adjacent symbol pairs ordered by the score of
the piece they would make (ties: leftmost first) and merges the best pair until
none is left; symbols without a piece fall back to bytes.  A text is cut where
no piece of the vocabulary can reach across (before a run of word marks, around
characters that occur in no longer piece), so that equal chunks are merged once
per worker and looked up afterwards.  The result is the same as merging the
whole text, because a pair that makes no piece never enters the agenda.

The new chunks of an Arrow batch are merged together: each chunk has an agenda
of its own, and one numpy step takes the best pair off every agenda.  Chunks
too long for that get a heap.  Then the library encodes the same new chunks, so
every chunk of every text is checked against it once per worker.

Defined results: null or empty text has no pieces (only begin and end ids) and
decodes to an empty text; a null id stays null; repeated rows give repeated
rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterator
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .agenda import PairAgendas
from .common import ChunkCache, text_blocks

MARK = "▁"  # the library's stand-in for a space
PACK = [f"<{n}I" for n in range(64)]
LONGEST = 160  # characters of a chunk that is merged together with others


class PieceCodec:
    """Encoder and decoder of one merge-type model with an identity normalizer."""

    def __init__(self, model_path: str):
        import sentencepiece
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = lib.get_piece_size()
        self.begin, self.end, self.unknown = lib.bos_id(), lib.eos_id(), lib.unk_id()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.pieces: list[bytes] = [b""] * n
        self.is_byte = np.zeros(n, dtype=bool)
        for i in range(n):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.pieces[i] = bytes([value])
                self.is_byte[i] = True
            elif lib.is_unknown(i):
                self.pieces[i] = " ⁇ ".encode()  # what the library prints for it
            elif not lib.is_control(i):
                self.ids[piece] = i
                self.scores[piece] = lib.get_score(i)
                self.pieces[i] = piece.replace(MARK, " ").encode()
        longer = [p for p in self.ids if len(p) > 1]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in longer):
            raise ValueError("a piece holds a word mark after other characters; chunks would differ")
        inside = set("".join(longer))
        alone = "".join(c for c in "\n\t\r" if c not in inside)
        self.chunks = re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+|[{alone}]" if alone
                                 else f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall
        self._number_pairs()
        self.cache = ChunkCache(self.merge_many)
        self.differs: set[str] = set()

    def _number_pairs(self) -> None:
        """Numbers for symbols and, by pair of symbols, the rank and the symbol of what they make."""
        symbols = dict.fromkeys([*self.ids, *sorted(set("".join(self.ids)))])
        self.number = {s: k for k, s in enumerate(symbols)}
        self.symbol_ids = [self.ids.get(s, -1) for s in symbols]
        self.n_symbols = len(symbols) + 1  # the last stands for characters without a piece
        self.char_symbols = np.full(0x110000, self.n_symbols - 1, dtype=np.int64)
        for s, k in self.number.items():
            if len(s) == 1:
                self.char_symbols[ord(s)] = k
        made = sorted((p for p in self.ids if len(p) > 1), key=lambda p: (-self.scores[p], p))
        rank = {}
        for p in made:  # equal scores share a rank
            rank[p] = rank[last] if rank and self.scores[last] == self.scores[p] else len(rank)
            last = p
        number = self.number
        self.agendas = PairAgendas(self.n_symbols, [
            (number[p[:k]], number[p[k:]], rank[p], number[p])
            for p in made for k in range(1, len(p)) if p[:k] in number and p[k:] in number])

    def merge_many(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks as bytes: all agendas step by step together."""
        out: list[bytes] = [b""] * len(chunks)
        short = [k for k, c in enumerate(chunks) if len(c) <= LONGEST]
        for k, c in enumerate(chunks):
            if len(c) > LONGEST:
                out[k] = np.array(self.merge(c), dtype="<u4").tobytes()
        if not short:
            return out
        text = "".join([chunks[k] for k in short])
        sym = self.char_symbols[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")]
        sizes = np.fromiter(map(len, (chunks[k] for k in short)), dtype=np.int64, count=len(short))
        owner, sym, char = self.agendas.merge(sym, sizes)
        ids = np.array([*self.symbol_ids, -1], dtype=np.int64)[sym]
        if (ids < 0).any():  # characters without a piece
            parts: list[list[int]] = [[] for _ in short]
            for o, i, c in zip(owner.tolist(), ids.tolist(), char.tolist()):
                parts[o].extend([i] if i >= 0 else self._fallback(text[c]))
            flat, counts = np.array([i for p in parts for i in p], dtype="<u4"), [len(p) for p in parts]
        else:
            flat, counts = ids.astype("<u4"), np.bincount(owner, minlength=len(short)).tolist()
        raw, ends = flat.tobytes(), (4 * np.cumsum(counts)).tolist()
        values = [raw[a:b] for a, b in zip([0, *ends], ends)]
        if len(short) == len(chunks):
            return values
        for k, value in zip(short, values):
            out[k] = value
        return out

    def _fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown]

    def merge(self, chunk: str) -> list[int]:
        """Ids of one chunk (spaces already marked)."""
        ids, scores = self.ids, self.scores
        parts: list[str] = list(chunk)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[float, int, int]] = []

        def add(left: int, right: int) -> None:
            pair = parts[left] + parts[right]
            score = scores.get(pair)
            if score is not None:
                heapq.heappush(agenda, (-score, left, len(pair)))

        for i in range(n - 1):
            add(i, i + 1)
        while agenda:
            _, left, size = heapq.heappop(agenda)
            if not parts[left]:
                continue
            right = after[left]
            if right >= n or len(parts[left]) + len(parts[right]) != size:
                continue  # one of the two has been merged meanwhile
            parts[left] += parts[right]
            parts[right] = ""
            after[left] = nxt = after[right]
            if nxt < n:
                before[nxt] = left
                add(left, nxt)
            if before[left] >= 0:
                add(before[left], left)
        out: list[int] = []
        for part in parts:
            if part:
                found = ids.get(part)
                if found is not None:
                    out.append(found)
                else:
                    out.extend(self._fallback(part))
        return out

    def check(self, chunks: list[str]) -> None:
        """Compare chunks of the cache with the library's; remember those that differ."""
        # The library marks the begin of a text.  A chunk that is no mark and word goes in after a
        # line feed, whose own ids are then skipped.
        plain = [c[0] == MARK and len(c) > 1 and c[1] != MARK for c in chunks]
        skip = 0 if all(plain) else len(self.library.encode("\n"))
        theirs = self.library.encode([c[1:] if p else "\n" + c for c, p in zip(chunks, plain)], num_threads=1)
        for c, p, ids in zip(chunks, plain, theirs):
            ids = ids if p else ids[skip:]
            if pack_ids(PACK[len(ids)] if len(ids) < 64 else f"<{len(ids)}I", *ids) != self.cache[c]:
                self.differs.add(c)

    def encode_texts(self, texts: list[str], check: bool = False) -> tuple[list[bytes], list[bool]]:
        """Ids of whole texts as little-endian unsigned 32-bit integers, without begin
        and end; and whether the library has the same for all chunks of a text."""
        lists = [self.chunks(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = self.cache.fill(lists)
        if check and new:
            self.check(new)
        equal = [not self.differs.intersection(c) for c in lists] if self.differs else [True] * len(texts)
        return [b"".join(map(self.cache.__getitem__, c)) for c in lists], equal

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_texts([text])[0][0], dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of ids; control ids are left out, as is the space that encoding puts first."""
        raw = b"".join(map(self.pieces.__getitem__, ids))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_broken(ids)
        first = next((i for i in ids if self.pieces[i]), None)
        if first is not None and not self.is_byte[first] and text.startswith(" ") \
                and first != self.unknown:
            text = text[1:]
        return text

    def _decode_broken(self, ids: list[int]) -> str:
        """Byte ids that are no UTF-8: each such byte becomes U+FFFD."""
        out, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.pieces[i]
                continue
            while run:
                for size in (4, 3, 2, 1):
                    try:
                        char = run[:size].decode()
                    except UnicodeDecodeError:
                        continue
                    if len(char) == 1:
                        out.append(char)
                        run = run[size:]
                        break
                else:
                    out.append("�")
                    run = run[1:]
            if i is not None:
                out.append(self.pieces[i].decode())
        return "".join(out)


@functools.lru_cache(maxsize=2)
def codec(model_path: str) -> PieceCodec:
    """One codec per worker process and model."""
    return PieceCodec(model_path)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = True, digests: bool = False,
                     check: bool = True) -> DataFrame:
    """Encode and decode every whole text.

    Returns ``id_col``, ``n_tokens`` (with begin and end ids), then ``ids`` and
    ``decoded`` if ``with_ids``, ``ids_sha256`` and ``decoded_sha256`` if
    ``digests``, and ``library_equal`` if ``check``: whether the library gives
    the same ids for all chunks of the text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        head, tail = (np.array([i], dtype="<u4").tobytes() for i in (c.begin, c.end))
        for batch in batches:
            for first, texts in text_blocks([t or "" for t in batch.column(1).to_pylist()]):
                part = batch.slice(first, len(texts))
                bodies, equal = c.encode_texts(texts, check)
                coded = [np.frombuffer(b, dtype="<u4").tolist() for b in bodies]
                decoded = [c.decode(i) for i in coded]
                out = {"id": part.column(0),
                       "n_tokens": pa.array([len(i) + 2 for i in coded], pa.int64())}
                if with_ids:
                    out["ids"] = pa.array([[c.begin, *i, c.end] for i in coded], pa.list_(pa.int32()))
                    out["decoded"] = pa.array(decoded, pa.string())
                if digests:
                    out["ids_sha256"] = pa.array([hashlib.sha256(head + b + tail).hexdigest() for b in bodies])
                    out["decoded_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded])
                if check:
                    out["library_equal"] = pa.array(equal, pa.bool_())
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    kind = dict(docs.dtypes)[id_col]
    schema = (f"id {kind}, n_tokens bigint" + ", ids array<int>, decoded string" * with_ids
              + ", ids_sha256 string, decoded_sha256 string" * digests + ", library_equal boolean" * check)
    return (docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)
            .withColumnRenamed("id", id_col))
