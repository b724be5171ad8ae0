"""Toxicity scores from a weighted lexicon.

Texts are folded first: compatibility forms, case, look-alike letters of other
scripts, and digits or signs that stand for letters inside a word.  A lexicon of
words and word beginnings is learned from labelled documents (log ratio of how
many toxic and how many clean ones hold it) and matched by one Aho-Corasick
automaton; hits inside an exception phrase do not count.  The sum of the
weights is normalised by the length of the text and turned into a probability
by a logistic curve fitted on the same training rows.

Training uses at most about ``TRAINING_ROWS`` labelled rows, of which near
copies count once, and keeps at most ``LEXICON_SIZE`` entries; scoring reads
every whole text.

Defined results: null or empty texts score like any text without a hit; rows
with null ids are scored; repeated rows score alike; without labelled rows of
both kinds the lexicon is empty and every score is the share of toxic labels
(0 if there are none); other columns are never read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, training_rows
from .ngram_join import shingles

TRAINING_ROWS = 24_000
CANDIDATES = 60_000       # of the entries that toxic documents hold, the most common
LEXICON_SIZE = 5_000
LEAST_SHARE = 0.004       # of the toxic training documents, to be an entry
LEAST_DOCS = 4
LEAST_WEIGHT = 3.0        # log ratio
PREFIXES = (4, 5, 6)      # letters of a beginning
COVERS = 0.9
DECISION = 0.3

#: Phrases in which a word of the lexicon means no offence.
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "take out the trash", "clown fish", "clown car", "sore loser",
              "pond scum", "soap scum", "scum of soap", "not stupid", "not worthless", "not an idiot", "is no idiot",
              "pathetic fallacy", "idiot proof", "idiot light")

# fixed values: look-alike letters of the Cyrillic and Greek scripts
LOOKALIKES = str.maketrans("авеёіјкмнорсԁѕтухһӏαβεηικνορτυχ", "abeeijkmhopcdstyxhlabeniknoptux")
# fixed values: digits and signs that stand for letters
SIGN_LETTERS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
_AS_I = str.maketrans({k: v[0] for k, v in SIGN_LETTERS.items()})
_AS_L = str.maketrans({k: v[-1] for k, v in SIGN_LETTERS.items()})
_DISGUISED = re.compile(r"\S*[0134578@$!|]\S*").findall
_TRIM = re.compile(r"^\W{2,}|\W{2,}$|[.,;:!?]+$")
_WORDS = re.compile(r"[^\W_]+").findall
_INVISIBLE = re.compile("[­​-‏⁠﻿]")


def fold(text: str) -> str:
    """Words of a text in folded form between single spaces, disguised words a second time at the end."""
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).lower().translate(LOOKALIKES)
    else:
        text = text.lower()
    words = _WORDS(text)
    extra = []
    for raw in _DISGUISED(text):
        token = _TRIM.sub("", raw)
        letters = sum(c.isalpha() for c in token)
        if letters and len(token) > letters and 3 * letters >= len(token):
            extra.extend(dict.fromkeys(w for table in (_AS_I, _AS_L) for w in [token.translate(table)] if w.isalpha()))
    return f" {' '.join(words)} {' '.join(['|', *extra]) + ' ' if extra else ''}"


def _entries(words: set[str]) -> set[str]:
    """Lexicon entries that match these words: `` word `` and `` beginning``."""
    out = {f" {w} " for w in words if len(w) > 2}
    for k in PREFIXES:
        out.update(f" {w[:k]}" for w in words if len(w) > k)
    return out


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 0.0
    intercept: float = -30.0
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    @property
    def automaton(self):
        if self._automaton is None:
            import ahocorasick
            a = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                a.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                a.add_word(f" {phrase} ", (len(phrase) + 2, None))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """Start, stop and weight of every hit that counts; of entries that begin together, the heaviest."""
        found, excepted = {}, []
        for last, (size, weight) in self.automaton.iter(folded):
            start = last - size + 1
            if weight is None:
                excepted.append((start, last + 1))
            elif weight > found.get(start, (0, 0.0))[1]:
                found[start] = (last + 1, weight)
        return [(a, b, w) for a, (b, w) in sorted(found.items())
                if not any(x <= a and a < y - 1 for x, y in excepted)]

    def strength(self, text: str) -> float:
        """Sum of the weights, normalised by length."""
        if not self.weights:
            return 0.0
        folded = fold(text)
        total = sum(w for _, _, w in self.hits(folded))
        return total / math.log2(8 + folded.count(" ")) if total else 0.0

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, self.slope * self.strength(text) + self.intercept))))


def _count_entries(rows: DataFrame, known: set[str] | None) -> Counter:
    """How many of the texts hold each entry; with ``known``, of these only."""
    sent = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = _entries(set(fold(text).split()))
                counts.update(found if sent.value is None else found & sent.value)
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())],
                                             names=["entry", "n"])

    summed = rows.select("text").mapInArrow(run, "entry string, n bigint").groupBy("entry").agg(F.sum("n").alias("n"))
    if known is None:
        summed = summed.orderBy(F.desc("n"), "entry").limit(CANDIDATES)
    got = summed.toArrow()
    return Counter(dict(zip(got["entry"].to_pylist(), got["n"].to_pylist())))


def _without_copies(rows: DataFrame) -> DataFrame:
    """Training rows of which near copies (two equal smallest shingles) stand once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [shingles(t.encode().lower().split(), 3)[:2].tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.binary())],
                                             names=["label", "text", "mark"])
    marked = rows.select("label", "text").mapInArrow(run, "label int, text string, mark binary")
    return marked.groupBy("mark").agg(F.min(F.struct("label", "text")).alias("x")).select("x.*")


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's method with a small ridge."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 1e-2 * beta
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def learn_lexicon(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                  text_col: str = "text", exceptions: tuple[str, ...] = EXCEPTIONS,
                  max_rows: int = TRAINING_ROWS) -> Lexicon:
    """Learn the lexicon and its curve from labelled documents that are not held out."""
    rows = training_rows(docs, labels, label_col, max_rows, id_col, text_col)
    single = _without_copies(rows).persist()
    n = dict(single.groupBy("label").count().collect())
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        single.unpersist()
        share = n_toxic / max(n_toxic + n_clean, 1)
        return Lexicon({}, exceptions, 0.0, 30.0 if share else -30.0)
    toxic = _count_entries(single.where("label = 1"), None)
    least = max(LEAST_DOCS, math.ceil(LEAST_SHARE * n_toxic))
    toxic = Counter({e: k for e, k in toxic.items() if k >= least})
    clean = _count_entries(single.where("label = 0"), set(toxic))
    single.unpersist()
    # a beginning gives way to what is longer and holds in nearly all the same documents
    longest = {b for e, k in toxic.items() for j in PREFIXES for b in [e[:j + 1]]
               if b != e.rstrip() and len(b) < len(e) and k >= COVERS * toxic[b]}
    weights: dict[str, float] = {}
    for entry, k in sorted(toxic.items(), key=lambda x: (len(x[0].rstrip()), x[0])):
        weight = math.log((k + 0.5) / (n_toxic + 1)) - math.log((clean[entry] + 0.5) / (n_clean + 1))
        covered = any(entry[:j + 1] in weights for j in PREFIXES)
        if weight >= LEAST_WEIGHT and not covered and entry not in longest:
            weights[entry] = weight
    kept = sorted(weights, key=lambda e: (-toxic[e], e))[:LEXICON_SIZE]
    lexicon = Lexicon({e: weights[e] for e in kept}, exceptions)

    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([sent.value.strength(t) for t in batch.column(1).to_pylist()], pa.float64())],
                names=["label", "strength"])

    got = rows.select("label", "text").mapInArrow(run, "label int, strength double").toArrow()
    lexicon.slope, lexicon.intercept = _logistic(got["strength"].to_numpy(), got["label"].to_numpy().astype(float))
    return lexicon


def score_documents(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = DECISION) -> DataFrame:
    """Per row: ``id_col``, ``held_out``, ``score`` and ``predicted``."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [sent.value.score(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    kind = dict(docs.dtypes)[id_col]
    scored = docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
