"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

A text is read as a sequence of marks: for every word its hashed lower-case
form, its shape (classes of characters, runs written once), and a mark if the
three words that end with it stood in the text before.  Every mark has a sparse
random index vector; its word vector is the sum of the index vectors around its
occurrences in the training texts, scaled to length one.  A document is the
mean of its word vectors and its length; a network of two layers, trained with
numpy, scores it; a temperature fitted on training rows that the network has
not seen calibrates the probability.

Vectors and network are fitted on at most about ``TRAINING_ROWS`` labelled
rows; scoring reads every whole text.

Defined results: null or empty texts are a document without words; null ids are
scored; repeated rows score alike; without labelled rows of both kinds every
score is the share of good labels (0 if there are none); other columns are
never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_blocks
from .labelled import held_out, training_rows

TRAINING_ROWS = 16_000
WORD_CELLS, SHAPE_CELLS = 1536, 511
N_MARKS = WORD_CELLS + SHAPE_CELLS + 1   # the last one marks repetition
DIMENSIONS = 64
ONES = 8            # entries of an index vector that are not zero
WINDOW = 3
HIDDEN = 32
EPOCHS = 60
TASKS = 16          # that read the training rows; each hands the driver one table of sums
DECISION = 0.7
WORD_ENTRIES = 400_000

_SHAPES = [(re.compile(p), s) for p, s in (
    (r"[^\W\d_a-zà-öø-ÿ]+", "X"), (r"[a-zà-öø-ÿ]+", "x"), (r"\d+", "9"))]


class _Marks(dict):
    """Word -> (mark of its form, mark of its shape)."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= WORD_ENTRIES:
            self.clear()
        shape = word[:200]
        for pattern, sign in _SHAPES:
            shape = pattern.sub(sign, shape)
        shape = re.sub(r"(.)\1+", r"\1", shape)[:12]
        form = word.lower().strip(".,;:!?\"'()[]")
        self[word] = value = (zlib.crc32(form.encode()) % WORD_CELLS,
                              WORD_CELLS + zlib.crc32(shape.encode()) % SHAPE_CELLS)
        return value


_marks = _Marks()


def mark_sequence(text: str) -> np.ndarray:
    """Marks of a text in order."""
    words = text.split()
    if not words:
        return np.empty(0, dtype=np.int64)
    pairs = np.array(list(map(_marks.__getitem__, words)), dtype=np.int64)
    out = np.full((len(words), 3), -1, dtype=np.int64)
    out[:, :2] = pairs
    if len(words) > 2:
        own = pairs[:, 0] * N_MARKS + pairs[:, 1]
        three = (own[:-2] * 1_000_003 + own[1:-1]) * 1_000_003 + own[2:]  # wraps around
        first = np.zeros(len(three), dtype=bool)
        first[np.unique(three, return_index=True)[1]] = True
        out[2:, 2][~first] = N_MARKS - 1
    flat = out.reshape(-1)
    return flat[flat >= 0]


def index_vectors(seed: int = 5) -> np.ndarray:
    """Sparse random vectors of -1, 0 and 1, one per mark."""
    rng = np.random.default_rng(seed)
    out = np.zeros((N_MARKS, DIMENSIONS))
    for row in out:
        row[rng.choice(DIMENSIONS, ONES, replace=False)] = rng.choice([-1.0, 1.0], ONES)
    return out


def _contexts(texts: list[str], index: np.ndarray) -> np.ndarray:
    """Sums of the index vectors around every mark."""
    pairs = np.zeros(N_MARKS * N_MARKS)
    for _, block in text_blocks(texts, 2 << 20):
        runs = [mark_sequence(t) for t in block]
        marks = np.concatenate(runs)
        of = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        for d in range(1, WINDOW + 1):
            inside = of[:-d] == of[d:]
            pairs += np.bincount((marks[:-d] * N_MARKS + marks[d:])[inside], minlength=len(pairs))
    pairs = pairs.reshape(N_MARKS, N_MARKS)
    return (pairs + pairs.T) @ index


def word_vectors(rows: DataFrame) -> np.ndarray:
    """Random-indexing vectors of all marks, of length one; the sums are whole numbers, so any order gives the same."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors()
        total = np.zeros_like(index)
        for batch in batches:
            total += _contexts(batch.column(0).to_pylist(), index)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    total = np.zeros((N_MARKS, DIMENSIONS))
    for part in rows.select("text").repartition(TASKS).mapInArrow(run, "sums binary").toArrow()["sums"].to_pylist():
        total += np.frombuffer(part).reshape(total.shape)
    return total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1.0)


def pooled(text: str, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector, and the length."""
    marks = mark_sequence(text)
    if not len(marks):
        return np.zeros(DIMENSIONS + 1)
    counts = np.bincount(marks, minlength=N_MARKS)
    used = np.flatnonzero(counts)
    return np.append(counts[used] @ vectors[used] / len(marks), np.log1p(len(marks)) / 10)


@dataclass
class QualityModel:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]  # weights and bias of both layers
    temperature: float = 1.0
    constant: float | None = None  # the score if there was nothing to learn from

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x = np.stack([pooled(t, self.vectors) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train_network(x: np.ndarray, y: np.ndarray, seed: int = 3) -> list[np.ndarray]:
    """Two layers by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    params = [rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN),
              rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(())]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            xb, yb = x[order[at:at + 128]], y[order[at:at + 128]]
            h = np.tanh(xb @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30)))
            d = (p - yb) / len(xb)
            dh = np.outer(d, params[2]) * (1 - h * h)
            grads = [xb.T @ dh + 1e-4 * params[0], dh.sum(axis=0), h.T @ d + 1e-4 * params[2], d.sum()]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] = params[k] - 3e-3 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return params


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the smallest cross entropy."""
    tried = np.exp(np.linspace(np.log(0.25), np.log(8), 121))
    losses = [np.mean(np.logaddexp(0, -np.where(y == 1, 1, -1) * logits / t)) for t in tried]
    return float(tried[int(np.argmin(losses))])


def train_model(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                text_col: str = "text", max_rows: int = TRAINING_ROWS) -> QualityModel:
    """Fit word vectors, network and temperature on labelled documents that are not held out."""
    rows = training_rows(docs, labels, label_col, max_rows, id_col, text_col)
    counts = dict(rows.groupBy("label").count().collect())
    empty = np.zeros((N_MARKS, DIMENSIONS))
    if not counts.get(0) or not counts.get(1):
        return QualityModel(empty, np.zeros(1), np.ones(1), [], constant=1.0 if counts.get(1) else 0.0)
    vectors = word_vectors(rows)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64()),
                 pa.array([pooled(t, sent.value).tobytes() for t in texts], pa.binary())], names=["label", "mark", "x"])

    got = rows.select("label", "text").mapInArrow(run, "label int, mark bigint, x binary").toArrow()
    x = np.stack([np.frombuffer(b) for b in got["x"].to_pylist()])
    y, mark = got["label"].to_numpy().astype(float), got["mark"].to_numpy()
    order = np.lexsort((*x.T, mark))  # any order of the rows trains the same network
    x, y, mark = x[order], y[order], mark[order]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    kept = mark % 5 == 0  # apart for the temperature; copies of a text fall on the same side
    if len(set(y[~kept])) < 2:
        kept = np.zeros(len(y), dtype=bool)
    model = QualityModel(vectors, mean, scale, train_network((x[~kept] - mean) / scale, y[~kept]))
    if kept.any():
        model.temperature = fit_temperature(model.logits(x[kept]), y[kept])
    return model


def score_documents(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = DECISION) -> DataFrame:
    """Per row: ``id_col``, ``held_out``, ``score`` and ``predicted``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                scores = sent.value.scores([t or "" for t in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    kind = dict(docs.dtypes)[id_col]
    scored = docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
