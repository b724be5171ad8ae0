"""LDA on bag-of-words counts (T1..T6), by variational Bayes.

``learning_method="batch"``: every pass reads every document exactly once and
then replaces the topics.  ``"online"``: documents are dealt once into
``mini_batches`` lots by a hash of their id; a pass reads one lot after the
other, every document exactly once, and each lot moves the topics by a step
``(learning_offset + t) ** -learning_decay`` towards what the lot, scaled to the
corpus, says.  Both share the fit of the documents.

A fit is one job: the topics are broadcast (k times the vocabulary), each task
fits its documents a block of entries at a time, and the expected counts of
topics and terms are summed in blocks of terms, so k numbers a term reach the
driver, however many documents there are.  Priors are 1/k and are not
re-estimated.  A seed gives the same start whatever the partitions.

Counts are sparse rows ``(doc_id, ids, values)``.  Documents with no vocabulary
term get the uniform distribution 1/k.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TopicConfig
from ..session import scratch_path
from .partials import list_column, summed_partials
from .vectorize import PARTIAL_TASKS, Vectorized, Vocabulary, count_rows

#: Entries of the count matrix that a task reads at a time, and those it fits at a time, padding included.
BLOCK_ENTRIES, LOT_ENTRIES = 800_000, 65_536
#: Padding up to which documents of other sizes are fitted together.
SPARE_ENTRIES = 16_384
#: There is a task for every 1024 documents up to 48 tasks, then one more for every 16 384: every task's sums
#: are shuffled.  The partitions follow the data, not the cluster, so that a seed gives one result.
DOCS_PER_TASK, FIRST_TASKS, DOCS_PER_LATER_TASK = 1024, 48, 16_384
DOC_PASSES, DOC_TOLERANCE = 100, 1e-3
#: Rounds of a document's fit before those that still move are dealt anew; then twice as many, and so on.
FIRST_ROUNDS = 10
#: Rounds run in single precision up to so many topics (smaller priors underflow) and so many words a document (the
#: rounding stays under the tolerance); the counts that the topics get are always of double precision.
SINGLE_TOPICS, SINGLE_COUNT = 50, 4096


def check_counts(rows: DataFrame) -> None:
    """The input must have ``doc_id`` and the sparse counts ``ids`` and ``values``."""
    fields = dict(rows.dtypes)
    if "doc_id" not in fields or fields.get("ids") != "array<int>" or fields.get("values") != "array<double>":
        raise TypeError("topic models need the columns doc_id, ids array<int> and values array<double>")


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of the log gamma function for positive numbers: the series at x + 6, less the six steps back."""
    x = np.asarray(x, dtype=np.float64)
    steps = (120 + x * (548 + x * (675 + x * (340 + x * (75 + x * 6))))) / (
        x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))
    far = x + 6
    inverse = 1 / (far * far)
    return np.log(far) - 0.5 / far - inverse * (1 / 12 - inverse * (1 / 120 - inverse / 252)) - steps


def _expected_logs(weights: np.ndarray) -> np.ndarray:
    return np.exp(digamma(weights) - digamma(weights.sum(axis=1, keepdims=True)))


def _exp_digamma(x: np.ndarray) -> np.ndarray:
    """``exp(digamma(x))`` without a logarithm."""
    steps = (120 + x * (548 + x * (675 + x * (340 + x * (75 + x * 6))))) / (
        x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))
    far = x + 6
    inverse = 1 / (far * far)
    return far * np.exp(-0.5 / far - inverse * (1 / 12 - inverse * (1 / 120 - inverse / 252)) - steps)


def _fit_lot(entry: np.ndarray, counts: np.ndarray, weights: np.ndarray, alpha: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Document weights (documents x k) after at most ``rounds`` more rounds, and which documents still moved.

    ``entry`` holds the topics of each document's terms (documents x k x width),
    ``counts`` their counts, 0 where padded.  A document is fitted until its
    weights move by less than the tolerance.  Settled documents keep their
    weights; their entries are dropped once they are half of those at work, so
    that most rounds copy nothing.  Factors of a document or of a term cancel
    out, so the weights are not divided by their sum.
    """
    out, moving = weights.copy(), np.ones(len(entry), dtype=bool)
    docs, live, tiny = np.arange(len(entry)), np.ones(len(entry), dtype=bool), np.finfo(entry.dtype).tiny
    for _ in range(rounds):
        factor = _exp_digamma(weights)
        share = counts / (np.matmul(factor.astype(entry.dtype)[:, None, :], entry)[:, 0, :] + tiny)
        new = alpha + factor * np.matmul(entry, share[:, :, None])[:, :, 0]
        moved = np.abs(new - weights).mean(axis=1)
        weights = np.where(live[:, None], new, weights)
        live &= moved >= DOC_TOLERANCE
        left = int(live.sum())
        if 2 * left <= len(live):
            out[docs], moving[docs] = weights, live
            if not left:
                return out, moving
            docs, weights, entry, counts = docs[live], weights[live], entry[live], counts[live]
            live = np.ones(len(docs), dtype=bool)
    out[docs], moving[docs] = weights, live
    return out, moving


def _lots(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Documents of about one size, as many as ``LOT_ENTRIES`` allows with the padding.

    The largest has a quarter more entries than the smallest, or the padding of the lot is under ``SPARE_ENTRIES``:
    a round of a small lot costs as much as one of so many entries.
    """
    order = np.argsort(sizes, kind="stable")
    ordered = sizes[order].astype(np.int64)
    before = np.r_[0, np.cumsum(ordered)]
    first = 0
    while first < len(order):
        last = min(len(order), first + max(1, LOT_ENTRIES // int(ordered[first])))
        padded = np.arange(1, last - first + 1) * ordered[first:last]
        spare = padded - (before[first + 1:last + 1] - before[first])
        fits = (padded <= LOT_ENTRIES) & ((ordered[first:last] <= 1.25 * ordered[first] + 8) | (spare <= SPARE_ENTRIES))
        if not fits.all():
            last = first + max(1, int(np.argmin(fits)))
        yield order[first:last]
        first = last


def _document_weights(of: np.ndarray, terms: np.ndarray, counts: np.ndarray, n_docs: int,
                      topics: np.ndarray, alpha: float) -> np.ndarray:
    """Weights (n_docs x k) of the documents of a block.

    Documents that still move after some rounds are dealt anew, so that a few of them do not hold up a lot.
    """
    k = len(topics)
    table = np.ascontiguousarray(topics.T)
    table /= table.max(axis=1, keepdims=True).clip(min=np.finfo(float).tiny)
    single = table.astype(np.float32) if k <= SINGLE_TOPICS else table
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    sizes = np.diff(np.r_[starts, len(of)])
    short = np.add.reduceat(counts, starts) <= SINGLE_COUNT
    weights, pending = np.ones((len(starts), k)), np.arange(len(starts))
    done, rounds = 0, FIRST_ROUNDS
    while len(pending) and done < DOC_PASSES:
        rounds = min(rounds, DOC_PASSES - done)
        again = []
        for some, by_term in ((pending[short[pending]], single), (pending[~short[pending]], table)):
            for lot in _lots(sizes[some]):
                lot = some[lot]
                width = np.arange(sizes[lot[-1]])
                at = starts[lot, None] + np.minimum(width, sizes[lot, None] - 1)
                entry = np.ascontiguousarray(np.take(by_term, terms[at], axis=0).transpose(0, 2, 1))
                count = np.where(width < sizes[lot, None], counts[at], 0.0).astype(by_term.dtype)
                weights[lot], moving = _fit_lot(entry, count, weights[lot], alpha, rounds)
                again.append(lot[moving])
        pending = np.concatenate(again)
        done, rounds = done + rounds, 2 * rounds
    gamma = np.full((n_docs, k), alpha)
    gamma[of[starts]] = weights
    return gamma


def _fit_block(of: np.ndarray, terms: np.ndarray, counts: np.ndarray, n_docs: int,
               topics: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Document weights (k x n_docs) and, per entry, its count over the topics (k x entries) before the topic factor."""
    gamma = _document_weights(of, terms, counts, n_docs, topics, alpha).T
    factor = np.ascontiguousarray(_expected_logs(gamma.T).T)
    share, expected = np.empty((len(topics), len(of))), np.full(len(of), 1e-100)
    for i in range(len(topics)):
        np.take(factor[i], of, out=share[i])
        expected += topics[i][terms] * share[i]
    share *= counts / expected
    return gamma, share


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Documents in runs of about ``BLOCK_ENTRIES`` entries: ids, entry's document, terms, counts."""
    for batch in batches:
        ids, lists, values = (batch.column(k) for k in range(3))
        ends = lists.offsets.to_numpy()  # both lists of a row have the same length
        terms = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
        counts = values.values.to_numpy(zero_copy_only=False)
        shift = values.offsets.to_numpy()[0] - ends[0]
        first = 0
        while first < len(ids):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + BLOCK_ENTRIES, side="right")) - 1)
            last = min(last, len(ids))
            a, b = ends[first], ends[last]
            of = np.repeat(np.arange(last - first), np.diff(ends[first:last + 1]))
            yield ids.slice(first, last - first), of, terms[a:b], counts[a + shift:b + shift]
            first = last


@dataclass
class BatchLda:
    """Topic-term weights (k x vocabulary) after the last pass."""

    components: np.ndarray
    alpha: float

    def topicsMatrix(self) -> DenseMatrix:
        k, n = self.components.shape
        return DenseMatrix(n, k, self.components.reshape(-1))

    def shares(self) -> np.ndarray:
        """Weights of each topic that sum to 1."""
        return self.components / self.components.sum(axis=1, keepdims=True)

    def document_weights(self, vectors: DataFrame) -> DataFrame:
        sent = vectors.sparkSession.sparkContext.broadcast(_expected_logs(self.components))
        alpha = self.alpha

        def run(batches):
            for ids, of, terms, counts in _blocks(batches):
                gamma = np.full((len(ids), len(sent.value)), alpha)
                if len(of):
                    gamma = _document_weights(of, terms, counts, len(ids), sent.value, alpha)
                yield pa.RecordBatch.from_arrays([ids, list_column(gamma / gamma.sum(axis=1, keepdims=True))], names=["doc_id", "topics"])

        kind = dict(vectors.dtypes)["doc_id"]
        return vectors.select("doc_id", "ids", "values").mapInArrow(run, f"doc_id {kind}, topics array<double>")


#: Documents of a fit, packed: the sizes of the documents of a block and its entries, as bytes.
PACKED = "sizes binary, terms binary, counts binary"


def packed(rows: DataFrame) -> DataFrame:
    """The documents of each partition in blocks (``PACKED``), so that a pass hands bytes to Python, not numbers.

    A column ``lot``, by which the partitions are ordered, is kept: a block holds documents of one lot.
    """
    lots = ["lot"] if "lot" in rows.columns else []

    def run(batches):
        for batch in batches:
            lot = batch.column(3).to_numpy() if lots else np.zeros(len(batch), dtype=np.int32)
            cuts = [0, *(np.flatnonzero(lot[1:] != lot[:-1]) + 1).tolist(), len(lot)]
            for first, last in zip(cuts, cuts[1:]):
                for ids, of, terms, counts in _blocks([batch.slice(first, last - first)]):
                    cells = (np.bincount(of, minlength=len(ids)).astype(np.int32), terms.astype(np.int32), counts)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([x.tobytes()], pa.binary()) for x in cells), *(pa.array(lot[first:first + 1]) for _ in lots)],
                        names=["sizes", "terms", "counts", *lots])

    return rows.select("doc_id", "ids", "values", *lots).mapInArrow(run, PACKED + "".join(f", {c} int" for c in lots))


def _expected_counts(blocks: DataFrame, topics: np.ndarray, prior: float) -> tuple[np.ndarray, int]:
    """Counts of topics and terms (k x vocabulary) that the documents of ``packed`` rows are expected to have, and how many
    documents were read."""
    k, n_terms = topics.shape
    sent = blocks.sparkSession.sparkContext.broadcast(topics)

    def run(batches):
        total = np.zeros((k, n_terms))
        read = 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in range(3))):
                sizes, terms = (np.frombuffer(x.as_buffer(), dtype=np.int32) for x in row[:2])
                read += len(sizes)
                if len(terms):
                    _, share = _fit_block(np.repeat(np.arange(len(sizes)), sizes), terms, np.frombuffer(row[2].as_buffer()),
                                          len(sizes), sent.value, prior)
                    for i in range(k):
                        total[i] += np.bincount(terms, share[i], n_terms)
        return total.T, read

    out, read = summed_partials(blocks, run, (n_terms, k))
    sent.destroy()
    return out.T, read


def _start(cfg: TopicConfig, n_terms: int) -> np.ndarray:
    return np.random.default_rng(cfg.random_state).gamma(100.0, 0.01, (cfg.n_topics, n_terms))


def fit_batch(rows: DataFrame, cfg: TopicConfig, n_terms: int) -> BatchLda:
    """``n_iter`` passes of batch variational Bayes over ``rows`` (a checkpointed table)."""
    prior = 1.0 / cfg.n_topics
    weights = _start(cfg, n_terms)
    blocks = packed(rows.select("doc_id", "ids", "values")).persist()
    for _ in range(max(1, cfg.n_iter)):
        topics = _expected_logs(weights)
        counts, _ = _expected_counts(blocks, topics, prior)
        weights = prior + counts * topics
    blocks.unpersist()
    return BatchLda(weights, prior)


def lot_of(doc_id, lots: int):
    """The mini batch of a document: the first 32 bits of its id's md5."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(lots)).cast("int")


def deal(rows: DataFrame, lots: int, n_docs: int) -> str:
    """Write ``rows``, packed, into one folder a lot, once for all passes; returns the path."""
    parts = _tasks(math.ceil(n_docs / lots))
    path = scratch_path(rows.sparkSession, "lda-lots")
    dealt = rows.select("doc_id", "ids", "values", lot_of("doc_id", lots).alias("lot"))
    # by id inside a lot, so that a seed gives one result
    placed = dealt.repartition(lots * parts, "lot", F.pmod(F.xxhash64("doc_id"), F.lit(parts))).sortWithinPartitions("lot", "doc_id")
    packed(placed).write.partitionBy("lot").parquet(path)
    return path


@dataclass
class OnlineLda(BatchLda):
    """Topic-term weights after the last update, with what made them."""

    start: np.ndarray | None = None
    steps: list[tuple[int, float, int]] | None = None   # lot, step size, documents read


def fit_online(rows: DataFrame, cfg: TopicConfig, n_terms: int, n_docs: int) -> OnlineLda:
    """``n_iter`` passes of online variational Bayes; a pass reads every lot, and so every document, once."""
    spark = rows.sparkSession
    prior = 1.0 / cfg.n_topics
    path = deal(rows, cfg.mini_batches, n_docs)
    lots = spark.read.schema(f"{PACKED}, lot int").parquet(path)
    weights = start = _start(cfg, n_terms)
    sizes = dict(map(tuple, lots.groupBy("lot").agg(F.sum(F.octet_length("sizes") / 4).cast("long")).collect()))  # one row a mini batch
    steps = []
    for _ in range(max(1, cfg.n_iter)):
        for lot in sorted(sizes):
            topics = _expected_logs(weights)
            counts, read = _expected_counts(lots.where(F.col("lot") == lot).drop("lot"), topics, prior)
            step = (cfg.learning_offset + len(steps)) ** -cfg.learning_decay
            weights = (1 - step) * weights + step * (prior + n_docs / sizes[lot] * counts * topics)
            steps.append((lot, step, read))
    return OnlineLda(weights, prior, start, steps)


def count_vectors(doc_terms: DataFrame, vocab: Vocabulary, binary: bool = False) -> DataFrame:
    """Sparse counts over the vocabulary, which must have a term."""
    if not vocab.size:
        raise ValueError("After pruning, no terms remain. Try a lower min_df.")
    return count_rows(doc_terms, vocab, binary)


def sparse_rows(bow: Vectorized) -> DataFrame:
    """The counts of a vectorizer's result; models need a vocabulary that every task can hold."""
    if not bow.vocab.size:
        raise ValueError("After pruning, no terms remain. Try a lower min_df.")
    if bow.rows is None:
        raise ValueError(f"a vocabulary of {bow.vocab.size} terms cannot be held by every task; set max_features")
    return bow.rows


def _tasks(n_docs: int) -> int:
    """Tasks of a pass over so many documents; each emits model-sized sums."""
    first = DOCS_PER_TASK * FIRST_TASKS
    return max(1, min(PARTIAL_TASKS, math.ceil(min(n_docs, first) / DOCS_PER_TASK)
                      + math.ceil(max(0, n_docs - first) / DOCS_PER_LATER_TASK)))


def prepare_vectors(rows: DataFrame) -> DataFrame:
    """Fix the input partitioning by doc_id (one seed -> one result) and
    checkpoint it, so every pass - and the later transform - reads a short
    lineage instead of re-deriving the counts.  At most ``PARTIAL_TASKS``
    partitions: each emits model-sized sums."""
    return rows.repartition(_tasks(rows.select("doc_id").count()), "doc_id").sortWithinPartitions("doc_id").checkpoint(eager=True)


def fit_lda(rows: DataFrame, cfg: TopicConfig, n_docs: int, prepared: bool = False, n_terms: int | None = None):
    """T2/T6 on sparse counts (``prepared=True`` when they come from ``prepare_vectors``).

    ``n_terms`` is the size of the vocabulary, by default that of the terms that occur.
    """
    check_counts(rows)
    if cfg.learning_method not in ("batch", "online"):
        raise ValueError("learning_method must be 'batch' or 'online'")
    data = rows if prepared else prepare_vectors(rows)
    if n_terms is None:
        n_terms = (data.agg(F.max(F.array_max("ids"))).first()[0] or 0) + 1
    if cfg.learning_method == "batch":
        return fit_batch(data, cfg, n_terms)
    return fit_online(data, cfg, n_terms, n_docs)


def doc_topic(model: BatchLda, rows: DataFrame, k: int) -> DataFrame:
    """``(doc_id, topics array<double>)``, rows sum to 1."""
    return model.document_weights(rows)


def top_terms(model: BatchLda, vocab: Vocabulary, n_top: int, raw: bool = False) -> DataFrame:
    """T4/T5: ``(topic_id, term_id, term, weight)`` top-n per topic by the
    topic-term weight, as a share of the topic or ``raw`` (the order is the
    same)."""
    weights = model.components if raw else model.shares()
    rows = [(topic, int(t), float(w[t])) for topic, w in enumerate(weights)
            for t in np.lexsort((np.arange(len(w)), -w))[:n_top]]  # n_topics x n_top rows
    z = vocab.table.sparkSession.createDataFrame(rows, "topic_id long, term_id int, weight double")
    return (vocab.table.select("term_id", "term").join(F.broadcast(z), "term_id")
            .select("topic_id", "term_id", "term", "weight"))
