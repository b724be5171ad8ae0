"""LSA: truncated SVD of the TF-IDF matrix (T7..T12).

The matrix is read as sparse rows, one document each (``ids``, ``ws``),
checkpointed to the shared folder.  The rank-k factorization is a block Krylov
method on A = X^T X:

    Z_0 random, orthonormal; pass i computes A Z_i in one job
    Z_i+1 = A Z_i made orthogonal to all blocks before it
    Rayleigh-Ritz over the whole basis [Z_0 .. Z_i]: G = Q^T A Q is known

so every pass refines all directions seen so far, and passes end once the
residuals of the k leading pairs are small (``svd_tol``), or after ``n_iter``.

Each pass is a ``mapInArrow`` over the documents: per Arrow batch and column of
Z it forms y = X_b z and X_b^T y with numpy, and the per-task partial sums
(vocabulary x block) are added by ``summed_partials``.  Only
model-sized data (vocabulary x block a pass) reaches the driver; the document
side (U, coordinates) never does.  Document coordinates U*S = X V are one more
row-local pass with V broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TopicConfig
from ..session import stored
from .partials import list_column, summed_partials
from .vectorize import Vectorized

_CHUNK_DOCS = 2048
#: Singular values up to this share of the largest count as zero.
RANK_TOLERANCE = 1e-7


def doc_major(matrix: DataFrame) -> DataFrame:
    """``(doc_id, ids array<int>, ws array<double>)``; a row holds at most
    the vocabulary size entries."""
    g = matrix.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("term_id").cast("int").alias("i"),
                                             F.col("value").cast("double").alias("w")))).alias("e"))
    return g.select("doc_id", F.col("e.i").alias("ids"), F.col("e.w").alias("ws"))


def materialize(v: Vectorized) -> DataFrame:
    """``(doc_id, ids, ws)`` of a vectorizer's result, written once (short lineage for the passes)
    and cached; a lost cache block is read again from the files.  Sparse rows are
    read as they are; only a long matrix without them is grouped by document."""
    rows = doc_major(v.matrix) if v.rows is None else v.rows.select("doc_id", "ids", F.col("values").alias("ws"))
    return stored(rows, "lsa-rows").persist()


def _chunks(batches):
    """Arrow record batches -> (doc_ids, flat term ids, flat weights, row
    starts, row lengths) per chunk of documents, without per-row objects:
    the list columns' offsets and values are read as numpy arrays."""
    for batch in batches:
        for s in range(0, batch.num_rows, _CHUNK_DOCS):
            part = batch.slice(s, _CHUNK_DOCS)
            ids = part.column(part.schema.get_field_index("ids"))
            ws = part.column(part.schema.get_field_index("ws"))
            off = ids.offsets.to_numpy(zero_copy_only=False)
            lens = np.diff(off).astype(np.int64)
            keep = lens > 0
            if not keep.any():
                continue
            fi = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
            fw = ws.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            doc_ids = part.column(part.schema.get_field_index("doc_id")).to_numpy(
                zero_copy_only=False)[keep]
            lens = lens[keep]
            starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
            yield doc_ids, fi, fw, starts, lens


def _gram_pass(D: DataFrame, Z: np.ndarray) -> np.ndarray:
    """One pass: returns X^T X Z (n_terms x l), added from one partial sum a task."""
    n_terms, l = Z.shape
    bz = D.sparkSession.sparkContext.broadcast(np.ascontiguousarray(Z.T))

    def task(batches):
        Zt = bz.value
        acc = np.zeros((l, n_terms))
        for _, fi, fw, starts, lens in _chunks(batches):
            for j in range(l):  # one column at a time: flat arrays, no entry x block copies
                y = np.add.reduceat(fw * Zt[j][fi], starts)
                acc[j] += np.bincount(fi, weights=fw * np.repeat(y, lens), minlength=n_terms)
        return acc.T, 0

    out, _ = summed_partials(D, task, (n_terms, l))
    bz.unpersist()
    return out


def _ritz(Q: np.ndarray, A: np.ndarray, k: int):
    """Rayleigh-Ritz on span(Q), A = X^T X Q: singular values, the top-k right singular
    vectors (rows) and the residuals of the pairs as a share of the largest eigenvalue."""
    G = Q.T @ A
    evals, W = np.linalg.eigh((G + G.T) / 2.0)
    order = np.argsort(evals)[::-1][:k]
    theta, W = np.clip(evals[order], 0.0, None), W[:, order]
    V = Q @ W
    left = np.linalg.norm(A @ W - V * theta, axis=0) / max(theta.max(initial=0.0), 1e-300)
    return np.sqrt(theta), V.T / np.linalg.norm(V, axis=0)[:, None].clip(min=1e-300), left


def _next_block(Q: np.ndarray, A: np.ndarray) -> np.ndarray:
    """Orthonormal directions of A beyond span(Q); none if there are none."""
    R = A
    for _ in range(2):  # once more for what rounding leaves
        R = R - Q @ (Q.T @ R)
    U, sizes, _ = np.linalg.svd(R, full_matrices=False)
    beyond = sizes > 1e-10 * max(np.linalg.norm(A, 2), 1e-300)
    U = U[:, beyond][:, :Q.shape[0] - Q.shape[1]]
    U = U - Q @ (Q.T @ U)
    return np.linalg.qr(U)[0] if U.shape[1] else U


@dataclass
class LsaModel:
    components: np.ndarray        # k x n_terms (rows = topics), sign-fixed
    singular_values: np.ndarray   # k
    n_docs: int
    explained_variance_ratio_sum: float | None = None
    n_passes: int = 0             # passes over the matrix actually made


def fit_lsa(D: DataFrame, n_terms: int, n_docs: int, cfg: TopicConfig) -> LsaModel:
    """Rank-k factorization with the sign rule (largest |loading|
    of each component positive)."""
    fields = dict(D.dtypes)
    if fields.get("ids") != "array<int>" or fields.get("ws") != "array<double>":
        raise TypeError("LSA needs the columns doc_id, ids array<int> and ws array<double>")
    k = cfg.n_topics
    if k > n_terms:
        raise ValueError(f"n_topics={k} exceeds n_features={n_terms}")
    l = min(n_terms, k + cfg.n_oversamples)
    rng = np.random.default_rng(cfg.random_state)
    Z, _ = np.linalg.qr(rng.standard_normal((n_terms, l)))
    Q, A = Z[:, :0], Z[:, :0]
    passes = 0
    while True:
        image = _gram_pass(D, Z)                  # X^T X Z, one pass
        passes += 1
        Q, A = np.hstack([Q, Z]), np.hstack([A, image])
        s, V, left = _ritz(Q, A, k)
        if passes > max(cfg.n_iter, 0) or (left <= cfg.svd_tol).all():
            break
        Z = _next_block(Q, image)
        if not Z.shape[1]:                        # the basis holds all that X^T X reaches
            break
    V /= np.linalg.norm(V, axis=1, keepdims=True).clip(min=1e-300)
    beyond = s <= s.max(initial=0.0) * RANK_TOLERANCE  # k above the rank: no topic, not noise
    s[beyond], V[beyond] = 0.0, 0.0
    idx = np.argmax(np.abs(V), axis=1)
    signs = np.sign(V[np.arange(k), idx])
    signs[signs == 0] = 1.0
    V *= signs[:, None]
    return LsaModel(V, s, n_docs, n_passes=passes)


def doc_coordinates(D: DataFrame, model: LsaModel, normalize: bool = True) -> DataFrame:
    """``(doc_id, topics array<double>)`` = X V (optionally each row
    L2-normalized; zero rows stay zero).  Row-local, V broadcast."""
    spark = D.sparkSession
    bv = spark.sparkContext.broadcast(model.components.T.copy())   # n_terms x k

    def task(batches):
        import pyarrow as pa
        Vt = bv.value
        for doc_ids, fi, fw, starts, _ in _chunks(batches):
            Y = np.add.reduceat(fw[:, None] * Vt[fi], starts, axis=0)
            if normalize:
                nrm = np.linalg.norm(Y, axis=1, keepdims=True)
                Y = np.divide(Y, nrm, out=np.zeros_like(Y), where=nrm > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids.astype(np.int64)), list_column(Y)], ["doc_id", "topics"])

    return D.mapInArrow(task, "doc_id long, topics array<double>")


def explained_variance_ratio(v: Vectorized, model: LsaModel, D: DataFrame | None = None) -> float:
    """Sum over components of var(X v_j) / total feature variance,
    population variances over all n documents (zeros included).  ``D`` are the
    rows of the matrix where they are materialized; they are not made again."""
    n = float(v.n_docs)
    entries = v.matrix if D is None else (
        D.select(F.inline_outer(F.arrays_zip(F.col("ids").alias("term_id"), F.col("ws").alias("value"))))
        .where(F.col("term_id").isNotNull()))
    sums = entries.groupBy("term_id").agg(F.sum("value").alias("s"),
                                           F.sum(F.col("value") * F.col("value")).alias("q"))
    n_terms = model.components.shape[1]
    colsum = np.zeros(n_terms)
    pdf = sums.toPandas()                         # bounded: vocabulary rows
    colsum[pdf["term_id"].to_numpy()] = pdf["s"].to_numpy()
    total = float((pdf["q"] / n - (pdf["s"] / n) ** 2).sum())
    means = model.components @ colsum / n
    explained = model.singular_values ** 2 / n - means ** 2
    return float(explained.sum() / total) if total > 0 else float("nan")


def lsa_topics_frame(spark, model: LsaModel, vocab_df: DataFrame, n_top: int) -> DataFrame:
    """``(topic_id, term_id, term, weight)`` top-n by signed weight.

    The component matrix is model-sized (k x vocabulary); the top-n are taken
    per topic on the driver-side model and joined to the vocabulary."""
    rows = []
    for t, comp in enumerate(model.components):
        if not comp.any():
            continue
        top = np.argsort(comp, kind="stable")[::-1][:n_top]
        rows.extend((t, int(i), float(comp[i])) for i in top)
    top_df = spark.createDataFrame(rows, "topic_id long, term_id int, weight double")
    # k x n_top rows: the broadcast side; the vocabulary is only scanned
    return vocab_df.select("term_id", "term").join(F.broadcast(top_df), "term_id") \
                   .select("topic_id", "term_id", "term", "weight")


def singular_values_frame(spark, model: LsaModel) -> DataFrame:
    return spark.createDataFrame(
        [(i, float(s)) for i, s in enumerate(model.singular_values)],
        "topic_id long, singular_value double")
