"""Partial sums of a pass, and the fit of documents in padded lots."""

import math
import time

import numpy as np
import pyarrow as pa

from tessera.operators import lda as LD
from tessera.operators import partials as P


def test_partial_sums_are_added_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_ROWS", 4)

    def partial(batches):
        total, n = np.zeros((10, 3)), 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            n += len(ids)
            np.add.at(total, (ids % 7, ids % 3), ids + 0.5)
        return total, n

    got, n = P.summed_partials(spark.range(0, 1000, 1, 9), partial, (10, 3))
    ids, want = np.arange(1000), np.zeros((10, 3))
    np.add.at(want, (ids % 7, ids % 3), ids + 0.5)
    assert n == 1000 and np.allclose(got, want)
    none, n = P.summed_partials(spark.range(0), partial, (10, 3))
    assert n == 0 and not none.any()


def test_passes_leave_no_shuffle_files(spark):
    def files():
        return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    def partial(batches):
        return np.ones((10, 3)), sum(len(b) for b in batches)

    before, rows = spark.conf.get(P.SHUFFLE_CLEANUP), spark.range(0, 100, 1, 9)
    P.summed_partials(rows, partial, (10, 3))
    first = files()
    for _ in range(5):
        assert P.summed_partials(rows, partial, (10, 3))[0].tolist() == [[9.0] * 3] * 10
    until = time.time() + 20
    while files() > first and time.time() < until:  # they are removed behind the query
        time.sleep(0.2)
    assert files() <= first and spark.conf.get(P.SHUFFLE_CLEANUP) == before


def test_sums_of_a_task_hold_one_row_a_block():
    cells = np.arange(4.0).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([0, 2, 0]), pa.array([1, 0, 1]), pa.array([cells] * 3, pa.binary())],
                                       names=["block", "rows", "cells"])
    (out,) = P._add(iter([batch, batch]))
    assert dict(zip(out["block"].to_pylist(), out["rows"].to_pylist())) == {0: 4, 2: 0}
    assert np.frombuffer(out["cells"][0].as_py()).tolist() == [0, 4, 8, 12]


def test_model_sized_sums_grow_slower_than_documents():
    # a task a 1 024 documents shuffled 500 sums of the model's size a pass at 512 000 documents
    assert LD._tasks(0) == 1 and LD._tasks(9_292) == 10
    assert LD._tasks(512_000) <= 80 and LD._tasks(3_000_000) <= 256
    assert LD._tasks(10**12) == LD.PARTIAL_TASKS


def _by_hand(terms, counts, topics, alpha):
    """One document, one entry at a time."""
    gamma = np.ones(len(topics))
    for _ in range(LD.DOC_PASSES):
        factor = np.exp([_psi(g) - _psi(gamma.sum()) for g in gamma])
        new = alpha + sum(c * factor * topics[:, t] / (factor @ topics[:, t]) for t, c in zip(terms, counts))
        moved, gamma = np.abs(new - gamma).mean(), new
        if moved < LD.DOC_TOLERANCE:
            break
    return gamma


def _psi(x):
    return (math.lgamma(x + 1e-4) - math.lgamma(x - 1e-4)) / 2e-4


def test_padded_lots_fit_every_document_as_alone(monkeypatch):
    monkeypatch.setattr(LD, "LOT_ENTRIES", 40)
    rng = np.random.default_rng(8)
    topics = rng.random((3, 200)) + 0.01
    sizes = [1, 30, 31, 2, 150, 9, 9, 10, 44]
    docs = [(rng.choice(200, n, replace=False), rng.integers(1, 6, n).astype(float)) for n in sizes]
    of = np.repeat(np.arange(1, 10), sizes)  # document 0 has no term
    lots = list(LD._lots(np.array(sizes)))
    assert sorted(np.concatenate(lots).tolist()) == list(range(9)) and len(lots) > 3
    gamma, share = LD._fit_block(of, np.concatenate([t for t, _ in docs]), np.concatenate([c for _, c in docs]), 10, topics, 0.2)
    assert gamma[:, 0].tolist() == [0.2] * 3
    for i, (t, c) in enumerate(docs):
        assert np.allclose(gamma[:, i + 1], _by_hand(t, c, topics, 0.2), atol=1e-4)
    # a count is dealt out over the topics whole
    assert np.allclose((share * topics[:, np.concatenate([t for t, _ in docs])]).sum(axis=0), np.concatenate([c for _, c in docs]))


def test_a_few_documents_of_many_sizes_make_few_lots():
    sizes = np.unique(np.geomspace(1, 3000, 60).astype(int))
    lots = list(LD._lots(np.random.default_rng(2).permutation(sizes)))
    assert len(lots) <= 6  # a quarter between sizes alone made 18
    for lot, ordered in zip(lots, np.split(np.sort(sizes), np.cumsum([len(x) for x in lots])[:-1])):
        padded = len(lot) * int(ordered.max())
        assert padded <= LD.LOT_ENTRIES and (padded - ordered.sum() <= LD.SPARE_ENTRIES or ordered.max() <= 1.25 * ordered.min() + 8)
    assert [len(x) for x in LD._lots(np.array([10 * LD.LOT_ENTRIES, 1, 1]))] == [2, 1]


def test_digamma():
    x = np.array([0.01, 0.1, 1.0, 2.5, 6.0, 40.0, 1e6])
    assert np.allclose(LD.digamma(x), [-100.56088545786867, -10.423754940411076, -0.5772156649015329, 0.7031566406452432,
                                       1.7061176684318005, 3.676327374034521, 13.815510057964274])


def test_packed_blocks_hold_every_entry_once(spark):
    rows = spark.createDataFrame([(i, list(range(i % 5)), [1.0 + j for j in range(i % 5)], i // 10) for i in range(40)],
                                 "doc_id long, ids array<int>, values array<double>, lot int").coalesce(1)
    blocks = LD.packed(rows).collect()
    assert [b["lot"] for b in blocks] == [0, 1, 2, 3]  # no block of two lots
    for b in blocks:
        assert np.frombuffer(b["sizes"], dtype=np.int32).tolist() == [i % 5 for i in range(10)]
        assert np.frombuffer(b["terms"], dtype=np.int32).tolist() == [j for i in range(10) for j in range(i % 5)]
        assert np.frombuffer(b["counts"]).tolist() == [1.0 + j for i in range(10) for j in range(i % 5)]
    topics = np.random.default_rng(1).random((3, 5)) + 0.01
    counts, read = LD._expected_counts(LD.packed(rows.drop("lot")), topics, 0.2)
    assert read == 40
    assert np.allclose((counts * topics).sum(axis=0), [sum(1.0 + j for i in range(40) if j < i % 5) for j in range(5)])


def test_single_precision_rounds_fit_as_double_ones(monkeypatch):
    rng = np.random.default_rng(3)
    topics = LD._expected_logs(rng.gamma(0.3, 50.0, (10, 400)) + 0.1)
    sizes = rng.integers(1, 300, 60)
    terms = np.concatenate([rng.choice(400, n, replace=False) for n in sizes])
    counts = rng.integers(1, 9, len(terms)).astype(float)
    counts[-sizes[-1]:] *= 1000  # too many words for single precision
    args = np.repeat(np.arange(60), sizes), terms, counts, 60, topics, 0.1
    seen, fit = set(), LD._fit_lot
    monkeypatch.setattr(LD, "_fit_lot", lambda entry, *a: seen.add(entry.dtype.name) or fit(entry, *a))
    gamma, share = LD._fit_block(*args)
    assert seen == {"float32", "float64"}
    assert np.allclose((share * topics[:, terms]).sum(axis=0), counts, rtol=1e-12)
    seen.clear()
    monkeypatch.setattr(LD, "SINGLE_TOPICS", 0)
    exact, _ = LD._fit_block(*args)
    assert seen == {"float64"} and np.abs(gamma - exact).mean() < LD.DOC_TOLERANCE


def test_exp_digamma():
    x = np.array([0.01, 0.1, 1.0, 2.5, 6.0, 40.0, 1e6])
    assert np.allclose(LD._exp_digamma(x), np.exp(LD.digamma(x)), rtol=1e-12, atol=0)
