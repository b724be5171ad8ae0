"""Terms counted in blocks of texts against the counts of one row a term and document."""
import pickle
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest

from tessera.config import VectorizeConfig
from tessera.operators import text_counts as TC
from tessera.operators import vectorize as V
from tessera.plans import queries as Q

SF = "/root/testdata/sf0.001"
ODD = [(None, None), (5, ""), (6, "naïve été aa bb aa x 9y_ zz"), (6, "ab\nab cd"), (7, "  aa   bb "), (8, "Ünï ab\n"), (9, "q"),
       (10, "aa aa aa aa"), (11, "bb aa bb aa")]


@pytest.fixture(scope="module")
def docs(spark):
    few = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return few.unionByName(spark.createDataFrame(ODD, "doc_id long, text string")).repartition(3).checkpoint()


def _table(vocab):
    return [tuple(r) for r in vocab.table.orderBy("term_id").collect()]


@pytest.mark.parametrize("pattern, kw", [
    (V.BOW_PATTERN, dict(max_features=300, min_df=2)), (V.WORD_PATTERN, dict(max_features=300, min_df=2, lowercase=True)),
    (V.WORD_PATTERN, dict(max_features=None, min_df=3, ngram_range=(2, 2))), (V.BOW_PATTERN, dict(max_features=0, min_df=1)),
    (V.BOW_PATTERN, dict(max_features=100, min_df=2, binary=True)), (V.WORD_PATTERN, dict(max_features=None, min_df=1, ngram_range=(1, 1)))])
def test_vocabulary_of_texts_is_that_of_term_rows(docs, pattern, kw):
    cfg = VectorizeConfig(**{"ngram_range": (1, 2)} | kw)
    want = V.fit_vocabulary(V.term_frequencies(V.doc_terms(docs, "text", cfg, pattern), cfg.binary).checkpoint(), 999, cfg)
    assert _table(V.fit_vocabulary_of_text(docs, "text", 999, cfg, pattern)) == _table(want)


@pytest.mark.parametrize("guess", [1, 10**9])
def test_a_wrong_guess_of_the_last_count_changes_nothing(docs, monkeypatch, guess):
    cfg = VectorizeConfig(max_features=200, min_df=2, ngram_range=(1, 2))
    want = _table(V.fit_vocabulary_of_text(docs, "text", 999, cfg))
    monkeypatch.setattr(V, "_guessed_cut", lambda *a: guess)
    assert _table(V.fit_vocabulary_of_text(docs, "text", 999, cfg)) == want


def _rows(df):
    return sorted((str(r.doc_id), list(r.ids), [round(v, 8) for v in r["values"]]) for r in df.collect())


def test_rows_of_texts_are_those_of_their_terms(spark, docs):
    cfg = VectorizeConfig(max_features=300, min_df=2, ngram_range=(1, 2), sublinear_tf=True)
    vocab = V.fit_vocabulary_of_text(docs, "text", 999, cfg)
    terms = V.doc_terms(docs, "text", cfg)
    rows = V.text_rows(docs, "text", vocab, cfg)
    assert _rows(rows) == _rows(V.count_rows(terms, vocab))
    assert _rows(V.text_rows(docs, "text", vocab, replace(cfg, binary=True))) == _rows(V.count_rows(terms, vocab, True))
    for norm in ("l2", "l1", None):
        one = replace(cfg, norm=norm, sublinear_tf=norm != "l1")
        assert _rows(V.weighted_rows(rows, vocab, one)) == _rows(V.tfidf_rows(terms, vocab, one))
    mine = V.vocabulary_from_terms(spark, ["aa bb", "aa", "a b c", "no", "bb  aa", ""])
    assert _rows(V.text_rows(docs, "text", mine, cfg)) == _rows(V.count_rows(terms, mine))
    none = V.vocabulary_from_terms(spark, {})
    assert {tuple(r.ids) for r in V.text_rows(docs, "text", none, cfg).collect()} == {()}


def test_small_blocks_hold_the_same_terms(monkeypatch):
    texts = ["aa bb aa", "", "cc aa bb", None, "bb", "aa  bb x"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array([None, None, None, ["a_", "aa", "a_", "aa"], None, None], pa.list_(pa.string()))], names=["plain", "tokens"])

    def counted():
        out = {}
        for block in TC.term_blocks(iter([batch]), 1, 2):
            for term, tf in zip(TC.term_strings(block, np.arange(len(block.a))).to_pylist(), block.tf.tolist()):
                out.setdefault(term, []).append(tf)
        return {t: sorted(n) for t, n in out.items()}

    want = {"aa": [1, 1, 2, 2], "bb": [1, 1, 1, 1], "cc": [1], "a_": [2], "aa bb": [1, 1, 1], "bb aa": [1], "cc aa": [1],
            "a_ aa": [2], "aa a_": [1]}
    assert counted() == want
    monkeypatch.setattr(TC, "BLOCK_BYTES", 4)
    assert counted() == want


def test_hashes_depend_on_the_words_alone():
    words = pa.array(["aa", "", "bb", "ab", "ba", "é" * 5000, "zz"])
    hashes = TC.word_hashes(words)
    assert len(set(hashes.tolist())) == len(words)
    assert TC.word_hashes(words.slice(3)).tolist() == hashes[3:].tolist()
    assert TC.word_hashes(words.take(pa.array([5, 0]))).tolist() == hashes[[5, 0]].tolist()


def test_what_is_broadcast_needs_no_package_to_be_read():
    assert b"tessera" not in pickle.dumps(TC.term_index(["aa", "aa bb"], 1, 2))


def test_sums_by_language_keep_every_value(spark):
    rows = spark.createDataFrame([(None, [0, 2], [1.0, 2.0]), ("en", [2], [4.0]), ("en", [0, 2], [8.0, 16.0]), ("de", [], [])],
                                 "lang string, ids array<int>, values array<double>")
    got = {(r.lang, r.term_id): r.weight for r in V.summed_terms(rows, "lang", 3).collect()}
    assert got == {(None, 0): 1.0, (None, 2): 2.0, ("en", 2): 20.0, ("en", 0): 8.0}


def test_topics_by_language_make_no_row_a_term_and_document(spark, monkeypatch):
    def refuse(*a, **kw):
        raise AssertionError("a row for every term of every document")

    monkeypatch.setattr(Q, "_MEMO", {})
    for name in ("term_frequencies", "long_counts"):
        monkeypatch.setattr(V, name, refuse)
    got = Q.q_topics_comparison_by_lang(spark, SF).collect()
    assert len(got) == 2 * len({r.topic_id for r in got}) > 2
