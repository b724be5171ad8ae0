import math

import pytest
from pyspark.sql import functions as F

from tessera.config import VectorizeConfig
from tessera.functions import text as T
from tessera.operators import stats as ST
from tessera.operators import vectorize as V
from tessera.sources import sinks as SK

C5 = [(0, "loan loan bank"), (1, "bank card fee"), (2, "card card card loan"), (3, "")]


def corpus(spark):
    return spark.createDataFrame(C5, "doc_id long, text string")


def test_token_patterns(spark):
    df = spark.createDataFrame([("Hello abc1 don't hello",)], "t string")
    r = df.select(T.bow_tokens("t").alias("b"), T.tfidf_tokens("t").alias("w")).first()
    assert r.b == ["don", "hello"]
    assert r.w == ["Hello", "abc1", "don", "hello"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["x"],), (["xx", "yy", "zz"],), ([],)], "a array<string>")
    got = [r.g for r in df.select(T.ngrams("a", 1, 2).alias("g")).collect()]
    assert got == [["x"], ["xx", "yy", "zz", "xx yy", "yy zz"], []]
    only2 = [r.g for r in df.select(T.ngrams("a", 2, 2).alias("g")).collect()]
    assert only2 == [[], ["xx yy", "yy zz"], []]


def test_term_counts_in_row(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b", "c", "b"]), (2, [])], "doc_id long, terms array<string>")
    got = sorted((r.doc_id, r.term, r.tf) for r in V.term_frequencies(df).collect())
    assert got == [(1, "a", 1), (1, "b", 3), (1, "c", 1)]


def test_df_ctf_vocab(spark):
    cfg = VectorizeConfig(max_features=None, ngram_range=(1, 1), min_df=1)
    bow = V.vectorize_with_bow(corpus(spark), "text", cfg)
    st = {r.term: (r.df, r.ctf) for r in bow.vocab.table.collect()}
    assert st == {"bank": (2, 2), "card": (2, 4), "fee": (1, 1), "loan": (2, 3)}
    assert [r.term for r in bow.vocab.table.orderBy("term_id").collect()] == ["bank", "card", "fee", "loan"]
    capped = V.vectorize_with_bow(corpus(spark), "text",
                                  VectorizeConfig(max_features=2, ngram_range=(1, 1), min_df=2))
    assert [(r.term_id, r.term) for r in capped.vocab.table.orderBy("term_id").collect()] == \
        [(0, "card"), (1, "loan")]


def test_bow_stats_and_means(spark):
    cfg = VectorizeConfig(max_features=None, ngram_range=(1, 1), min_df=1)
    bow = V.vectorize_with_bow(corpus(spark), "text", cfg)
    s = ST.matrix_stats(bow, "BoW").first()
    assert (s.n_rows, s.n_cols, s.nnz) == (4, 4, 7)
    assert s.line == "BoW: shape=(4, 4), nnz=7, density=0.437500, mean_weight=1.428571"
    means = {r.term: r.mean_weight for r in ST.term_mean_weight(bow).collect()}
    assert means == pytest.approx({"bank": 0.5, "card": 1.0, "fee": 0.25, "loan": 0.75})


def test_idf_and_tfidf_values(spark):
    cfg = VectorizeConfig(max_features=None, ngram_range=(1, 1), min_df=1)
    tf = V.vectorize_with_tfidf(corpus(spark), "text", cfg)
    idf = {r.term: r.idf for r in tf.vocab.table.collect()}
    assert idf["bank"] == pytest.approx(1.510826, abs=1e-6)
    assert idf["fee"] == pytest.approx(1.916291, abs=1e-6)
    plain = {r.term: r.v for r in tf.vocab.table.select(
        "term", V.idf_expr("df", 4, True, False).alias("v")).collect()}
    assert plain["card"] == pytest.approx(1.693147, abs=1e-6)
    assert plain["fee"] == pytest.approx(2.386294, abs=1e-6)
    m = {(r.doc_id, r.term): r.value for r in tf.matrix.collect()}
    exp = {(0, "bank"): 0.508542, (0, "loan"): 0.861037, (1, "bank"): 0.526405,
           (1, "card"): 0.526405, (1, "fee"): 0.667679, (2, "card"): 0.902750,
           (2, "loan"): 0.430165}
    assert set(m) == set(exp)
    for k, v in exp.items():
        assert m[k] == pytest.approx(v, abs=1e-6)
    s = ST.matrix_stats(tf, "TF-IDF").first()
    assert s.mean_weight == pytest.approx(0.631855, abs=1e-6)
    assert ST.feature_variance_total(tf).first()[0] == pytest.approx(0.423337, abs=1e-6)


def test_l1_norm_and_zero_rows(spark):
    cfg = VectorizeConfig(max_features=None, ngram_range=(1, 1), min_df=1, norm="l1")
    tf = V.vectorize_with_tfidf(corpus(spark), "text", cfg)
    sums = {r.doc_id: r.s for r in tf.matrix.groupBy("doc_id").agg(F.sum("value").alias("s")).collect()}
    assert all(math.isclose(v, 1.0) for v in sums.values())
    assert 3 not in sums and tf.n_docs == 4


def test_binary_ranks_by_df(spark):
    docs = spark.createDataFrame([(0, "aa aa aa aa bb"), (1, "bb cc"), (2, "cc dd")], "doc_id long, text string")
    cfg = VectorizeConfig(max_features=2, ngram_range=(1, 1), min_df=1, binary=True)
    bow = V.vectorize_with_bow(docs, "text", cfg)
    assert sorted(r.term for r in bow.vocab.table.collect()) == ["bb", "cc"]
    assert {r.value for r in bow.matrix.collect()} == {1.0}


def test_fixed_vocabulary_ignores_unknown(spark):
    vocab = V.vocabulary_from_terms(spark, ["card", "loan"])
    bow = V.vectorize_with_bow(corpus(spark), "text", VectorizeConfig(ngram_range=(1, 1)), vocabulary=vocab)
    assert sorted((r.doc_id, r.term, r.value) for r in bow.matrix.collect()) == \
        [(0, "loan", 2.0), (1, "card", 1.0), (2, "card", 3.0), (2, "loan", 1.0)]
    tf = V.vectorize_with_tfidf(corpus(spark), "text", VectorizeConfig(ngram_range=(1, 1)), vocabulary=vocab)
    assert tf.matrix.count() == 4


def test_strip_accents(spark):
    df = spark.createDataFrame([("Café Ærø naïve",)], "t string")
    r = df.select(T.strip_accents("t", "unicode").alias("u"), T.strip_accents("t", "ascii").alias("a")).first()
    assert r.u == "Cafe Ærø naive"
    assert r.a == "Cafe r naive"


def test_empty_vocabulary_density_is_null(spark):
    docs = spark.createDataFrame([(0, "aa bb"), (1, "cc dd")], "doc_id long, text string")
    bow = V.vectorize_with_bow(docs, "text", VectorizeConfig(ngram_range=(1, 1), min_df=2))
    s = ST.matrix_stats(bow, "BoW").first()
    assert (s.n_cols, s.nnz, s.density, s.mean_weight) == (0, 0, None, 0.0)


def test_vocabulary_cut_with_ties(spark):
    rows = [(f"t{i:03d}", 1 + i % 3, [1, 2, 3, 5, 5, 5, 9, 70][i % 8]) for i in range(160)]
    df = spark.createDataFrame(rows, "term string, df long, ctf long").repartition(5)
    for cap in (0, 1, 19, 20, 21, 75, 100, 106, 107, 500):
        want = sorted((r for r in rows if r[1] >= 2), key=lambda r: (-r[2], r[0]))[:cap]
        got = V.select_vocabulary(df, 2, cap).collect()
        assert sorted(tuple(r) for r in got) == sorted(want), cap


def test_sketch_sums_every_cell(spark):
    tf = spark.range(3000).selectExpr("id AS doc_id", "concat('t', pmod(id * id, 700)) AS term", "1 + pmod(id, 4) AS tf").repartition(3)
    cells = [F.struct(V._cells(r).alias("cell"), "tf") for r in range(V.SKETCH_ROWS)]
    want = {r.cell: (r.df, r.ctf) for r in tf.select(F.inline(F.array(*cells))).groupBy("cell").agg(
        F.count("*").alias("df"), F.sum("tf").alias("ctf")).collect()}
    got = V.sketch(tf)
    assert got.shape == (V.SKETCH_ROWS * V.SKETCH_CELLS, 2)
    assert {int(c): tuple(got[c]) for c in got.any(axis=1).nonzero()[0]} == want
    assert not V.sketch(tf.where("tf > 9")).any()


def test_metadata_keeps_types(spark):
    docs = spark.createDataFrame([(1, "a bb cc"), (2, "bb dd")], "doc_id long, t string")
    cfg = VectorizeConfig(max_features=10, min_df=1)
    meta = SK.vectorization_meta(V.vectorize_with_tfidf(docs, "t", cfg)).first()["vectorizer_params"].asDict()
    assert meta["max_features"] == 10 and meta["ngram_range"] == [1, 2] and meta["sublinear_tf"] is True
    assert meta["norm"] == "l2" and meta["strip_accents"] is None and meta["dtype"] == "float32"
    bow = SK.vectorization_meta(V.vectorize_with_bow(docs, "t", cfg)).first()["vectorizer_params"].asDict()
    assert "norm" not in bow and bow["binary"] is False and bow["token_pattern"] == r"(?u)\b[a-z]{2,}\b"
