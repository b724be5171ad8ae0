import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.config import TopicConfig, VectorizeConfig
from tessera.operators import lda as LD
from tessera.operators import lsa as LS
from tessera.operators import topics as TP
from tessera.operators import vectorize as V

C5 = [(0, "loan loan bank"), (1, "bank card fee"), (2, "card card card loan"), (3, "")]


def tfidf_c5(spark):
    df = spark.createDataFrame(C5, "doc_id long, text string")
    return V.vectorize_with_tfidf(df, "text", VectorizeConfig(max_features=None, ngram_range=(1, 1), min_df=1))


def test_lsa_matches_fixture(spark):
    tf = tfidf_c5(spark)
    D = LS.doc_major(tf.matrix)
    m = LS.fit_lsa(D, tf.vocab.size, tf.n_docs, TopicConfig(n_topics=2, n_iter=7))
    assert m.singular_values == pytest.approx([1.322383, 0.863192], abs=1e-6)
    assert m.components[0] == pytest.approx([0.431192, 0.659399, 0.294197, 0.541031], abs=1e-6)
    assert m.components[1] == pytest.approx([0.147872, -0.509375, -0.424507, 0.733801], abs=1e-6)
    coords = {r.doc_id: r.topics for r in LS.doc_coordinates(D, m, normalize=False).collect()}
    assert coords[0] == pytest.approx([0.685127, 0.707029], abs=1e-6)
    assert coords[1] == pytest.approx([0.770522, -0.473732], abs=1e-6)
    assert coords[2] == pytest.approx([0.828006, -0.144183], abs=1e-6)
    unit = LS.doc_coordinates(D, m, normalize=True).collect()
    assert all(abs(np.linalg.norm(r.topics) - 1.0) < 1e-9 for r in unit)
    assert LS.explained_variance_ratio(tf, m) == pytest.approx(0.701593, abs=1e-6)


def test_lsa_against_numpy(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = emb.select("vec_id", "embedding").collect()
    X = np.array([r.embedding for r in rows], dtype=float)
    long = spark.createDataFrame(
        [(int(r.vec_id), j, f"t{j:02d}", float(v)) for r in rows for j, v in enumerate(r.embedding)],
        "doc_id long, term_id int, term string, value double")
    # a flat spectrum converges slowly: more oversampling and power steps
    m = LS.fit_lsa(LS.doc_major(long), X.shape[1], X.shape[0],
                   TopicConfig(n_topics=5, n_iter=25, n_oversamples=40))
    s = np.linalg.svd(X, compute_uv=False)[:5]
    assert m.singular_values == pytest.approx(s, rel=1e-5)
    V_ = m.components
    assert np.allclose(V_ @ V_.T, np.eye(5), atol=1e-8)
    assert all(abs(c).argmax() == c.argmax() for c in V_)


def planted(spark):
    rng = np.random.default_rng(42)
    vocabs = [[f"{p}{chr(97 + i)}" for i in range(20)] for p in ("alpha", "beta", "gamma")]
    rows = []
    for d in range(60):
        v = vocabs[d % 3]
        rows.append((d, " ".join(rng.choice(v, 30))))
    return spark.createDataFrame(rows, "doc_id long, text string"), vocabs


def _topics_pure(terms_long, vocabs, k):
    for t in range(k):
        top = [r.term for r in terms_long.filter(F.col("topic_id") == t).filter("rank <= 10").collect()]
        prefixes = {x[:-1] for x in top}
        if len(prefixes) != 1:
            return False
    return True


def test_planted_topics_lsa_and_lda(spark):
    docs, vocabs = planted(spark)
    cfg = VectorizeConfig(max_features=None, ngram_range=(1, 1), min_df=1)
    tf = V.vectorize_with_tfidf(docs, "text", cfg)
    tc = TopicConfig(n_topics=3, n_top_terms=10, n_iter=20)
    m = LS.fit_lsa(LS.doc_major(tf.matrix), tf.vocab.size, tf.n_docs, tc)
    lsa_terms = TP.rank_terms(LS.lsa_topics_frame(spark, m, tf.vocab.table, 10), 10)
    # LSA's first component is shared; the later ones separate the groups
    assert lsa_terms.count() == 30

    bow = V.vectorize_with_bow(docs, "text", cfg)
    terms = V.doc_terms(docs, "text", cfg, V.BOW_PATTERN)
    vectors = LD.count_vectors(terms, bow.vocab)
    model = LD.fit_lda(vectors, tc, bow.n_docs)
    lda_terms = TP.rank_terms(LD.top_terms(model, bow.vocab, 10), 10)
    assert _topics_pure(lda_terms, vocabs, 3)
    dt = LD.doc_topic(model, vectors, 3).collect()
    assert all(abs(sum(r.topics) - 1.0) < 1e-6 for r in dt)
    ranks = lda_terms.groupBy("topic_id").agg(F.collect_list("rank").alias("r")).collect()
    assert all(sorted(r.r) == list(range(1, 11)) for r in ranks)


def test_lda_empty_doc_is_uniform(spark):
    docs = spark.createDataFrame([(0, "aa bb aa"), (1, "aa bb cc"), (2, "zz")], "doc_id long, text string")
    cfg = VectorizeConfig(max_features=None, ngram_range=(1, 1), min_df=2)
    bow = V.vectorize_with_bow(docs, "text", cfg)
    vectors = LD.count_vectors(V.doc_terms(docs, "text", cfg), bow.vocab)
    model = LD.fit_lda(vectors, TopicConfig(n_topics=2, n_iter=5), 3)
    dt = {r.doc_id: r.topics for r in LD.doc_topic(model, vectors, 2).collect()}
    assert dt[2] == [0.5, 0.5]


def test_lda_weights_filled_and_seed_deterministic(spark):
    docs, _ = planted(spark)
    cfg = VectorizeConfig(max_features=None, ngram_range=(1, 1), min_df=1)
    bow = V.vectorize_with_bow(docs, "text", cfg)
    vectors = LD.count_vectors(V.doc_terms(docs, "text", cfg), bow.vocab)
    tc = TopicConfig(n_topics=3, n_top_terms=5, n_iter=5)
    m1 = LD.fit_lda(vectors, tc, bow.n_docs)
    m2 = LD.fit_lda(vectors, tc, bow.n_docs)
    assert np.allclose(m1.topicsMatrix().toArray(), m2.topicsMatrix().toArray())
    terms = TP.rank_terms(LD.top_terms(m1, bow.vocab, 5), 5).collect()
    by_topic = {}
    for r in sorted(terms, key=lambda r: (r.topic_id, r.rank)):
        assert r.weight is not None and r.weight > 0
        by_topic.setdefault(r.topic_id, []).append(r.weight)
    assert all(w == sorted(w, reverse=True) for w in by_topic.values())


def test_lsa_beyond_the_rank_gives_no_noise(spark):
    D = spark.createDataFrame([(1, [0, 1], [1.0, 1.0]), (2, [2, 3], [0.6, 0.8])],
                              "doc_id long, ids array<int>, ws array<double>")
    model = LS.fit_lsa(D, 4, 2, TopicConfig(n_topics=4, n_iter=5))
    assert (model.singular_values[:2] > 0.9).all() and not model.singular_values[2:].any()
    assert not model.components[2:].any()
    with pytest.raises(TypeError):
        LS.fit_lsa(D.drop("ws"), 4, 2, TopicConfig(n_topics=2))


def test_krylov_meets_the_spectrum_in_few_passes(spark):
    rng = np.random.default_rng(3)
    left, _ = np.linalg.qr(rng.standard_normal((400, 120)))
    right, _ = np.linalg.qr(rng.standard_normal((150, 120)))
    s = np.r_[20.0, 15.0, 11.0, 9.0, np.linspace(6, 4, 116)]  # a slowly falling rest
    X = left * s @ right.T
    D = spark.createDataFrame([(i, list(range(150)), r.tolist()) for i, r in enumerate(X)],
                              "doc_id long, ids array<int>, ws array<double>").repartition(3).checkpoint()
    model = LS.fit_lsa(D, 150, 400, TopicConfig(n_topics=4))
    assert model.n_passes <= 8
    assert model.singular_values == pytest.approx(s[:4], rel=1e-6)
    assert np.allclose(np.abs(np.sum(model.components * right[:, :4].T, axis=1)), 1.0, atol=1e-6)
    whole = LS.fit_lsa(D, 150, 400, TopicConfig(n_topics=120))
    assert whole.singular_values == pytest.approx(s, rel=1e-9)


def test_online_lda_reads_every_document_once_a_pass(spark):
    docs, vocabs = planted(spark)
    docs = docs.unionByName(spark.createDataFrame([(60, "zz"), (61, None)], "doc_id long, text string"))
    cfg = VectorizeConfig(max_features=None, ngram_range=(1, 1), min_df=2)
    bow = V.vectorize_with_bow(docs, "text", cfg)
    tc = TopicConfig(n_topics=3, n_top_terms=10, n_iter=10, learning_method="online")
    model = LD.fit_lda(bow.rows, tc, bow.n_docs, n_terms=bow.vocab.size)
    lots = len({lot for lot, _, _ in model.steps})
    assert 1 < lots <= tc.mini_batches and len(model.steps) == 10 * lots
    for p in range(10):
        part = model.steps[p * lots:(p + 1) * lots]
        assert len({lot for lot, _, _ in part}) == lots and sum(read for _, _, read in part) == 62
    assert [step for _, step, _ in model.steps] == pytest.approx([(10 + t) ** -0.7 for t in range(10 * lots)])
    terms = TP.rank_terms(LD.top_terms(model, bow.vocab, 10), 10)
    assert _topics_pure(terms, vocabs, 3)
    again = LD.fit_lda(bow.rows.repartition(5), tc, bow.n_docs, n_terms=bow.vocab.size)
    assert np.allclose(model.components, again.components)
    weights = {r.doc_id: r.topics for r in LD.doc_topic(model, bow.rows, 3).collect()}
    assert weights[60] == weights[61] == pytest.approx([1 / 3] * 3)


def test_settled_documents_do_not_depend_on_their_block():
    rng = np.random.default_rng(5)
    topics = rng.random((4, 50))
    docs = [(rng.choice(50, n, replace=False), rng.integers(1, 9, n).astype(float)) for n in (3, 40, 1, 17, 25)]
    together = LD._fit_block(np.repeat(np.arange(5), [len(t) for t, _ in docs]), np.concatenate([t for t, _ in docs]),
                             np.concatenate([c for _, c in docs]), 5, topics, 0.25)
    at = 0
    for i, (t, c) in enumerate(docs):
        gamma, share = LD._fit_block(np.zeros(len(t), dtype=int), t, c, 1, topics, 0.25)
        assert np.allclose(gamma[:, 0], together[0][:, i])
        assert np.allclose(share, together[1][:, at:at + len(t)])
        at += len(t)


def test_sparse_rows_equal_the_long_matrix(spark):
    docs = spark.createDataFrame(C5 + [(4, None), (4, "loan loan"), (None, "fee")], "doc_id long, text string")
    for kw in ({}, {"norm": "l1"}, {"norm": None, "sublinear_tf": False}, {"use_idf": False}, {"smooth_idf": False}):
        cfg = VectorizeConfig(max_features=3, ngram_range=(1, 1), min_df=1, **kw)
        v = V.vectorize_with_tfidf(docs, "text", cfg)
        long = V.tfidf_matrix(V.term_frequencies(V.doc_terms(docs.where("text != 'loan loan' OR doc_id != 4"), "text", cfg, V.WORD_PATTERN)),
                              v.vocab, cfg)
        want = {(r.doc_id, r.term): r.value for r in long.collect()}
        got = {(r.doc_id, r.term): r.value for r in v.matrix.where("doc_id IS NULL OR doc_id != 4").collect()}
        assert got == pytest.approx({k: x for k, x in want.items() if k[0] != 4})
        assert v.rows.count() == docs.count()
    with pytest.raises(ValueError):
        V.count_rows(V.doc_terms(docs, "text", cfg), V.Vocabulary(v.vocab.table, 7, 10**9, n_bytes=10**12))
