from pyspark.sql import functions as F

from tessera.operators import topics as TP

C6 = [
    ('[{"topic_id":3,"terms":[["a",0.5],["b",0.2]]}]', [(3, 1, "a", 0.5), (3, 2, "b", 0.2)]),
    ('[{"id":3,"words":["a","b"]}]', [(3, 1, "a", None), (3, 2, "b", None)]),
    ('[[3,[["a",0.5]]]]', [(3, 1, "a", 0.5)]),
    ('[["a","b","c"]]', [(0, 1, "a", None), (0, 2, "b", None), (0, 3, "c", None)]),
    ('[{"terms":[["x","0.25"],["y","oops"],"z"]}]', [(0, 1, "x", 0.25), (0, 2, "y", None), (0, 3, "z", None)]),
]


def test_topic_shapes(spark):
    for js, expected in C6:
        df = spark.createDataFrame([(js,)], "topics_json string")
        got = sorted(tuple(r) for r in TP.normalize_topics_json(df).collect())
        assert got == sorted(expected), js


def test_empty_topics_give_nothing(spark):
    df = spark.createDataFrame([("[]",)], "topics_json string")
    assert TP.normalize_topics_json(df).count() == 0


def test_rank_overview_comparison(spark):
    rows = [(0, "a", 0.5), (0, "b", 0.7), (0, "c", 0.7), (1, "d", 0.1)]
    df = spark.createDataFrame(rows, "topic_id long, term string, weight double")
    ranked = TP.rank_terms(df, 2)
    got = sorted((r.topic_id, r.rank, r.term) for r in ranked.collect())
    assert got == [(0, 1, "c"), (0, 2, "b"), (1, 1, "d")]
    long = TP.topic_terms_long(ranked, "m1")
    ov = TP.topic_overview(long, 10).collect()
    assert [(r.method, r.topic_id, r.top_10_terms) for r in ov] == [("m1", 0, "c, b"), ("m1", 1, "d")]
    assert TP.topics_comparison([None, None]) is None
    both = TP.topics_comparison([TP.topic_overview(long, 10), None,
                                 TP.topic_overview(TP.topic_terms_long(ranked, "m2"), 10)])
    assert both.count() == 4


def test_comparison_reads_existing_overviews(spark):
    import tempfile

    from tessera.sources import sinks as SK
    out = tempfile.mkdtemp(prefix="tessera-ov-")
    rows = [(0, "a", 0.5), (0, "b", 0.7), (1, "d", 0.1)]
    long = TP.topic_terms_long(TP.rank_terms(
        spark.createDataFrame(rows, "topic_id long, term string, weight double"), 15), "lda_bow")
    TP.topic_overview(long).coalesce(1).write.option("header", True).csv(f"{out}/topics_overview_lda_bow")
    got = SK.load_comparison_overview(spark, out, ["lda_bow", "lsa_tfidf"])
    assert sorted((r.method, r.topic_id, r.top_10_terms) for r in got.collect()) == \
        [("lda_bow", 0, "b, a"), ("lda_bow", 1, "d")]
    assert SK.load_comparison_overview(spark, out, ["nothing"]) is None


def test_two_pair_topic_is_not_an_id_pair(spark):
    js = '[[["a", 0.5], ["b", 0.2]]]'
    df = spark.createDataFrame([(js,)], "topics_json string")
    got = sorted(tuple(r) for r in TP.normalize_topics_json(df).collect())
    assert got == [(0, 1, "a", 0.5), (0, 2, "b", 0.2)]
