"""Plan-shape checks (the scale properties the design relies on)."""
from pyspark.sql import functions as F

from tessera.config import CleanConfig, VectorizeConfig
from tessera.operators import clean as C
from tessera.operators import vectorize as V
from tessera.sources import corpus as SRC

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tfidf_plan_shape(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tf = V.vectorize_with_tfidf(docs, "text", VectorizeConfig(max_features=300))
    p = plan_of(tf.matrix)
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p     # vocabulary broadcast
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p  # no Python UDF
    assert "hashpartitioning" not in p and "Window" not in p         # counts, idf and norm in the row
    assert "Exchange" not in plan_of(tf.rows)
    raw = V.doc_terms(docs, "text", VectorizeConfig())
    scan = plan_of(raw)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in scan  # column pruning


def test_dedup_moves_no_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    p = plan_of(C.prepare_corpus(docs, CleanConfig(text_col="text")))
    assert "SortAggregate" not in p and "Exchange hashpartitioning" not in p  # the rows that go are broadcast
    assert "BroadcastExchange" in p


def test_term_statistics_combine_map_side(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tf = V.term_frequencies(V.doc_terms(docs, "text", VectorizeConfig()))
    st = plan_of(V.term_stats(tf))
    assert "partial_count" in st and "partial_sum" in st
    # term counting itself never shuffles
    assert "Exchange" not in plan_of(tf)


def test_sketch_keeps_the_vocabulary_and_drops_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for binary in (False, True):
        tf = V.term_frequencies(V.doc_terms(docs, "text", VectorizeConfig()), binary).checkpoint()
        by = "df" if binary else "ctf"
        for min_df, most in ((2, 300), (1, 50), (3, None)):
            left = V.prune_terms(tf, min_df, most, by)
            # what is left has all its rows, so exact counts; the vocabulary is the one of all rows
            whole, pruned = V.term_stats(tf), V.term_stats(left)
            assert pruned.join(whole, ["term", "df", "ctf"], "left_anti").count() == 0
            want = {r.term for r in V.select_vocabulary(whole, min_df, most, by).collect()}
            assert {r.term for r in V.select_vocabulary(pruned, min_df, most, by).collect()} == want
            assert pruned.count() < 0.7 * whole.count()
    assert V.prune_terms(tf, 1, None) is tf


def test_uncapped_vocabulary_is_numbered_without_python(spark):
    words = spark.createDataFrame([(f"{chr(97 + i % 26)}{i}",) for i in range(500)], "term string").repartition(7)
    df = V.index_vocabulary(words, bounded=False)
    assert "Python" not in plan_of(df) and "ExistingRDD" not in plan_of(df).replace("Scan ExistingRDD", "")
    got = {r.term: r.term_id for r in df.collect()}
    assert got == {t: i for i, t in enumerate(sorted(got))}


def test_filter_does_not_duplicate_cleaning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    p = plan_of(C.normalize_corpus(docs, CleanConfig(text_col="text")))
    # the cleaning chain (regexp on the lower-cased text) appears once
    assert p.count("RLIKE(lower(") == 1


def test_stage_reuse(spark):
    import tempfile
    base = tempfile.mkdtemp(prefix="tessera-stage-")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    build = lambda: C.normalize_corpus(docs, CleanConfig(text_col="text"))
    a, reused_a = SRC.load_or_build_stage(spark, base, "normalized", {"k": 1}, build)
    b, reused_b = SRC.load_or_build_stage(spark, base, "normalized", {"k": 1}, build)
    c, reused_c = SRC.load_or_build_stage(spark, base, "normalized", {"k": 2}, build)
    assert (reused_a, reused_b, reused_c) == (False, True, False)
    assert a.count() == b.count() == c.count() > 0
