"""Cheap tests before the regular expressions, and tables that are written once."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tessera.config import TopicConfig, VectorizeConfig
from tessera.functions import patterns as P
from tessera.functions import text as T
from tessera.operators import lsa as LS
from tessera.operators import vectorize as V
from tessera.session import stored

TEXTS = ["", " ", "a", " a", "a ", "\u2003a b\u3000", "\u2028", "a\n", "\na\r\n\r\n", "a\u00a0\nb", "a\x1c", None,
         "see http://x.y/z#q now", "HTTPS://A.b", "WWW.foo.com x", "wWw.", "www", "a://b", "mail joe.b@x.co.uk, @me #tag",
         "@a @b hi #c#d", "x@me a#b @ # @\u00e9t\u00e9 #\u00fc1", "\u2003@me\u2003#me", "--@y.com a--@z.org", "no mark at all",
         "u", "U", "\u00e9u u\u00e9 u", "idk.", "1gonna", "gonna1 gonna", "_u_ u_ (u)", "kinda\nsorta", "it's", "it\u2019s been",
         "'tis u", "menu", "dunno\u2028", "\U0001f600u\U0001f600"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").repartition(3)


@pytest.mark.parametrize("step, pattern, other", [
    (T.strip_ws, P.STRIP, ""), (T.strip_urls, P.URL, " "), (T.strip_emails, P.EMAIL, " "),
    (T.strip_handles, P.HANDLE, " "), (T.strip_hashtags, P.HASHTAG, " ")])
def test_a_skipped_expression_would_have_changed_nothing(texts, step, pattern, other):
    rows = texts.select("t", step("t").alias("got"), F.regexp_replace("t", pattern, other).alias("want")).collect()
    assert [(r.t, r.got) for r in rows] == [(r.t, r.want) for r in rows]


def test_contractions_are_looked_for_wherever_they_can_be(texts):
    rows = texts.select("t", T._may_contract(F.col("t")).alias("may"), F.col("t").rlike(T.CONTRACTION_TRIGGER).alias("does"),
                        T.expand_contractions("t").alias("got")).collect()
    assert all(r.may or not r.does for r in rows)
    assert any(r.may and not r.does for r in rows)
    for r in rows:
        if not r.does:
            assert r.got == r.t


def test_a_step_tests_the_text_before_its_expression(texts, capsys):
    texts.select(T.strip_emails("t").alias("a"), T.strip_ws("t").alias("b")).explain()
    plan = capsys.readouterr().out
    assert plan.lower().count("case when") == 2


def test_counts_are_read_by_column(spark, texts, capsys):
    tf = stored(V.term_frequencies(V.doc_terms(texts, "t", VectorizeConfig(), id_col="i")), "counts")
    tf.groupBy("term").count().explain()
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<term:string>" in plan and "ExistingRDD" not in plan
    assert stored(tf.where("false"), "none").count() == 0


def test_explained_variance_needs_no_second_matrix(spark):
    docs = spark.createDataFrame([(i, f"loan bank {'card' * (i % 2)} fee{'a' * (i % 5)}") for i in range(40)] + [(99, "")],
                                 "doc_id long, text string")
    v = V.vectorize_with_tfidf(docs, "text", VectorizeConfig(min_df=1))
    D = LS.materialize(v)
    model = LS.fit_lsa(D, v.vocab.size, v.n_docs, TopicConfig(n_topics=2))
    want = LS.explained_variance_ratio(v, model)
    assert 0 < want <= 1
    assert LS.explained_variance_ratio(replace(v, matrix=None), model, D) == pytest.approx(want)


def test_longer_ngrams_and_short_texts(spark):
    lists = [[], ["a"], ["a", "b"], ["a", "b", "c"], list("abcdefg")]
    df = spark.createDataFrame([(x,) for x in lists], "t array<string>")
    got = [r.g for r in df.select(T.ngrams("t", 1, 4).alias("g")).collect()]
    assert got == [[" ".join(x[i:i + n]) for n in range(1, 5) for i in range(len(x) - n + 1)] for x in lists]


def test_one_hash_gives_every_row_of_the_sketch_cells_of_its_own(spark):
    df = spark.range(2000).select(F.concat(F.lit("t"), "id").alias("term"))
    rows = df.select(*(V._cells(r).alias(f"c{r}") for r in range(V.SKETCH_ROWS))).collect()
    for r in range(V.SKETCH_ROWS):
        cells = [x[r] // V.SKETCH_CELLS for x in rows]
        assert set(cells) == {r}
    assert len({tuple(x) for x in rows}) == 2000


def test_apostrophes_that_nothing_expands_are_passed_over(spark):
    plain = ["l'eau d'accord qu'il", "the 'quoted' word", "o'neil", "rock'n'roll"]
    told = {"it's": "it is", "can't2": "cannot2", "y'all!": "you all!", "wouldn't've": "would not have", "'cause x": "because x", "the bank’s been": "the bank has been",
            "o'clock": "of the clock", "ma'am": "madam", "u": "you", "u,": "you,", "x idk": "x i do not know", "he'd left": "he had left"}
    df = spark.createDataFrame([(t,) for t in [*plain, *told]], "t string")
    got = {r.t: (r.c, r.g) for r in df.select("t", F.col("t").rlike(T.CHANGE_TRIGGER).alias("c"), T.expand_contractions("t").alias("g")).collect()}
    assert {t: got[t] for t in plain} == {t: (False, t) for t in plain}
    assert {t: got[t] for t in told} == {t: (True, want) for t, want in told.items()}
