import tempfile

from pyspark.sql import functions as F

from tessera.config import CleanConfig, VectorizeConfig
from tessera.operators import clean as C
from tessera.operators import vectorize as V
from tessera.streaming.scoring import start_scoring


def test_stream_scores_like_batch(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    cfg = VectorizeConfig(max_features=500, ngram_range=(1, 2), min_df=2)
    ccfg = CleanConfig(text_col="text")
    fitted = V.vectorize_with_tfidf(C.cleaned_documents(docs, ccfg), C.CLEAN, cfg)
    src = tempfile.mkdtemp(prefix="tessera-stream-src-")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet") \
        .select(F.col("item_id").alias("doc_id"), "text")
    bench.repartition(3).write.mode("overwrite").parquet(src + "/in")
    sink = tempfile.mkdtemp(prefix="tessera-stream-sink-")
    q = start_scoring(spark, src + "/in", "doc_id long, text string", fitted.vocab, cfg, sink)
    q.awaitTermination(120)
    got = spark.read.parquet(sink + "/batch=*")
    expected = V.tfidf_matrix(V.term_frequencies(V.doc_terms(
        C.cleaned_documents(bench, ccfg), C.CLEAN, cfg)), fitted.vocab, cfg)
    a = {(r.doc_id, r.term_id): round(r.value, 9) for r in got.collect()}
    b = {(r.doc_id, r.term_id): round(r.value, 9) for r in expected.collect()}
    assert a == b and len(a) > 0
