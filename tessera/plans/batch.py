"""the full batch run.

normalize (stage, reused when its config is unchanged) -> BoW -> LDA ->
TF-IDF -> LSA -> reports.  The counts of the vocabulary's terms are written
once and feed both vectorizers when their token patterns agree (always on
cleaned text); the doc-major TF-IDF table is checkpointed for the LSA passes.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig, VectorizeConfig
from ..operators import clean as C
from ..operators import lda as LD
from ..operators import lsa as LS
from ..operators import stats as ST
from ..operators import topics as TP
from ..operators import vectorize as V
from ..session import ensure_checkpoint_dir, stored
from ..sources import corpus as SRC
from ..sources import incremental as INC
from ..sources import sinks as SK


@dataclass
class PipelineResult:
    normalized: DataFrame
    bow: V.Vectorized
    tfidf: V.Vectorized
    lda_terms: DataFrame
    lda_doc_topic: DataFrame
    lsa_terms: DataFrame
    lsa_doc_topic: DataFrame
    lsa_model: LS.LsaModel
    report: DataFrame
    overview: DataFrame
    meta: dict = field(default_factory=dict)


def normalized_stage(spark: SparkSession, raw: DataFrame, cfg: PipelineConfig,
                     stage_base: str | None) -> DataFrame:
    """The normalized corpus is always materialized (Parquet stage under
    ``stage_base``, by default in the folder of ``spark.checkpoint.dir``) and read
    back, so the cleaning runs once however many jobs follow; a later run
    normalizes only the files that were added (``sources.incremental``)."""
    return SRC.balance(INC.normalized(spark, raw, cfg.clean, stage_base))


def _timed(timings: dict, name: str, t0: float) -> float:
    t1 = time.time()
    timings[name] = round(t1 - t0, 3)
    return t1


def _stored(v: V.Vectorized) -> V.Vectorized:
    """The vectorizer's rows (or, without rows, its long matrix) written once for all that reads them."""
    if v.rows is None:
        return replace(v, matrix=stored(v.matrix, "matrix"))
    rows = stored(v.rows, "rows")
    return replace(v, rows=rows, matrix=V.long_matrix(rows, v.vocab))


def _vectorized(docs: DataFrame, text_col: str, vocab: V.Vocabulary, cfg: VectorizeConfig, pattern: str) -> V.Vectorized:
    """Counts over the vocabulary, written once."""
    if not vocab.broadcastable():
        return _stored(V.vectorize_counts(V.doc_terms(docs, text_col, cfg, pattern), vocab, cfg.binary))
    return V.vectorize_rows(stored(V.text_rows(docs, text_col, vocab, cfg, pattern), "rows"), vocab)


def run(spark: SparkSession, raw: DataFrame, cfg: PipelineConfig = PipelineConfig(),
        outdir: str | None = None, stage_base: str | None = None) -> PipelineResult:
    ensure_checkpoint_dir(spark)
    timings: dict = {}
    t = time.time()
    normalized = normalized_stage(spark, raw, cfg, stage_base)
    t = _timed(timings, "normalize", t)
    text_col = cfg.vectorize_col
    vc, tc = cfg.vectorize, cfg.topics
    id_col = cfg.clean.id_col

    docs = normalized.select(F.col(id_col).alias("doc_id"), text_col)
    n_docs = docs.count()

    bow_vocab = V.fit_vocabulary_of_text(docs, text_col, n_docs, vc, V.BOW_PATTERN)
    t = _timed(timings, "vocabulary", t)

    # BoW + LDA
    bow = _vectorized(docs, text_col, bow_vocab, vc, V.BOW_PATTERN)
    t = _timed(timings, "bow", t)
    vectors = LD.prepare_vectors(LD.sparse_rows(bow))
    lda_model = LD.fit_lda(vectors, tc, n_docs, prepared=True, n_terms=bow_vocab.size)
    lda_terms = TP.topic_terms_long(
        TP.rank_terms(LD.top_terms(lda_model, bow.vocab, tc.n_top_terms), tc.n_top_terms),
        "lda_bow").checkpoint(eager=True)
    lda_dt = LD.doc_topic(lda_model, vectors, tc.n_topics)
    t = _timed(timings, "lda", t)

    # TF-IDF + LSA
    tcfg = replace(vc, binary=False)
    # One vocabulary and one count of the terms for both vectorizers when their token patterns agree:
    # on cleaned text ([a-z] words, single spaces) they always do.
    if text_col == C.CLEAN and not vc.binary:
        counts = bow
    else:
        tfidf_vocab = V.fit_vocabulary_of_text(docs, text_col, n_docs, tcfg, V.WORD_PATTERN)
        counts = _vectorized(docs, text_col, tfidf_vocab, tcfg, V.WORD_PATTERN)
    if counts.rows is None:
        tfidf = _stored(V.vectorize_weights(V.doc_terms(docs, text_col, tcfg, V.WORD_PATTERN), counts.vocab, tcfg))
    else:
        tfidf = _stored(V.vectorize_rows(counts.rows, counts.vocab, tcfg))
    t = _timed(timings, "tfidf", t)
    D = LS.materialize(tfidf)
    lsa_model = LS.fit_lsa(D, tfidf.vocab.size, n_docs, tc)
    lsa_model.explained_variance_ratio_sum = LS.explained_variance_ratio(tfidf, lsa_model, D)
    lsa_terms = TP.topic_terms_long(
        TP.rank_terms(LS.lsa_topics_frame(spark, lsa_model, tfidf.vocab.table, tc.n_top_terms),
                      tc.n_top_terms), "lsa_tfidf").checkpoint(eager=True)
    coords = LS.doc_coordinates(D, lsa_model, tc.normalize_doc_topics)
    lsa_dt = (docs.select("doc_id").join(coords, "doc_id", "left")
              .select("doc_id", F.coalesce("topics", F.array_repeat(F.lit(0.0), tc.n_topics))
                      .alias("topics")))
    t = _timed(timings, "lsa", t)
    timings["lsa_passes"] = lsa_model.n_passes

    report = ST.vectorization_report(bow, tfidf)
    overview = TP.topics_comparison([TP.topic_overview(lda_terms, cfg.top_k_overview),
                                     TP.topic_overview(lsa_terms, cfg.top_k_overview)])
    result = PipelineResult(normalized, bow, tfidf, lda_terms, lda_dt, lsa_terms, lsa_dt,
                            lsa_model, report, overview)
    if outdir:
        result.meta = write_all(result, cfg, outdir)
        t = _timed(timings, "write", t)
    result.meta["timings"] = timings
    return result


def write_all(r: PipelineResult, cfg: PipelineConfig, outdir: str) -> dict:
    stamp = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    k = cfg.topics.n_topics
    meta = {
        "bow": SK.save_vectorization(r.bow, outdir, stamp),
        "tfidf": SK.save_vectorization(r.tfidf, outdir, stamp),
        "lda_bow": SK.save_topics("lda_bow", r.lda_terms, r.lda_doc_topic, k, outdir,
                                  stamp, cfg.top_k_overview),
        "lsa_tfidf": SK.save_topics("lsa_tfidf", r.lsa_terms, r.lsa_doc_topic, k, outdir,
                                    stamp, cfg.top_k_overview),
    }
    SK.save_report(r.report, outdir)
    SK.save_comparison(r.overview, outdir)
    return meta
