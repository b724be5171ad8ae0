"""Named queries: one per operator of the inventory, each ``(spark, sf_dir)
-> DataFrame`` over the whole driver tables (``documents``, ``pages``,
``benchmark``).  Column names and types match ``oracles.oracle_sql()``.

Fitted state (normalized corpus, term table, vocabulary, models) is built
once per session and data folder and reused by the queries that need it.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import CleanConfig, TopicConfig, VectorizeConfig
from ..functions import text as T
from ..functions.lexicon import JUNK_LITERALS
from ..operators import clean as C
from ..operators import lda as LD
from ..operators import lsa as LS
from ..operators import stats as ST
from ..operators import topics as TP
from ..operators import vectorize as V
from ..session import ensure_checkpoint_dir, scratch_path, stored
from ..sources import corpus as SRC
from ..sources import incremental as INC
from ..sources import sinks as SK
from . import params as Q

_MEMO: dict = {}


def _session_key(spark: SparkSession):
    try:
        return spark.sparkContext.applicationId
    except Exception:  # sessions without a local SparkContext
        return id(spark)


def _memo(spark: SparkSession, key, build):
    k = (_session_key(spark), key)
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def _table(spark, sf, name, cols=None) -> DataFrame:
    return SRC.read_table(spark, f"{sf.rstrip('/')}/{name}.parquet", cols)


def _docs(spark, sf) -> DataFrame:
    return _table(spark, sf, "documents", ["doc_id", "text", "lang", "source"])


CCFG = CleanConfig(text_col="text")


def VCFG(**kw) -> VectorizeConfig:
    base = dict(max_features=Q.MAX_FEATURES, ngram_range=Q.NGRAM_RANGE, min_df=Q.MIN_DF)
    base.update(kw)
    return VectorizeConfig(**base)


TCFG = TopicConfig(n_topics=Q.N_TOPICS, n_top_terms=Q.N_TOP_TERMS, n_iter=Q.N_ITER)


def r6(c):
    return F.round(c, 6)


def _positions(df: DataFrame, arr: str, name: str = "token") -> DataFrame:
    """``(doc_id, pos, <name>)`` 1-based.  ``posexplode_outer`` + null filter:
    a plain generator makes the optimizer infer and push a size filter that
    duplicates the array expression below its projection."""
    out = df.select("doc_id", F.posexplode_outer(arr).alias("_p", name))
    return out.filter(F.col(name).isNotNull()).select(
        "doc_id", (F.col("_p") + 1).cast("long").alias("pos"), name)


# --- injected inputs (built the same way in the oracles) ---------------------
def _junk_text(d: DataFrame) -> DataFrame:
    junk = F.array(*[F.lit(j) for j in JUNK_LITERALS])
    pick = F.element_at(junk, (F.col("doc_id") % len(JUNK_LITERALS) + 1).cast("int"))
    padded = F.when(F.col("doc_id") % 2 == 0, pick).otherwise(F.concat(F.lit(" "), pick, F.lit("\t")))
    return d.withColumn("text", F.when(F.col("doc_id") % 17 == 0, padded).otherwise(F.col("text")))


def _url_docs(spark, sf) -> DataFrame:
    d = _docs(spark, sf)
    p = _table(spark, sf, "pages", ["page_id", "url"])
    j = d.join(p, d.doc_id == p.page_id, "left")
    text = F.when(F.col("url").isNull(), F.col("text")).otherwise(
        F.concat(F.col("text"), F.lit(" see "), F.col("url"), F.lit(" and www."), F.col("source"),
                 F.lit(".example.org/x now")))
    return j.select("doc_id", text.alias("text"), "lang", "source")


def _email_text(d: DataFrame) -> DataFrame:
    return d.withColumn("text", F.concat(F.col("text"), F.lit(" mail "), F.col("source"),
                                         F.lit(".x@mail.example.co.uk, or @"), F.col("source"),
                                         F.lit(" #"), F.col("lang")))


# --- shared fitted state -------------------------------------------------------
def normalized(spark, sf) -> DataFrame:
    return _memo(spark, ("normalized", sf), lambda: SRC.balance(
        stored(C.normalize_corpus(_docs(spark, sf), CCFG), "normalized")))


def _term_table(spark, sf) -> DataFrame:
    """``(doc_id, term, tf)`` of the normalized corpus, for the queries that list the counts."""
    docs = normalized(spark, sf).select("doc_id", "narrative_clean")
    return _memo(spark, ("terms", sf), lambda: stored(
        V.term_frequencies(V.doc_terms(docs, "narrative_clean", VCFG(), V.BOW_PATTERN)), "counts"))


class Fitted:
    def __init__(self, spark, sf, binary=False):
        self.docs = normalized(spark, sf).select("doc_id", "narrative_clean", "lang")
        self.n_docs = self.docs.count()
        self.cfg = VCFG(binary=binary)
        self.term_table = lambda: _term_table(spark, sf)
        self.vocab = V.fit_vocabulary_of_text(self.docs, "narrative_clean", self.n_docs, self.cfg)
        tfidf = replace(self.cfg, binary=False)
        #: ``(doc_id, lang, ids, values)`` of counts, written once for all that reads them.
        self.rows = None
        if binary or not self.vocab.broadcastable():
            terms = V.doc_terms(self.docs, "narrative_clean", self.cfg, V.BOW_PATTERN)
            self.bow = V.vectorize_counts(terms, self.vocab, binary)
            self.tfidf = V.vectorize_weights(terms, self.vocab, tfidf)
        else:
            self.rows = stored(V.text_rows(self.docs, "narrative_clean", self.vocab, self.cfg, keep=("lang",)), "rows")
            self.bow = V.vectorize_rows(self.rows.drop("lang"), self.vocab)
            self.tfidf = V.vectorize_rows(self.rows.drop("lang"), self.vocab, tfidf)

    @property
    def tf(self) -> DataFrame:
        tf = self.term_table()
        return tf.withColumn("tf", F.lit(1).cast("long")) if self.cfg.binary else tf


def fitted(spark, sf, binary=False) -> Fitted:
    return _memo(spark, ("fitted", sf, binary), lambda: Fitted(spark, sf, binary))


def _tfidf_with(spark, sf, **kw) -> DataFrame:
    f = fitted(spark, sf)
    cfg = replace(f.cfg, **kw)
    vocab = f.vocab
    if not cfg.smooth_idf or not cfg.use_idf:
        vocab = vocab.with_table(vocab.table.withColumn(
            "idf", V.idf_expr("df", f.n_docs, cfg.use_idf, cfg.smooth_idf)))
    if f.rows is None:
        return V.vectorize_weights(V.doc_terms(f.docs, "narrative_clean", cfg, V.BOW_PATTERN), vocab, cfg).matrix
    return V.vectorize_rows(f.rows.drop("lang"), vocab, cfg).matrix


def _matrix_out(m: DataFrame, round_values: bool = False) -> DataFrame:
    v = r6(F.col("value")) if round_values else F.col("value").cast("double")
    return m.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.col("term_id").cast("long").alias("term_id"), "term", v.alias("value"))


# --- models --------------------------------------------------------------------
class LsaFit:
    def __init__(self, spark, sf, cfg: TopicConfig = TCFG):
        f = fitted(spark, sf)
        self.f = f
        self.D = LS.materialize(f.tfidf)
        self.model = LS.fit_lsa(self.D, f.vocab.size, f.n_docs, cfg)
        self.model.explained_variance_ratio_sum = LS.explained_variance_ratio(f.tfidf, self.model, self.D)
        self.cfg = cfg

    def doc_topic(self, normalize=True) -> DataFrame:
        coords = LS.doc_coordinates(self.D, self.model, normalize)
        k = self.cfg.n_topics
        return (self.f.docs.select("doc_id").join(coords, "doc_id", "left")
                .select("doc_id", F.coalesce("topics", F.array_repeat(F.lit(0.0), k)).alias("topics")))

    def terms(self) -> DataFrame:
        spark = self.D.sparkSession
        t = LS.lsa_topics_frame(spark, self.model, self.f.vocab.table, self.cfg.n_top_terms)
        return TP.rank_terms(t, self.cfg.n_top_terms)


class LdaFit:
    def __init__(self, spark, sf, cfg: TopicConfig = TCFG):
        f = fitted(spark, sf)
        self.f = f
        self.cfg = cfg
        self.vectors = LD.prepare_vectors(LD.sparse_rows(f.bow))
        self.model = LD.fit_lda(self.vectors, cfg, f.n_docs, prepared=True, n_terms=f.vocab.size)

    def terms(self) -> DataFrame:
        return TP.rank_terms(LD.top_terms(self.model, self.f.vocab, self.cfg.n_top_terms),
                             self.cfg.n_top_terms)

    def doc_topic(self) -> DataFrame:
        return LD.doc_topic(self.model, self.vectors, self.cfg.n_topics)


def lsa(spark, sf) -> LsaFit:
    return _memo(spark, ("lsa", sf), lambda: LsaFit(spark, sf))


def lda(spark, sf, method="batch") -> LdaFit:
    cfg = replace(TCFG, learning_method=method)
    return _memo(spark, ("lda", sf, method), lambda: LdaFit(spark, sf, cfg))


# --- deterministic by-language topics (Y twins of the topic reports) -----------
def _lang_topics(spark, sf, method="tfidf") -> DataFrame:
    f = fitted(spark, sf)
    if f.rows is None:
        m = f.tfidf.matrix if method == "tfidf" else f.bow.matrix
        agg = (m.join(f.docs.select("doc_id", "lang"), "doc_id")
               .groupBy("lang", "term").agg(F.sum("value").alias("weight")))
    else:  # the language goes along with a document's row; names are only looked up for the sums
        rows = f.rows if method == "bow" else V.weighted_rows(f.rows, f.vocab, f.cfg)
        agg = V.summed_terms(rows.filter(F.col("doc_id").isNotNull()), "lang", f.vocab.size).join(
            F.broadcast(f.vocab.table.select("term_id", "term")), "term_id")
    agg = agg.select("lang", "term", "weight").checkpoint(eager=True)  # read for the languages and for their topics
    langs = agg.select("lang").distinct()
    # one row per language: a single ordered window over a handful of rows
    ids = langs.withColumn("topic_id", (F.dense_rank().over(Window.orderBy("lang")) - 1).cast("long"))
    topics = agg.join(F.broadcast(ids), "lang").select("topic_id", "term", "weight")
    return TP.rank_terms(topics, Q.N_TOP_TERMS)


def _topics_json(ranked: DataFrame, shape: str, bad_every: int | None = None) -> DataFrame:
    """One JSON document holding all (bounded: languages x 15) topics."""
    term_js = F.regexp_extract(F.to_json(F.array("term")), r"^\[(.*)\]$", 1)
    weight_js = F.col("weight").cast("string")
    if bad_every:
        weight_js = F.when(F.col("rank") % bad_every == 0, F.lit('"n/a"')).otherwise(weight_js)
    item = (F.concat(F.lit("["), term_js, F.lit(", "), weight_js, F.lit("]")) if shape != "lists"
            else term_js)
    per_topic = ranked.groupBy("topic_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", item.alias("j")))),
                                 lambda x: x["j"]), ", ").alias("items"))
    tid = F.col("topic_id").cast("string")
    if shape == "objects":
        topic = F.concat(F.lit('{"topic_id": '), tid, F.lit(', "terms": ['), F.col("items"), F.lit("]}"))
    elif shape == "pairs":
        topic = F.concat(F.lit("["), tid, F.lit(", ["), F.col("items"), F.lit("]]"))
    else:
        topic = F.concat(F.lit("["), F.col("items"), F.lit("]"))
    return per_topic.agg(F.concat(F.lit("["), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("topic_id", topic.alias("t")))), lambda x: x["t"]), ", "),
        F.lit("]")).alias("topics_json")).withColumn("shape", F.lit(shape))


# --- the queries -----------------------------------------------------------------
def q_scan_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    SRC.write_csv_corpus(_docs(spark, sf).select("doc_id", "text", "lang"), path)
    df = SRC.read_csv_corpus(spark, path, "doc_id long, text string, lang string", "text")
    return df


def q_scan_normalized(spark, sf):
    path = scratch_path(spark, "stage")
    SRC.write_stage(normalized(spark, sf), path)
    return spark.read.parquet(path).select("doc_id", F.col("narrative_clean").cast("string"))


def q_sink_normalized(spark, sf):
    out = scratch_path(spark, "sink")
    SK.save_normalized(normalized(spark, sf), out)
    return spark.read.parquet(f"{out}/normalized_texts").select("doc_id", "lang", "source",
                                                                  "narrative_clean")


def q_strip_text(spark, sf):
    return C.strip_text(_docs(spark, sf), "text").select("doc_id", "text")


def q_null_out_junk(spark, sf):
    d = C.null_out_junk(C.strip_text(_junk_text(_docs(spark, sf)), "text"), "text")
    return d.select("doc_id", "text")


def q_drop_null_text(spark, sf):
    d = C.drop_null_text(C.null_out_junk(C.strip_text(_junk_text(_docs(spark, sf)), "text"), "text"),
                         "text")
    return d.select("doc_id", "text")


def q_dedup_keep_first(spark, sf):
    return C.prepare_corpus(_junk_text(_docs(spark, sf)), CCFG).select("doc_id", "text")


def q_lowercase_text(spark, sf):
    return _docs(spark, sf).select("doc_id", F.lower("text").alias("text"))


def q_expand_contractions(spark, sf):
    d = _docs(spark, sf).withColumn("text", F.concat("text", F.lit(Q.CONTRACTION_SUFFIX_TEXT)))
    return d.select("doc_id", T.expand_contractions(F.lower("text")).alias("text"))


def q_strip_urls(spark, sf):
    return _url_docs(spark, sf).select("doc_id", T.strip_urls(F.lower("text")).alias("text"))


def q_strip_emails(spark, sf):
    return _email_text(_docs(spark, sf)).select("doc_id", T.strip_emails(F.lower("text")).alias("text"))


def q_strip_handles(spark, sf):
    return _email_text(_docs(spark, sf)).select("doc_id", T.strip_handles(F.lower("text")).alias("text"))


def q_strip_hashtags(spark, sf):
    return _email_text(_docs(spark, sf)).select("doc_id", T.strip_hashtags(F.lower("text")).alias("text"))


def q_letters_only(spark, sf):
    return _docs(spark, sf).select("doc_id", T.letters_only(F.lower("text")).alias("text"))


def q_normalize_texts(spark, sf):
    d = _email_text(_url_docs(spark, sf)).withColumn(
        "text", F.concat("text", F.lit(Q.CONTRACTION_SUFFIX_TEXT)))
    return C.normalize_text(d, "text", "clean").select("doc_id", F.col("clean").alias("text"))


def _cleaned(spark, sf):
    return C.normalize_text(_docs(spark, sf), "text", "c").select("doc_id", "c")


def q_tokenize(spark, sf):
    return _positions(C.tokenize(_cleaned(spark, sf), "c", "l"), "l")


def q_lemmatize_dict(spark, sf):
    d = C.tokenize(_cleaned(spark, sf), "c", "t")
    d = d.withColumn("t", F.concat("t", F.array(*[F.lit(w) for w in Q.LEMMA_CASES])))
    return _positions(C.lemmatize(d, "t", "l"), "l")


def q_lemmatize_context(spark, sf):
    d = C.tokenize(_cleaned(spark, sf), "c", "t")
    case = F.element_at(F.array(*[F.lit(c) for c in Q.CONTEXT_CASES]), (F.col("doc_id") % len(Q.CONTEXT_CASES) + 1).cast("int"))
    d = d.withColumn("t", F.concat("t", F.split(case, " ")))
    return _positions(C.lemmatize(d, "t", "l", context=True), "l")


def q_lemmatize_user_dict(spark, sf):
    """A dictionary over the words of ``benchmark`` that lists every form twice."""
    b = C.normalize_text(_table(spark, sf, "benchmark", ["text"]), "text", "c")
    forms = b.select(F.explode(T.tokenize_clean("c")).alias("form")).distinct()
    twice = forms.select("form", F.explode(F.array(F.substring("form", 1, 4),
                                                   F.substring("form", 1, 3))).alias("lemma"))
    return _positions(C.lemmatize(C.tokenize(_cleaned(spark, sf), "c", "t"), "t", "l", twice), "l")


def q_remove_stopwords(spark, sf):
    d = C.lemmatize(C.tokenize(_cleaned(spark, sf), "c", "t"), "t", "m")
    return _positions(C.remove_stopwords(d, "m", "l"), "l")


def q_min_token_len(spark, sf):
    d = C.tokenize(_cleaned(spark, sf), "c", "t")
    d = d.withColumn("l", F.filter("t", lambda x: F.length(x) >= Q.MIN_TOKEN_LEN_QUERY))
    return _positions(d, "l")


def q_alpha_tokens(spark, sf):
    d = _docs(spark, sf).select("doc_id", F.split(F.lower("text"), " ").alias("t"))
    d = d.withColumn("l", F.filter("t", lambda x: x.rlike(r"^\p{L}+$")))
    return _positions(d, "l")


def q_drop_empty_docs(spark, sf):
    return C.normalize_corpus(_docs(spark, sf), CCFG).select("doc_id")


def q_normalize_corpus(spark, sf):
    return C.normalize_corpus(_docs(spark, sf), CCFG).select("doc_id", "lang", "source",
                                                             "narrative_clean")


def q_stage_incremental(spark, sf):
    """A stage over a third of the documents, then with the files of the rest added: the rows of a full run."""
    base = scratch_path(spark, "grown")
    docs = _docs(spark, sf)
    for lot in (F.col("doc_id") % 3 == 0, F.col("doc_id") % 3 > 0):
        docs.filter(lot).write.mode("append").parquet(f"{base}/in")
        out = INC.normalized(spark, spark.read.parquet(f"{base}/in"), CCFG, f"{base}/stages", "documents")
    return out.select("doc_id", "lang", "source", "narrative_clean")


def q_bow_tokens(spark, sf):
    return _positions(_docs(spark, sf).select("doc_id", T.bow_tokens("text").alias("l")), "l")


def q_tfidf_tokens(spark, sf):
    return _positions(_docs(spark, sf).select("doc_id", T.tfidf_tokens("text").alias("l")), "l")


def q_ngrams_1_2(spark, sf):
    d = C.tokenize(_cleaned(spark, sf), "c", "t").select("doc_id", "t")
    return _positions(d.select("doc_id", T.ngrams("t", 1, 2).alias("l")), "l")


def q_term_counts(spark, sf):
    return fitted(spark, sf).tf.select(F.col("doc_id").cast("long"), "term", "tf")


def q_doc_frequency(spark, sf):
    st = V.term_stats(fitted(spark, sf).tf)
    return st.filter(F.col("df") >= Q.MIN_DF).select("term", F.col("df").cast("long"),
                                                     F.col("ctf").cast("long"))


def q_vocab_topk(spark, sf):
    return fitted(spark, sf).vocab.table.select("term", "df", "ctf")


def q_vocab_index(spark, sf):
    return fitted(spark, sf).vocab.table.select(F.col("term_id").cast("long"), "term")


def q_feature_list(spark, sf):
    return fitted(spark, sf).vocab.table.select(F.col("term_id").cast("long"),
                                                F.col("term").alias("feature"))


def q_bow_matrix(spark, sf):
    return _matrix_out(fitted(spark, sf).bow.matrix)


def q_matrix_coo(spark, sf):
    m = fitted(spark, sf).tfidf.matrix
    return m.select(F.col("doc_id").cast("long"), F.col("term_id").cast("long"),
                    r6(F.col("value")).cast("float").alias("value"))


def q_zero_row_docs(spark, sf):
    f = fitted(spark, sf)
    per_doc = f.bow.matrix.groupBy("doc_id").agg(F.count(F.lit(1)).alias("nnz"))
    return (f.docs.select("doc_id").join(per_doc, "doc_id", "left")
            .select(F.col("doc_id").cast("long"), F.coalesce("nnz", F.lit(0)).cast("long").alias("nnz")))


def q_bow_binary(spark, sf):
    return _matrix_out(fitted(spark, sf, binary=True).bow.matrix)


def q_tf_sublinear(spark, sf):
    f = fitted(spark, sf)
    t = f.tf.join(F.broadcast(f.vocab.table.select("term")), "term")
    return t.select(F.col("doc_id").cast("long"), "term",
                    r6(V.tf_weight_expr("tf", True)).alias("tf_weight"))


def q_idf_smooth(spark, sf):
    v = fitted(spark, sf).vocab.table
    return v.select(F.col("term_id").cast("long"), "term", "df", r6(F.col("idf")).alias("idf"))


def q_idf_plain(spark, sf):
    f = fitted(spark, sf)
    return f.vocab.table.select(F.col("term_id").cast("long"), "term", "df",
                                r6(V.idf_expr("df", f.n_docs, True, False)).alias("idf"))


def q_tfidf_matrix(spark, sf):
    return _matrix_out(fitted(spark, sf).tfidf.matrix, round_values=True)


def q_tfidf_l2(spark, sf):
    return _matrix_out(_tfidf_with(spark, sf, sublinear_tf=False, norm="l2"), round_values=True)


def q_tfidf_l1(spark, sf):
    return _matrix_out(_tfidf_with(spark, sf, sublinear_tf=True, norm="l1"), round_values=True)


def _raw_vectorize(spark, sf, method="bow", **kw):
    d = _docs(spark, sf).select("doc_id", "text")
    cfg = VCFG(**kw)
    if method == "bow":
        return V.vectorize_with_bow(d, "text", cfg)
    return V.vectorize_with_tfidf(d, "text", cfg)


def q_bow_lowercase(spark, sf):
    return _matrix_out(_raw_vectorize(spark, sf, lowercase=True).matrix)


def q_bow_strip_accents(spark, sf):
    return _matrix_out(_raw_vectorize(spark, sf, lowercase=True,
                                      strip_accents="unicode").matrix)


def q_bow_raw_narrative(spark, sf):
    return _matrix_out(_raw_vectorize(spark, sf).matrix)


def q_tfidf_raw_narrative(spark, sf):
    return _matrix_out(_raw_vectorize(spark, sf, method="tfidf").matrix, round_values=True)


def _bench_terms(spark, sf):
    b = _table(spark, sf, "benchmark", ["item_id", "text"]).withColumnRenamed("item_id", "doc_id")
    return V.doc_terms(C.cleaned_documents(b, CCFG), C.CLEAN, fitted(spark, sf).cfg, V.BOW_PATTERN)


def q_bow_fixed_vocab(spark, sf):
    return _matrix_out(V.vectorize_counts(_bench_terms(spark, sf), fitted(spark, sf).vocab).matrix)


def q_bow_user_vocab(spark, sf):
    """Counts over a user's terms at the user's columns (a dict of term to column)."""
    terms = V.vocabulary_from_terms(spark, Q.USER_VOCABULARY)
    d = _docs(spark, sf).select("doc_id", "text")
    return _matrix_out(V.vectorize_with_bow(d, "text", VCFG(lowercase=True), terms).matrix)


def q_tfidf_fixed_vocab(spark, sf):
    f = fitted(spark, sf)
    return _matrix_out(V.vectorize_weights(_bench_terms(spark, sf), f.vocab, f.cfg).matrix, round_values=True)


def _stats_out(df):
    return df.select("name", "n_rows", "n_cols", "nnz", r6(F.col("density")).alias("density"),
                     r6(F.col("mean_weight")).alias("mean_weight"))


def q_matrix_stats(spark, sf):
    f = fitted(spark, sf)
    return _stats_out(ST.matrix_stats(f.bow, "BoW")).unionByName(
        _stats_out(ST.matrix_stats(f.tfidf, "TF-IDF")))


def q_term_mean_weight(spark, sf):
    f = fitted(spark, sf)

    def one(v, name):
        return ST.term_mean_weight(v).select(F.lit(name).alias("method"),
                                             F.col("term_id").cast("long"), "term",
                                             r6(F.col("mean_weight")).alias("mean_weight"))
    return one(f.bow, "bow").unionByName(one(f.tfidf, "tfidf"))


def _top_out(df):
    return df.select("rank", "term", r6(F.col("mean_weight")).alias("mean_weight"))


def q_top_terms_bow(spark, sf):
    return _top_out(ST.top_terms_by_mean(fitted(spark, sf).bow, 5))


def q_top_terms_tfidf(spark, sf):
    return _top_out(ST.top_terms_by_mean(fitted(spark, sf).tfidf, 5))


def q_vectorization_report(spark, sf):
    f = fitted(spark, sf)
    return ST.vectorization_report(f.bow, f.tfidf)


def q_vectorization_meta(spark, sf):
    m = SK.vectorization_meta(fitted(spark, sf).bow)
    return m.select("method", F.col("shape")[0].alias("n_rows"), F.col("shape")[1].alias("n_cols"),
                    "nnz", "n_features", "vectorizer_type")


def q_feature_variance_total(spark, sf):
    return ST.feature_variance_total(fitted(spark, sf).tfidf).select(
        r6(F.col("total_variance")).alias("total_variance"))


def q_topics_meta_counts(spark, sf):
    L = lsa(spark, sf)
    return TP.topics_meta(L.doc_topic(), "lsa_tfidf", Q.N_TOPICS).select("method", "n_topics", "n_docs")


def q_topic_term_rank_by_lang(spark, sf):
    t = _lang_topics(spark, sf)
    return TP.topic_terms_long(t, "lang_tfidf").withColumn("weight", r6(F.col("weight")))


def q_topic_overview_by_lang(spark, sf):
    return TP.topic_overview(TP.topic_terms_long(_lang_topics(spark, sf), "lang_tfidf"), Q.TOP_K_OVERVIEW)


def q_topics_comparison_by_lang(spark, sf):
    a = TP.topic_overview(TP.topic_terms_long(_lang_topics(spark, sf, "tfidf"), "lang_tfidf"))
    b = TP.topic_overview(TP.topic_terms_long(_lang_topics(spark, sf, "bow"), "lang_bow"))
    return TP.topics_comparison([a, b, None])


def q_normalize_topics(spark, sf):
    ranked = _lang_topics(spark, sf)
    out = None
    for shape in ("objects", "pairs", "lists"):
        js = _topics_json(ranked, shape)
        parsed = TP.normalize_topics_json(js).select(F.lit(shape).alias("shape"), "topic_id", "rank",
                                                      "term", r6(F.col("weight")).alias("weight"))
        out = parsed if out is None else out.unionByName(parsed)
    return out


def q_term_weight_pairs(spark, sf):
    js = _topics_json(_lang_topics(spark, sf), "objects", bad_every=3)
    return TP.normalize_topics_json(js).select("topic_id", "rank", "term",
                                               r6(F.col("weight")).alias("weight"))


# --- model queries (rows-only checks) ------------------------------------------
def q_lda_topics(spark, sf):
    return TP.topic_terms_long(lda(spark, sf).terms(), "lda_bow")


def q_lda_top_terms(spark, sf):
    return lda(spark, sf).terms().select("topic_id", "rank", F.col("term_id").cast("long"), "term",
                                         "weight")


def q_lda_doc_topic(spark, sf):
    return TP.doc_topic_long(lda(spark, sf).doc_topic())


def q_lda_online(spark, sf):
    return TP.topic_terms_long(lda(spark, sf, "online").terms(), "lda_bow_online")


def q_lsa_singular_values(spark, sf):
    return LS.singular_values_frame(spark, lsa(spark, sf).model)


def q_lsa_doc_topic_raw(spark, sf):
    return TP.doc_topic_long(lsa(spark, sf).doc_topic(normalize=False))


def q_lsa_doc_topic(spark, sf):
    return TP.doc_topic_long(lsa(spark, sf).doc_topic(normalize=True))


def q_lsa_top_terms(spark, sf):
    return TP.topic_terms_long(lsa(spark, sf).terms(), "lsa_tfidf")


def q_lsa_sign_fix(spark, sf):
    L = lsa(spark, sf)
    comps = L.model.components
    rows = [(t, int(abs(c).argmax()), float(c[abs(c).argmax()])) for t, c in enumerate(comps)]
    df = spark.createDataFrame(rows, "topic_id long, term_id int, weight double")
    return df.join(F.broadcast(L.f.vocab.table.select("term_id", "term")), "term_id") \
             .select("topic_id", "term", "weight")


def q_lsa_explained_variance(spark, sf):
    L = lsa(spark, sf)
    return spark.createDataFrame([(float(L.model.explained_variance_ratio_sum),)],
                                 "explained_variance_ratio double")


def q_topic_term_rank(spark, sf):
    return lsa(spark, sf).terms().select("topic_id", "rank", "term", "weight")


def q_topic_topk(spark, sf):
    return TP.rank_terms(lsa(spark, sf).terms().drop("rank"), 5).select("topic_id", "rank", "term",
                                                                         "weight")


def q_topic_terms_long(spark, sf):
    return TP.topic_terms_long(lsa(spark, sf).terms(), "lsa_tfidf").unionByName(
        TP.topic_terms_long(lda(spark, sf).terms(), "lda_bow"))


def q_topic_overview(spark, sf):
    return TP.topic_overview(TP.topic_terms_long(lsa(spark, sf).terms(), "lsa_tfidf"))


def q_topics_comparison(spark, sf):
    return TP.topics_comparison([
        TP.topic_overview(TP.topic_terms_long(lda(spark, sf).terms(), "lda_bow")),
        TP.topic_overview(TP.topic_terms_long(lsa(spark, sf).terms(), "lsa_tfidf"))])


def q_doc_topic_wide(spark, sf):
    return TP.doc_topic_wide(lsa(spark, sf).doc_topic(), Q.N_TOPICS)


def q_topics_meta(spark, sf):
    out = scratch_path(spark, "topics")
    L = lsa(spark, sf)
    SK.save_topics("lsa_tfidf", TP.topic_terms_long(L.terms(), "lsa_tfidf"), L.doc_topic(),
                   Q.N_TOPICS, out, "1970-01-01T00:00:00Z")
    return spark.read.json(f"{out}/topics_lsa_tfidf").select(
        "method", F.col("n_topics").cast("long"), F.col("n_docs").cast("long"), "doc_topic_path")


# --- exact properties of the models ----------------------------------------------
def q_lda_term_mass(spark, sf):
    """Per term the weight over all topics: its corpus count plus k times the
    prior 1/k, because each pass reads every document exactly once."""
    L = lda(spark, sf)
    mass = L.model.components.sum(axis=0)  # vocabulary-sized
    rows = spark.createDataFrame([(t, float(m)) for t, m in enumerate(mass)], "term_id int, mass double")
    return L.f.vocab.table.join(rows, "term_id").select("term", r6(F.col("mass")).alias("mass"))


def q_lda_online_mass(spark, sf):
    """Per term the weight over all topics after the last online update, less what is left of
    the random start: lots, order and sizes of the steps decide it, whatever the topics are."""
    L = lda(spark, sf, "online")
    left = 1.0
    for _, step, _ in L.model.steps:
        left *= 1 - step
    mass = L.model.components.sum(axis=0) - left * L.model.start.sum(axis=0)  # vocabulary-sized
    rows = spark.createDataFrame([(t, float(m)) for t, m in enumerate(mass)], "term_id int, mass double")
    return L.f.vocab.table.join(rows, "term_id").select("term", r6(F.col("mass")).alias("mass"))


def q_lda_online_reads(spark, sf):
    """Updates and documents read in each pass of the online fit (one row a pass)."""
    model = lda(spark, sf, "online").model
    lots = len({lot for lot, _, _ in model.steps})
    rows = [(p, lots, sum(read for _, _, read in model.steps[p * lots:(p + 1) * lots])) for p in range(len(model.steps) // lots)]
    return spark.createDataFrame(rows, "pass long, n_updates long, n_read long")


def q_lda_doc_topic_sums(spark, sf):
    return lda(spark, sf).doc_topic().select(
        F.col("doc_id").cast("long"), F.size("topics").cast("long").alias("n_topics"),
        r6(F.aggregate("topics", F.lit(0.0), lambda a, x: a + x)).alias("weight_sum"))


def q_lsa_doc_topic_norms(spark, sf):
    square = F.aggregate("topics", F.lit(0.0), lambda a, x: a + x * x)
    return lsa(spark, sf).doc_topic().select(F.col("doc_id").cast("long"),
                                             r6(F.sqrt(square)).alias("norm"))


def q_lsa_coordinate_energy(spark, sf):
    """Sum of squared document coordinates over the squared singular value, per topic."""
    L = lsa(spark, sf)
    energy = (L.doc_topic(normalize=False).select(F.posexplode("topics").alias("topic_id", "x"))
              .groupBy(F.col("topic_id").cast("long").alias("topic_id"))
              .agg(F.sum(F.col("x") * F.col("x")).alias("e")))
    s = LS.singular_values_frame(spark, L.model)
    return energy.join(s, "topic_id").select(
        "topic_id", r6(F.col("e") / (F.col("singular_value") * F.col("singular_value"))).alias("share"))


def q_lsa_spectrum_moments(spark, sf):
    """Sums of the second and fourth powers of all singular values of the embeddings, from a full-rank fit:
    the sum of all squares in the matrix, and of all squares in its Gram matrix."""
    e = _table(spark, sf, "embeddings", ["vec_id", "embedding"])
    width = e.agg(F.max(F.size("embedding"))).first()[0]
    D = e.select(F.col("vec_id").alias("doc_id"), F.transform("embedding", lambda x, i: i).alias("ids"),
                 F.col("embedding").cast("array<double>").alias("ws")).checkpoint(eager=True)
    s = LS.fit_lsa(D, width, D.count(), replace(TCFG, n_topics=width)).singular_values
    rows = [(p, float((s ** p).sum())) for p in (2, 4)]
    return spark.createDataFrame(rows, "power long, total double").select("power", F.round("total", 3).alias("total"))


def q_lsa_gram(spark, sf):
    """Products of the components with each other (k x k)."""
    c = lsa(spark, sf).model.components
    gram = c @ c.T
    rows = [(i, j, round(float(gram[i, j]), 6) + 0.0) for i in range(len(c)) for j in range(len(c))]
    return spark.createDataFrame(rows, "topic_a long, topic_b long, product double")


def q_lsa_signs(spark, sf):
    return q_lsa_sign_fix(spark, sf).select("topic_id", (F.col("weight") > 0).alias("positive"))


def q_topic_rank_counts(spark, sf):
    """Per topic: terms listed, highest rank, ranks in which the weight rises (none)."""
    w = Window.partitionBy("method", "topic_id").orderBy("rank")
    t = q_topic_terms_long(spark, sf)
    t = t.withColumn("rises", (F.col("weight") > F.lag("weight").over(w)).cast("long"))
    return t.groupBy("method", F.col("topic_id").cast("long").alias("topic_id")).agg(
        F.countDistinct("term").alias("n_terms"), F.max("rank").cast("long").alias("last_rank"),
        F.coalesce(F.sum("rises"), F.lit(0)).cast("long").alias("rises"))


def q_doc_topic_wide_shape(spark, sf):
    d = q_doc_topic_wide(spark, sf)
    return d.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("doc_id").alias("n_docs")) \
            .withColumn("n_columns", F.lit(len(d.columns)).cast("long"))


def q_text_to_topics(spark, sf):
    """the whole run (normalize -> BoW -> LDA -> TF-IDF -> LSA -> reports),
    returning the comparison overview."""
    from ..config import PipelineConfig
    from .batch import run
    raw = _docs(spark, sf)
    cfg = PipelineConfig(clean=CCFG, vectorize=VCFG(), topics=TCFG, vectorize_col="narrative_clean")
    return run(spark, raw, cfg).overview


def queries() -> dict:
    out = {}
    for name, fn in globals().items():
        if name.startswith("q_") and callable(fn):
            out[name[2:]] = fn
    return out
