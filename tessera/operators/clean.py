"""Corpus normalization (N1..N18).

Order is fixed: strip, null-out junk, drop nulls, keep-first dedup, then the
per-text cleaning, tokenization, lemmas, stop words, token filters, and the
removal of documents left empty.  Only the dedup shuffles (digests and ids, not
texts); everything else is a row-local expression.  Where a lemma depends on the
word alone, a batch of texts is worked out by its words (``functions.words``).
"""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CleanConfig
from ..functions import text as T
from ..functions.lexicon import JUNK_LITERALS, stopword_list
from ..functions.tagging import lemmatize_in_context
from ..functions.words import kept_lemmas
from ..plans.joins import join_small

NORMALIZED = "_normalized"
CLEAN = "narrative_clean"
#: Columns that tell texts apart: md5, a second 64-bit hash, the length.
DIGEST = ["_md5", "_hash", "_length"]


def with_computed(df: DataFrame, name: str, expr) -> DataFrame:
    """Add/replace column ``name`` = ``expr`` so that filters on it stay above.

    Catalyst pushes a filter below the projection that defines the column it
    tests (inlining the expression), through aggregates when it only touches a
    grouping key, and below repartitions: an expensive text expression would
    run twice, and in the scan task before any rebalance.  A one-element
    ``explode_outer`` is a barrier for that: a filter on generator output
    cannot move below the generator, so the expression runs once, where it is
    placed."""
    others = [F.col(c) for c in df.columns if c != name]
    return df.select(*others, F.explode_outer(F.array(expr)).alias(name))


def require_column(df: DataFrame, col: str) -> None:
    """The text column must exist (checked on the schema, before a job)."""
    if col not in df.columns:
        raise KeyError(f"Column '{col}' not found. Available: {df.columns}")


def strip_text(df: DataFrame, text_col: str) -> DataFrame:
    """Cast to string and strip leading/trailing Unicode whitespace."""
    return df.withColumn(text_col, T.strip_ws(text_col))


def strip_and_null_out(df: DataFrame, text_col: str, junk=JUNK_LITERALS) -> DataFrame:
    """N1 + N2 as one computed column (the N3 filter stays above it)."""
    return with_computed(df, text_col, T.null_out_junk(T.strip_ws(text_col), junk))


def null_out_junk(df: DataFrame, text_col: str, junk=JUNK_LITERALS) -> DataFrame:
    """Whole-cell junk literals become null (case-sensitive)."""
    return df.withColumn(text_col, T.null_out_junk(text_col, junk))


def drop_null_text(df: DataFrame, text_col: str) -> DataFrame:
    """N3."""
    return df.filter(F.col(text_col).isNotNull())


def with_digest(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``DIGEST`` of a text; a null text has one of its own."""
    text = F.col(text_col)
    return df.withColumns({"_md5": F.coalesce(F.md5(text.cast("binary")), F.lit("")), "_hash": F.xxhash64(F.lit(7), text),
                           "_length": F.coalesce(F.length(text), F.lit(-1))})


def dedup_keep_first(df: DataFrame, text_col: str, id_col: str = "doc_id") -> DataFrame:
    """Exact dedup on the text, keeping the row with the smallest id (a null id is the smallest).

    Texts are told apart by md5, a second 64-bit hash and their length.  Only
    these and the id are shuffled: one row for every (digest, id), and their
    least id by digest, both combined map-side, so a text that a third of the
    corpus repeats is one row a map task.  The rows that go are then taken out
    of the table by an anti-join, which is broadcast if they are few (measured)
    and keyed by (digest, id) otherwise: no hot key either way.  Rows that share
    text and id are brought together on their own.
    """
    if id_col not in df.columns or id_col == text_col:
        raise KeyError(f"id column '{id_col}' not found")
    digest = DIGEST
    marked = with_digest(df, text_col).withColumn("_id", F.struct(F.col(id_col)))
    pairs = marked.groupBy(*digest, "_id").agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    first = pairs.groupBy(*digest).agg(F.min("_id").alias("_id"))
    later = pairs.join(first, [*digest, "_id"], "left_anti").select(*digest, "_id").checkpoint(eager=True)
    kept = join_small(marked, later, [*digest, "_id"], "left_anti")
    twice = pairs.filter(F.col("_n") > 1).select(*digest, "_id").join(first, [*digest, "_id"], "left_semi").checkpoint(eager=True)
    if not twice.limit(1).count():
        return kept.select(df.columns)
    others = [c for c in df.columns if c != text_col]
    again = (join_small(kept, twice, [*digest, "_id"], "left_semi").groupBy(*digest, "_id")
             .agg(F.min(F.struct(*others, text_col)).alias("_row")).select("_row.*"))
    return join_small(kept, twice, [*digest, "_id"], "left_anti").select(df.columns).unionByName(again.select(df.columns))


def normalize_text(df: DataFrame, text_col: str, out_col: str = NORMALIZED,
                   contractions: bool = True) -> DataFrame:
    """N5..N11: lower, contractions, URLs, e-mails, handles, hashtags, letters."""
    return df.withColumn(out_col, T.clean_text(text_col, contractions))


def tokenize(df: DataFrame, in_col: str = NORMALIZED, out_col: str = "_tokens") -> DataFrame:
    """N12."""
    return df.withColumn(out_col, T.tokenize_clean(in_col))


def lemmatize(df: DataFrame, in_col: str = "_tokens", out_col: str = "_lemmas",
              dictionary: DataFrame | None = None, key: str = "doc_id", context: bool = False) -> DataFrame:
    """Dictionary lemmatizer with suffix-rule fallback; with ``context``,
    forms of two words (left, building) by the tags beside them.

    The built-in dictionary is a literal set and map inside the expression (no join).
    A user dictionary ``(form, lemma)`` of any size goes through an explode
    keyed by the unique document ``key``, a join, and an ordered regroup by
    document; it is broadcast only when its row count is under the broadcast
    limit.  Documents are regrouped by their own key (never by a generated
    row id, which a recomputation after a shuffle could renumber).
    """
    if dictionary is None:
        return df.withColumn(out_col, lemmatize_in_context(in_col) if context else T.lemmatize_tokens(in_col))
    exploded = (df.select(key, F.posexplode_outer(in_col).alias("_pos", "form"))
                .filter(F.col("form").isNotNull()))
    # one lemma per form, the first in order: a form listed twice must not double its tokens
    single = dictionary.groupBy("form").agg(F.min("lemma").alias("lemma"))
    looked = join_small(exploded, single, on="form", how="left")
    rebuilt = (looked
               .withColumn("lemma", F.coalesce(F.col("lemma"),
                                                T.lemmatize_tokens(F.array("form"))[0]))
               .groupBy(key)
               .agg(F.array_sort(F.collect_list(F.struct("_pos", "lemma"))).alias("_pl")))
    rebuilt = rebuilt.select(key, F.transform("_pl", lambda s: s["lemma"]).alias(out_col))
    out = df.drop(out_col).join(rebuilt, key, "left").withColumn(
        out_col, F.coalesce(F.col(out_col), F.array().cast("array<string>")))
    return out


def remove_stopwords(df: DataFrame, in_col: str = "_lemmas", out_col: str = "_kept",
                     stopwords: list[str] | None = None) -> DataFrame:
    """Stop words removed from the lemmas (hash-set lookup, JVM-side)."""
    words = stopword_list() if stopwords is None else list(stopwords)
    remover = StopWordsRemover(inputCol=in_col, outputCol=out_col,
                               stopWords=words, caseSensitive=True)
    return remover.transform(df)


def filter_tokens(df: DataFrame, in_col: str, min_token_len: int,
                  out_col: str | None = None) -> DataFrame:
    """Keep lemmas with len >= min_token_len that are alphabetic."""
    return df.withColumn(out_col or in_col, T.keep_tokens(in_col, min_token_len))


def join_and_drop_empty(df: DataFrame, in_col: str, out_col: str = CLEAN) -> DataFrame:
    """Lemmas joined by one space; documents left empty are dropped.

    The joined text is a computed column (see ``with_computed``): otherwise
    the emptiness filter would be pushed through the dedup aggregate to the
    scan and the whole cleaning chain would run twice."""
    return (with_computed(df, out_col, F.array_join(in_col, " "))
            .filter(F.length(out_col) > 0))


def prepare_corpus(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """N1..N4: strip, null-out, drop nulls, keep-first dedup."""
    require_column(df, cfg.text_col)
    df = strip_and_null_out(df, cfg.text_col)
    df = drop_null_text(df, cfg.text_col)
    return dedup_keep_first(df, cfg.text_col, cfg.id_col)


def clean_tokens(df: DataFrame, cfg: CleanConfig = CleanConfig(),
                 lemma_dictionary: DataFrame | None = None) -> DataFrame:
    """N5..N16 on a prepared corpus: adds ``_normalized`` and ``_kept``."""
    df = normalize_text(df, cfg.text_col, NORMALIZED, cfg.expand_contractions)
    df = tokenize(df, NORMALIZED, "_tokens")
    df = lemmatize(df, "_tokens", "_lemmas", lemma_dictionary, key=cfg.id_col, context=cfg.context_lemmas)
    df = remove_stopwords(df, "_lemmas", "_kept", stopword_list(cfg.extra_stopwords))
    return filter_tokens(df, "_kept", cfg.min_token_len)


def cleaned_documents(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """``(id, narrative_clean)`` of new documents, none dropped: the same per-text
    steps as the corpus, so that a stored vocabulary meets its own terms."""
    out = clean_tokens(df.select(cfg.id_col, cfg.text_col), cfg)
    return out.select(cfg.id_col, F.array_join("_kept", " ").alias(CLEAN))


def normalize_corpus(df: DataFrame, cfg: CleanConfig = CleanConfig(),
                     lemma_dictionary: DataFrame | None = None) -> DataFrame:
    """The whole normalizer.  Returns the input columns plus
    ``narrative_clean``; the temporary ``_normalized`` column is not kept."""
    cols = list(df.columns)
    out = prepare_corpus(df, cfg)
    if lemma_dictionary is None and not cfg.context_lemmas:  # a word's lemma depends on the word alone
        out = with_computed(out, NORMALIZED, T.told_text(cfg.text_col, cfg.expand_contractions))  # Python takes no lambda's result
        kept = kept_lemmas(NORMALIZED, cfg.min_token_len, stopword_list(cfg.extra_stopwords))
        out = out.withColumn(CLEAN, kept).filter(F.length(CLEAN) > 0)
    else:
        out = join_and_drop_empty(clean_tokens(out, cfg, lemma_dictionary), "_kept", CLEAN)
    return out.select(*cols, CLEAN)
