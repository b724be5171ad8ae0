"""Column expressions for text cleaning and tokenization.

Everything here but ``strip_accents`` is a built-in Spark SQL expression
(regexp_replace, split, higher-order array functions), so it runs JVM-side
inside the stage that reads the text.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import patterns as P
from .lexicon import (CONTRACTION_ADVERBS, CONTRACTION_HEADS, CONTRACTION_SUFFIXES, CONTRACTION_WORDS, DOUBLED_STEM,
                      JUNK_LITERALS, LEMMA_EXCEPTIONS, LEMMA_RULES, LEMMA_WORDS, PAST_WORDS, PERFECT_WORDS,
                      SILENT_E_STEM, VERB_FORM, VERB_STEM)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _looked_up(words: dict[str, str], x: Column, other: Column) -> Column:
    """``words[x]``, else ``other``.  The membership test is a hash set; the
    literal map, which is searched in order, is only read on a hit."""
    entries = F.create_map(*[F.lit(v) for k in sorted(words) for v in (k, words[k])])
    return F.when(x.isin(sorted(words)), F.element_at(entries, x)).otherwise(other)


def _bound(c: Column | str, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` reads it."""
    return F.get(F.transform(F.array(_col(c)), f), F.lit(0))


def _where(c: Column | str, has, pattern: str, other: str) -> Column:
    """``pattern`` replaced in the texts that ``has`` holds for; the others cannot match it."""
    return _bound(c, lambda x: F.when(has(x), F.regexp_replace(x, pattern, other)).otherwise(x))


# --- N1 / N2 ------------------------------------------------------------------
def strip_ws(c: Column | str) -> Column:
    """leading/trailing Unicode whitespace removed (Python str.strip())."""
    return _where(_col(c).cast("string"), lambda x: F.substring(x, 1, 1).rlike(P.WS) | F.substring(x, -1, 1).rlike(P.WS),
                  P.STRIP, "")


def null_out_junk(c: Column | str, junk=JUNK_LITERALS) -> Column:
    """Whole-cell, case-sensitive junk literals become null."""
    c = _col(c)
    return F.when(c.isin(list(junk)), F.lit(None).cast("string")).otherwise(c)


# --- N5 .. N11 ----------------------------------------------------------------
def _expand_word(word: Column, depth: int = 2) -> Column:
    """One word: the dictionary, else up to ``depth`` suffixes behind a letter."""
    if depth == 0:
        return _looked_up(CONTRACTION_WORDS, word, word)
    rest = None
    for suffix, full in CONTRACTION_SUFFIXES:
        stem = F.substring(word, F.lit(1), F.length(word) - len(suffix))
        fits = word.rlike(f"[a-z]{suffix}$")
        expanded = F.concat(_expand_word(stem, depth - 1), F.lit(full))
        rest = F.when(fits, expanded) if rest is None else rest.when(fits, expanded)
    return _looked_up(CONTRACTION_WORDS, word, rest.otherwise(word))


#: Steps before the dictionary, as (pattern, replacement): leading apostrophes,
#: then 's and 'd by the word that follows (it's been, he'd left).
CONTEXT_STEPS = (
    *((f"{P.PRE}{P.APOS}{head}{P.POST}", "{1}" + full + "{2}") for head, full in CONTRACTION_HEADS.items()),
    (P.auxiliary("s", CONTRACTION_ADVERBS, PERFECT_WORDS), "{1} has{2}{3}"),
    (P.auxiliary("d", CONTRACTION_ADVERBS, ("[a-z]{2,}[^e]ed", *PAST_WORDS)), "{1} had{2}{3}"),
)
SLANG = tuple(w for w in CONTRACTION_WORDS if "'" not in w)
#: Texts without this are left as they are (the SQL oracle's test; see ``_may_contract``).
CONTRACTION_TRIGGER = f"{P.APOS}|{P.PRE}(?:{'|'.join(SLANG)}){P.POST}"


#: What slang matches, and more: a plain class is cheaper, and a text without contractions is put together as it was.
SLANG_TRIGGER = f"(?:^|[^a-z])(?:{'|'.join(SLANG)})(?:$|[^a-z])"
#: The same behind the first character: an anchor is a test at every place, and so is each first letter.
SLANG_INSIDE = "[^a-z](?:" + "|".join(
    f"{a}(?:{'|'.join(w[1:] for w in SLANG if w[0] == a)})" for a in sorted({w[0] for w in SLANG})) + ")(?:$|[^a-z])"
SLANG_LENGTH = max(map(len, SLANG))


#: What stands behind the last apostrophe of all that is expanded.  Most apostrophes (of French articles, of quotes) are none of these.
ENDINGS = sorted({w.rsplit("'", 1)[1] for w in (*CONTRACTION_WORDS, *(s for s, _ in CONTRACTION_SUFFIXES)) if "'" in w}
                 | {*CONTRACTION_HEADS, "s", "d"})
#: Texts without this are not changed.
CHANGE_TRIGGER = f"{P.APOS}(?:{'|'.join(ENDINGS)})(?:$|[^a-z])|{SLANG_TRIGGER}"
#: What every match of the steps of ``CONTEXT_STEPS`` holds behind an apostrophe.
CONTEXT_MARKS = (*CONTRACTION_HEADS, "s ", "d ")


def _may_contract(t: Column) -> Column:
    """Holds wherever ``CONTRACTION_TRIGGER`` matches."""
    return t.contains("'") | t.contains("\u2019") | t.rlike(SLANG_INSIDE) | F.substring(t, 1, SLANG_LENGTH + 1).rlike(SLANG_TRIGGER)


def expand_contractions(c: Column | str) -> Column:
    """Contractions and slang to full words (context, dictionary, suffix rules).

    'd before a participle is "had", 's before one of ``PERFECT_WORDS`` "has";
    otherwise 'd is "would", and 's "is" behind the pronouns of the dictionary.
    A noun's 's before any other word is a possessive and stays.  Only texts that contain an apostrophe or a slang word are split, once, into
    words and the gaps between them; quotes around words are gaps and stay.
    """
    t = _col(c)
    return F.when(_may_contract(t), _bound(t, _expanded)).otherwise(t)


def _expanded(t: Column) -> Column:
    told = t
    for (pattern, full), mark in zip(CONTEXT_STEPS, CONTEXT_MARKS):
        told = _where(told, lambda x, mark=mark: x.contains(f"'{mark}") | x.contains(f"\u2019{mark}"), pattern, P.java_group(full))

    def expand(x: Column) -> Column:
        full = _bound(F.translate(x, "\u2019", "'"), lambda plain: _bound(
            _expand_word(plain), lambda full: F.when(full != plain, full).otherwise(x)))
        return F.when(x.contains("'") | x.contains("\u2019") | x.isin(list(SLANG)), full).otherwise(x)

    pieces = F.regexp_extract_all(told, F.lit(P.WORDS_AND_GAPS), F.lit(0))
    return F.when(t.rlike(CHANGE_TRIGGER), F.array_join(F.transform(pieces, expand), "")).otherwise(t)


def strip_urls(c: Column | str) -> Column:
    return _where(c, lambda x: x.contains("://") | F.lower(x).contains("www."), P.URL, " ")


def strip_emails(c: Column | str) -> Column:
    return _where(c, lambda x: x.contains("@"), P.EMAIL, " ")


def strip_handles(c: Column | str) -> Column:
    return _where(c, lambda x: x.contains("@"), P.HANDLE, " ")


def strip_hashtags(c: Column | str) -> Column:
    return _where(c, lambda x: x.contains("#"), P.HASHTAG, " ")


def letters_only(c: Column | str) -> Column:
    """Collapse whitespace, keep [a-z], collapse and trim again.

    After the earlier steps every maximal run of characters outside [a-z]
    (whitespace included) ends up as one space, so one replace + trim gives the
    same text as the reference's three passes.
    """
    return F.trim(F.regexp_replace(_col(c), P.NON_LETTERS, " "))


def told_text(c: Column | str, contractions: bool = True) -> Column:
    """N5, N6, N7..N10: what is left to be cut into words."""
    t = F.lower(_col(c))
    if contractions:
        t = expand_contractions(t)
    return strip_hashtags(strip_handles(strip_emails(strip_urls(t))))


def clean_text(c: Column | str, contractions: bool = True) -> Column:
    """N5, N6, N7..N11 in the reference's order."""
    return letters_only(told_text(c, contractions))


# --- N12 .. N17 ---------------------------------------------------------------
def tokenize_clean(c: Column | str) -> Column:
    """Tokens of a cleaned text (only [a-z] and single spaces remain)."""
    return F.filter(F.split(_col(c), " "), lambda x: x != "")


def _verb_stem(stem: Column) -> Column:
    """The base form behind a stripped -ed or -ing."""
    return (F.when(stem.rlike(DOUBLED_STEM), F.substring(stem, F.lit(1), F.length(stem) - 1))
            .when(stem.rlike(SILENT_E_STEM), F.concat(stem, F.lit("e")))
            .otherwise(stem))


def _lemma_rules(x: Column) -> Column:
    """Suffix rules; they end in s, d or g, so a cheap test skips the regexes
    for most tokens."""
    rules = None
    for pattern, template in LEMMA_RULES:
        branch = F.regexp_replace(x, pattern, P.java_group(template))
        rules = (F.when(x.rlike(pattern), branch) if rules is None
                 else rules.when(x.rlike(pattern), branch))
    cut = F.length(x) - F.when(x.endswith("d"), 2).otherwise(3)
    stem = F.substring(x, F.lit(1), cut)
    verb = F.when(x.rlike(VERB_FORM) & stem.rlike(VERB_STEM), _verb_stem(stem)).otherwise(x)
    return (F.when(x.endswith("s") | x.endswith("ied"), rules.otherwise(x))
            .when(x.endswith("ed") | x.endswith("ing"), verb).otherwise(x))


def lemmatize_tokens(tokens: Column | str) -> Column:
    """Dictionary lookup (everyday words first), then the suffix rules."""
    rare = {k: v for k, v in LEMMA_EXCEPTIONS.items() if k not in LEMMA_WORDS}
    return F.transform(_col(tokens), lambda x: _looked_up(LEMMA_WORDS, x, _looked_up(rare, x, _lemma_rules(x))))


def keep_tokens(tokens: Column | str, min_len: int) -> Column:
    """Length and alphabetic filters on lemmas (stop words are
    removed with a hash-set transformer, see operators.clean)."""
    return F.filter(_col(tokens),
                    lambda x: (F.length(x) >= F.lit(min_len)) & x.rlike(P.ALPHA))


# --- V1 / V2 / V3 -------------------------------------------------------------
def word_runs(c: Column | str) -> Column:
    """Maximal runs of word characters (Python's \\w) of a text."""
    return F.split(F.coalesce(_col(c), F.lit("")), P.NOT_WORD)


def bow_tokens(c: Column | str) -> Column:
    """V1: the BoW pattern (?u)\\b[a-z]{2,}\\b."""
    return F.filter(word_runs(c), lambda x: x.rlike(P.BOW_TOKEN))


def tfidf_tokens(c: Column | str) -> Column:
    """V2: the default word pattern (?u)\\b\\w\\w+\\b."""
    return F.filter(word_runs(c), lambda x: F.length(x) >= 2)


def _joined(a: Column, n: int) -> Column:
    """The n-grams of an array of at least n tokens."""
    if n == 1:
        return a
    shorter = _joined(F.slice(a, F.lit(1), F.size(a) - 1), n - 1)
    return F.zip_with(shorter, F.slice(a, F.lit(n), F.size(a) - (n - 1)), lambda x, y: F.concat_ws(" ", x, y))


def ngrams(tokens: Column | str, min_n: int, max_n: int) -> Column:
    """V3: all word n-grams for n in [min_n, max_n], joined by one space.

    The tokens are put beside the tokens n-1 places on: one ``slice`` a document,
    not one an n-gram.  Guarded by size(tokens) >= n: a slice has no negative length.
    """
    a = _col(tokens)
    parts = []
    for n in range(min_n, max_n + 1):
        if n == 1:
            parts.append(a)
            continue
        parts.append(F.when(F.size(a) >= n, _joined(a, n))
                     .otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def term_counts(df, terms: str = "terms", out: str = "_counts"):
    """V4 inside one row: adds ``out`` = array<struct<term, tf>> of ``terms``.

    Sort, find the run starts, take run lengths: O(n log n) per document and
    no shuffle (a document's terms never leave its row).  The sorted array and
    the run starts are projected as columns, so the lambdas read them instead
    of re-sorting per element.
    """
    sorted_ = df.withColumn("_sorted", F.sort_array(F.col(terms)))
    s = F.col("_sorted")
    with_starts = sorted_.withColumn(
        "_starts", F.filter(F.sequence(F.lit(1), F.greatest(F.size(s), F.lit(1))),
                            lambda i: (i == 1) | (F.element_at(s, i) != F.element_at(s, i - 1))))
    st = F.col("_starts")
    n = F.size(s)
    runs = F.transform(
        st,
        lambda p, j: F.struct(
            F.element_at(s, p).alias("term"),
            (F.coalesce(F.try_element_at(st, j + 2), n + 1) - p).cast("long").alias("tf")))
    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return with_starts.withColumn(out, F.when(n > 0, runs).otherwise(empty)) \
                      .drop("_sorted", "_starts")


# --- W6 -----------------------------------------------------------------------
@F.pandas_udf(StringType())
def _decomposed(texts: pd.Series) -> pd.Series:
    """NFKD without combining marks; no SQL function decomposes ligatures,
    full-width letters or scripts beyond Latin."""
    def fold(text):
        if text is None or text.isascii():
            return text
        return "".join(ch for ch in unicodedata.normalize("NFKD", text)
                       if not unicodedata.combining(ch))
    return texts.map(fold)


def strip_accents(c: Column | str, mode: str | None) -> Column:
    """W6: 'unicode' folds every character to its compatibility form without
    marks; 'ascii' does that and drops every character left outside ASCII."""
    c = _col(c)
    if mode is None:
        return c
    if mode not in ("ascii", "unicode"):
        raise ValueError(f"strip_accents must be None, 'ascii' or 'unicode', got {mode!r}")
    folded = _decomposed(c)
    return folded if mode == "unicode" else F.regexp_replace(folded, r"[^\x{00}-\x{7F}]", "")
