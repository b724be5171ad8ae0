"""Quality rules as a short-circuit cascade, in Spark expressions only.

A rule is a boolean column that says "reject".  The number of words, which
nearly all rules need, is computed once a document; what only one rule needs is
computed inside that rule.  ``plan_cascade`` runs each rule, in the form in which
the cascade has it, over a sample of about ``SAMPLE_ROWS`` documents several
times, takes its least time and the share it rejects, and orders the rules by
rejection per cost.  ``rejected_by`` is the ordered cascade as one CASE
expression: Spark evaluates a later rule only for documents that every earlier
one lets through.  The order changes the work, never which documents are
rejected.

Defined results: null text has no words and is rejected like an empty one;
texts of any length are read whole; repeated rows are judged alike; an empty
table keeps the given order of rules; other columns ride along.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

SPACE = r"[\x20\x09-\x0D]"
SAMPLE_ROWS = 2000
#: Runs of a rule over the sample, of which the fastest counts.
RUNS = 3

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10       # symbols per 100 words
MAX_DUP_LINE_PERCENT = 50     # of the lines with a word
WORD_CHARS = (2.5, 15.0)      # mean length of a word
MAX_UPPER_PERCENT = 50        # of the letters
MIN_LETTER_WORD_PERCENT = 60  # words that begin with a letter or digit, by count


def _text(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words(text: str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order."""
    bare = F.btrim(_text(text), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def n_words(text: str) -> Column:
    return F.regexp_count(_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def word_chars(text: str) -> Column:
    """Code points in words: every white space of the word pattern is one code point."""
    return (F.length(_text(text)) - F.regexp_count(_text(text), F.lit(SPACE))).cast("long")


def n_symbols(text: str) -> Column:
    return F.regexp_count(_text(text), F.lit(r"[#*$%&|<>]")).cast("long")


def word_lines(text: str) -> Column:
    return F.filter(F.split(_text(text), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_dup_lines(text: str) -> Column:
    """Lines with a word that equal an earlier line."""
    return _bind(word_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(text: str, n: Column | None = None) -> Column:
    """Words in 3-word windows that the text (of ``n`` words) has twice or more.

    Windows are sorted by a 64-bit hash, so equal ones stand side by side; then
    the places of the repeated ones are sorted and their spans added up.
    """
    def windows(w: Column) -> Column:
        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        return F.sort_array(F.transform(F.filter(s, lambda x, k: (
            F.get(s, k + 1)["h"].eqNullSafe(x["h"]) | F.get(s, k - 1)["h"].eqNullSafe(x["h"]))),
            lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda x, k: F.least(F.lit(3), F.get(at, k + 1) - x)),
                           F.lit(0), lambda a, x: a + x)

    w = words(text)
    return F.coalesce(F.when((n_words(text) if n is None else n) >= 4, _bind(w, lambda w: _bind(
        windows(w), lambda s: _bind(repeated(s), covered)))), F.lit(0)).cast("long")


COUNTS = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
          "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words}


@dataclass(frozen=True)
class Rule:
    """A reason to reject a document, as a boolean column."""

    name: str
    rejects: Column


def default_rules(text: str, n: Column | None = None, counts: dict[str, Column] | None = None) -> list[Rule]:
    """The rules over ``text``, of ``n`` words; ``counts`` may name columns that hold counts already."""
    n = n_words(text) if n is None else n
    c = counts or {k: f(text) for k, f in COUNTS.items()} | {"n_repeat_words": n_repeat_words(text, n)}
    t = _text(text)
    letters = F.regexp_count(t, F.lit(r"\p{L}"))
    lettered = F.regexp_count(t, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*?[\p{L}\p{N}]"))

    def most_lines_repeated(lines: Column) -> Column:
        repeated = c["n_dup_lines"] if counts else F.size(lines) - F.size(F.array_distinct(lines))
        return 100 * repeated > MAX_DUP_LINE_PERCENT * F.size(lines)

    return [
        Rule("few_words", n < MIN_WORDS),
        Rule("repeated_words", 100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * n),
        Rule("symbols", 100 * c["n_symbols"] > MAX_SYMBOL_PERCENT * n),
        Rule("repeated_lines", _bind(word_lines(text), most_lines_repeated)),
        Rule("word_length", _bind(c["word_chars"], lambda x: (x < WORD_CHARS[0] * n) | (x > WORD_CHARS[1] * n))),
        Rule("upper_case", 100 * F.regexp_count(t, F.lit(r"\p{Lu}")) > MAX_UPPER_PERCENT * letters),
        Rule("letterless_words", 100 * lettered < MIN_LETTER_WORD_PERCENT * n),
    ]


@dataclass(frozen=True)
class PlannedRule:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        """Share rejected per second."""
        return self.rejected / max(self.seconds, 1e-6)


def sample_of(docs: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 7) -> DataFrame:
    """About ``rows`` documents, drawn where they lie and then brought together."""
    n = docs.count()
    return stage(docs.sample(min(1.0, rows / n), seed).repartition(1) if n else docs, "quality-sample")


def plan_cascade(sample: DataFrame, rules: list[Rule], idle: Column | None = None) -> list[PlannedRule]:
    """Time every rule over a sample and order the rules by rejection per cost.

    Rules are given in the form in which the cascade evaluates them; ``idle`` is
    that form without a rule, and what it costs is not the rules'.
    """
    empty = F.lit(False) if idle is None else idle

    def run(column: Column) -> tuple[float, float]:
        seconds = []
        for _ in range(RUNS):
            began = time.perf_counter()
            share = sample.agg(F.avg(F.coalesce(column, F.lit(False)).cast("int"))).first()[0]
            seconds.append(time.perf_counter() - began)
        return min(seconds), share or 0.0

    run(empty)  # the first run of all also starts the readers
    base = run(empty)[0]
    planned = []
    for rule in rules:
        seconds, rejected = run(rule.rejects)
        planned.append(PlannedRule(rule, max(seconds - base, 1e-3), rejected))
    return sorted(planned, key=lambda p: -p.gain)


def rejected_by(rules: list[Rule]) -> Column:
    """Name of the first rule, in this order, that rejects a document; null if none does."""
    out = F.when(F.lit(False), F.lit(""))
    for r in rules:
        out = out.when(r.rejects, F.lit(r.name))
    return out


def keep_quality(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with their own columns.

    The cascade stands inside one expression that binds the number of words, so
    the optimizer cannot write its computation into every rule.
    """
    sample = sample_of(docs.select(text_col), sample_rows)
    names: list[str] = []

    def cascade(n: Column) -> Column:
        by_name = {r.name: r for r in default_rules(text_col, n)}
        return rejected_by([by_name[name] for name in names]).isNotNull()

    def alone(name: str) -> Column:
        return _bind(n_words(text_col), lambda n: next(r for r in default_rules(text_col, n) if r.name == name).rejects)

    forms = [Rule(r.name, alone(r.name)) for r in default_rules(text_col, F.lit(0))]
    nothing = _bind(n_words(text_col), lambda n: n < 0)
    names += [p.rule.name for p in plan_cascade(sample, forms, idle=nothing)]
    return docs.where(~_bind(n_words(text_col), cascade))


def quality_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every document's counts, ``base_failed`` and ``kept``.

    The counts are part of the result, so the cascade reads them as columns, and
    is planned on a sample that has them as columns.
    """
    def counted(of: DataFrame) -> DataFrame:
        return of.select(*(F.col(c) for c in of.columns), *(f(text_col).alias(k) for k, f in COUNTS.items()))

    known = {k: F.col(k) for k in COUNTS}
    rules = default_rules(text_col, known["n_words"], known)
    sample = stage(counted(sample_of(docs.select(text_col), sample_rows)), "quality-counts")
    plan = plan_cascade(sample, rules)
    by_name = {r.name: r for r in rules}
    base_failed = by_name["few_words"].rejects | by_name["repeated_words"].rejects
    return counted(docs.select(id_col, text_col)).select(
        id_col, *COUNTS, base_failed.alias("base_failed"),
        (~base_failed & rejected_by([p.rule for p in plan]).isNull()).alias("kept"))
