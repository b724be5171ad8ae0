"""N13 by context: lemmas of forms that belong to two words.

``left`` is *leave* or the adjective, ``building`` is *build* or the noun.  Such
forms have candidates (tag, lemma); every other word has one tag, from the
closed classes below.  The best tag path by bigram scores (Viterbi) only has to
be searched between two words of one tag: a text is cut into runs of ambiguous
forms and single words, and each run is folded by an ``aggregate`` from the tag
before it to the tag behind it.  All of it is Spark SQL inside the row.

Ties go to the greater (tag, lemmas so far) in order, so a result is one value.
A text without ambiguous forms gives exactly the lemmas of the dictionary; an
empty one gives none, a null one null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

# Tags: D determiner, P subject pronoun, A form of be, H form of have, M modal, do or to,
# I preposition, X any other word, ^ start, $ end; of ambiguous forms N noun, J adjective,
# S finite verb, C participle, G progressive, B base.
CLOSED = {
    "D": "the a an this that these those my your his her its our their no some any each every another which",
    "P": "i you he she it we they who",
    "A": "am is are was were be been being",
    "H": "have has had having",
    "M": "to will would can could cannot shall should may might must do does did not",
    "I": "of in on at by for from with about into over under after before between through during without within against and or",
}
#: form: tag and lemma of each reading
READINGS: dict[str, dict[str, str]] = {
    "left": {"S": "leave", "C": "leave", "J": "left"},
    "saw": {"S": "see", "N": "saw"},
    "leaves": {"S": "leave", "N": "leaf"},
    "lives": {"S": "live", "N": "life"},
    "rose": {"S": "rise", "N": "rose"},
    "spoke": {"S": "speak", "N": "spoke"},
    "bore": {"S": "bear", "B": "bore", "N": "bore"},
    "lay": {"S": "lie", "B": "lay"},
    "fell": {"S": "fall", "B": "fell"},
    "found": {"S": "find", "C": "find", "B": "found"},
    "ground": {"S": "grind", "C": "grind", "N": "ground"},
    "wound": {"S": "wind", "C": "wind", "N": "wound"},
    "bound": {"C": "bind", "J": "bound"},
    "felt": {"S": "feel", "C": "feel", "N": "felt"},
    "thought": {"S": "think", "C": "think", "N": "thought"},
    "shot": {"S": "shoot", "C": "shoot", "N": "shot"},
    "bases": {"S": "base", "N": "base"},
    "axes": {"S": "axe", "N": "axis"},
    "drunk": {"C": "drink", "J": "drunk"},
    "lost": {"S": "lose", "C": "lose", "J": "lost"},
}
#: -ing forms that are nouns too; the verb is that of the suffix rules.
ING_NOUNS = {
    "building": "build", "meeting": "meet", "banking": "bank", "billing": "bill", "feeling": "feel", "filing": "file",
    "finding": "find", "hearing": "hear", "housing": "house", "lending": "lend", "listing": "list", "meaning": "mean",
    "opening": "open", "rating": "rate", "saving": "save", "setting": "set", "spelling": "spell", "training": "train",
    "warning": "warn", "writing": "write", "booking": "book", "financing": "finance", "funding": "fund", "offering": "offer",
    "parking": "park", "pricing": "price", "reading": "read", "rounding": "round", "shipping": "ship", "understanding": "understand",
}
READINGS |= {w: {"G": verb, "N": w} for w, verb in ING_NOUNS.items()}
READINGS |= {f"{w}s": {"N": w} for w in ING_NOUNS}
AMBIGUOUS = sorted(READINGS)

#: Scores of a tag behind a word of one tag, and of an ambiguous form before one; 0 where nothing is said.
AFTER = {
    "D": dict(N=3, J=2, G=0, C=0, S=-3, B=-3), "P": dict(S=3, B=2, C=-1, N=-3, J=-2, G=-2),
    "A": dict(G=2, C=2, J=1, N=-1, S=-3, B=-3), "H": dict(C=3, G=-2, S=-3, B=-3),
    "M": dict(B=3, N=-1, J=-1, C=-2, G=-2, S=-3), "I": dict(N=2, G=1.5, J=1, C=-1, S=-3, B=-3),
    "X": dict(S=2, N=1), "^": dict(N=1, G=1, J=0.5),
}
BEFORE = {
    "N": dict(A=2, H=1, M=1, I=1, D=-1), "S": dict(D=2, P=1, I=1, A=-2, H=-2), "G": dict(D=2, P=1, I=0.5, X=0.5, A=-1),
    "C": {"I": 1, "D": 1, "$": 0.5, "A": -2}, "J": dict(X=2, D=-2, A=-1, I=-1), "B": dict(D=2, P=1, X=0.5),
}
BETWEEN = {
    "N": dict(S=2, N=1, B=-1), "S": dict(N=1, J=1, S=-2, B=-2), "G": dict(N=1, J=1, S=-2), "C": dict(N=0.5, S=-2),
    "J": dict(N=2, J=0, S=-1, B=-2), "B": dict(N=1, J=1, S=-2, B=-2),
}


def score_table() -> dict[str, float]:
    """``"<tag> <next tag>"`` to its score."""
    return {f"{a} {b}": float(s) for table in (AFTER, BEFORE, BETWEEN) for a, row in table.items() for b, s in row.items() if s}


def tag_of(word: str | None, edge: str) -> str:
    """Tag of a word that is not ambiguous (the plain form of ``_tag``)."""
    if word is None:
        return edge
    return next((tag for tag, words in CLOSED.items() if word in words.split()), "X")


def _tag(word: Column, edge: str) -> Column:
    out = F.when(word.isNull(), edge)
    for tag, words in CLOSED.items():
        out = out.when(word.isin(words.split()), tag)
    return out.otherwise("X")


def _map(pairs: dict, value=F.lit) -> Column:
    return F.create_map(*[x for k in sorted(pairs) for x in (F.lit(k), value(pairs[k]))])


def _scored(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_element_at(_map(score_table()), F.concat(a, F.lit(" "), b)), F.lit(0.0))


def _run(words: Column, before: Column, behind: Column) -> Column:
    """Lemmas of a run of ambiguous forms, each followed by a space."""
    readings = _map(READINGS, lambda r: F.array(*[F.struct(F.lit(t).alias("tag"), F.lit(r[t]).alias("lemma")) for t in sorted(r)]))

    def path(score: Column, tag: Column, lemmas: Column) -> Column:
        return F.struct(score.alias("score"), tag.alias("tag"), lemmas.alias("lemmas"))

    def step(paths: Column, word: Column) -> Column:
        return F.transform(F.element_at(readings, word), lambda c: F.array_max(F.transform(paths, lambda p: path(
            p["score"] + _scored(p["tag"], c["tag"]), c["tag"], F.concat(p["lemmas"], c["lemma"], F.lit(" "))))))

    start = F.array(path(F.lit(0.0), before, F.lit("")))
    return F.aggregate(words, start, step, lambda paths: F.array_max(F.transform(paths, lambda p: path(
        p["score"] + _scored(p["tag"], behind), p["tag"], p["lemmas"])))["lemmas"])


def lemmatize_in_context(tokens: Column | str) -> Column:
    """The dictionary and the suffix rules, with ambiguous forms by context."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    forms = "|".join(AMBIGUOUS)
    pieces = F.regexp_extract_all(F.concat(F.array_join(t, " "), F.lit(" ")), F.lit(f"(?:(?:{forms}) )+|[^ ]+ "), F.lit(0))

    def lemmas(run: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            def beside(j: Column, edge: str) -> Column:
                return _tag(F.when(j >= 0, F.rtrim(F.get(run, j))), edge)
            word = F.substring_index(x, " ", 1)
            found = F.split(F.rtrim(_run(F.split(F.rtrim(x), " "), beside(i - 1, "^"), beside(i + 1, "$"))), " ")
            return F.when(word.isin(AMBIGUOUS), found).otherwise(T.lemmatize_tokens(F.array(word)))
        return F.flatten(F.transform(run, one))

    # bound once: the pieces are read at three places
    within = F.element_at(F.transform(F.array(pieces), lemmas), 1)
    return F.when(F.arrays_overlap(t, F.array(*[F.lit(w) for w in AMBIGUOUS])), within).otherwise(T.lemmatize_tokens(t))
