"""Lemmas by context: worked cases, and the best path against all paths."""
import random
from itertools import groupby, product

from tessera.functions import tagging as G
from tessera.functions import text as T
from tessera.plans.params import CONTEXT_CASES

SCORES = G.score_table()


def _all_paths(words, before, behind):
    best = None
    for path in product(*[sorted(G.READINGS[w].items()) for w in words]):
        tags = [before, *[t for t, _ in path], behind]
        score = sum(SCORES.get(f"{a} {b}", 0.0) for a, b in zip(tags, tags[1:]))
        best = score if best is None or score > best else best
    return best, {" ".join(lemma for _, lemma in path) for path in product(*[sorted(G.READINGS[w].items()) for w in words])
                  if sum(SCORES.get(f"{a} {b}", 0.0) for a, b in zip([before, *[t for t, _ in path]], [*[t for t, _ in path], behind])) == best}


def _plain(tokens):
    """For every run of ambiguous forms, the set of best lemma sequences by trying all."""
    out, at = [], 0
    for hard, run in groupby(tokens, lambda w: w in G.READINGS):
        run = list(run)
        if hard:
            before = G.tag_of(tokens[at - 1] if at else None, "^")
            end = at + len(run)
            out.append((at, end, _all_paths(run, before, G.tag_of(tokens[end] if end < len(tokens) else None, "$"))[1]))
        at += len(run)
    return out


def _lemmas(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i long, t array<string>")
    got = df.select("i", G.lemmatize_in_context("t").alias("l"), T.lemmatize_tokens("t").alias("d")).collect()
    return {r.i: (r.l, r.d) for r in got}


def test_worked_cases(spark):
    got = _lemmas(spark, [c.split() for c in CONTEXT_CASES])
    for i, (case, want) in enumerate(CONTEXT_CASES.items()):
        assert " ".join(got[i][0]) == want, case


def test_best_path_against_all_paths(spark):
    rng = random.Random(7)
    plain = ["the", "they", "is", "have", "to", "of", "claims", "quickly", "ed"]
    rows = [[rng.choice(G.AMBIGUOUS if rng.random() < 0.5 else plain) for _ in range(rng.randint(1, 9))] for _ in range(300)]
    got = _lemmas(spark, rows)
    for i, row in enumerate(rows):
        found, dictionary = got[i]
        assert len(found) == len(row)
        hard = set()
        for start, end, best in _plain(row):
            assert " ".join(found[start:end]) in best, row
            hard |= set(range(start, end))
        assert all(found[j] == dictionary[j] for j in range(len(row)) if j not in hard)


def test_empty_null_long_and_repeated(spark):
    long_run = ["left"] * 400
    long_text = ["the", "left", "claims"] * 7000
    got = _lemmas(spark, [[], None, ["left"], long_run, long_text, ["saw"], ["saw"]])
    assert got[0][0] == [] and got[1][0] is None
    assert got[5] == got[6] and len(got[2][0]) == 1 and len(got[3][0]) == 400
    assert got[4][0] == ["the", "left", "claim"] * 7000
