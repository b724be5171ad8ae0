"""Manifest, prefix trie and decontamination against plain Python."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontaminate, merkle, ordered, prefix_trie
from tessera.llm import queries as Q

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(*parts):
    return hashlib.sha256(b"".join(p.encode() if isinstance(p, str) else p for p in parts)).hexdigest()


def same(got, want):
    got = Counter(got)
    assert got == want, (list((got - want).items())[:2], list((want - got).items())[:2])


# --- ranks and running sums ----------------------------------------------------------------------
def test_running_sums_over_a_key_of_many_ranges(spark):
    rows = [(k, i, (7 * i) % 5) for k, n in (("hot", 900), ("b", 3), ("c", 40)) for i in range(n)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i long, x long")
    got = {(r.k, r.i): (r.at, r.total) for r in ordered.running_sums(df, ["k"], ["i"], "at", {"total": "x"}, parts=16).collect()}
    assert got == {(k, i): (i, sum((7 * j) % 5 for j in range(i))) for k, i, _ in rows}
    assert ordered.running_sums(df.limit(0), ["k"], ["i"], "at").count() == 0


# --- 11 ------------------------------------------------------------------------------------------
def leaf_of(row):
    texts = [None if v is None else str(v).encode() for v in row]
    return sha(*("-" if t is None else b"%d:%s" % (len(t), t) for t in texts))


def plain_manifest(rows):
    groups = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        other = None
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            other = leaf_of((doc_id, source, lang, n_chars, text and text.translate(FOLD)))
        groups[source].append((doc_id, leaf_of((doc_id, source, lang, n_chars, text)), other))

    def levels(digests):
        out = [digests]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
        return out

    def path(tree, i):
        for level in tree[:-1]:
            a = i // 16 * 16
            yield level[a:i], level[i + 1:a + 16]
            i //= 16

    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: levels([x[1] for x in groups[s]]) for s in order}
    top = levels([trees[s][-1][0] for s in order]) if order else []
    out = Counter()
    for k, s in enumerate(order):
        for i, (doc_id, leaf, other) in enumerate(groups[s]):
            steps = [*path(trees[s], i), *path(top, k)]
            folded = other or leaf
            for left, right in steps:
                folded = sha(*left, folded, *right)
            proof = sha(*(d for left, right in steps for d in left + right))
            out[doc_id, leaf, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]] += 1
    return out


def manifest_rows(df):
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
            for r in merkle.document_manifest(df).collect()]


def test_parent_resumes_the_state_before_a_slot():
    children = [sha(str(i)).encode() for i in range(16)]
    parent = merkle.Parent(children)
    assert parent.digest.decode() == sha(*children)
    for slot in range(16):
        assert parent.fold(slot, b"x" * 64).decode() == sha(*children[:slot], b"x" * 64, *children[slot + 1:])
        assert parent.fold(slot, children[slot]) == parent.digest
    above = merkle.Ancestor(b"".join(children[:3]), b"".join(children[4:]))
    assert above.fold(children[3]) == parent.digest


def test_manifest_of_documents(spark):
    df = Q.table(spark, SF, "documents")
    want = plain_manifest([tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    same(manifest_rows(df), want)
    assert 0 < sum(not k[-1] for k in want)


def test_manifest_of_large_odd_and_empty_tables(spark):
    # a source of more than 4096 rows (three tiers), 300 small ones, one row alone, nulls, repeated rows, a long text
    rows = [(i, "hot" if i % 4 else f"s{i % 1200}", "en", 3, f"Text {i}") for i in range(6000)]
    odd = [(None, None, None, None, None), (None, "", None, None, ""), (7, "hot", "x", None, "ABC"), (7, "hot", "x", None, "ABC"),
           (-3, "é", "x", 2, "Ü" * 9000)]
    names = "doc_id long, source string, lang string, n_chars long, text string"
    for part in (rows + odd, odd, odd[-1:], []):
        df = spark.createDataFrame(part, names).withColumns({"id": F.lit(1), "at": F.lit("x"), "digest": F.lit(2)})
        same(manifest_rows(df), plain_manifest(part))


# --- 12 ------------------------------------------------------------------------------------------
def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(turns.get(5 * int(c / 5), [])[:h] + own[h:])
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1].encode()) if k else 0)
    return Counter((m[0], len(k), members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
                    sha(",".join(str(c) for c in m if len(rebuilt[c]) == len(k)))) for k, m in members.items())


def test_trie_of_conversations(spark):
    df = Q.table(spark, SF, "conversations")
    got = Q.op12_prefix_trie(spark, SF)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    same(map(tuple, got.collect()), plain_trie(df.select("conv_id", "turn", "role", "text").collect()))


def test_trie_of_shared_long_odd_and_empty_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LOT", 8)
    monkeypatch.setattr(prefix_trie, "IDS_A_PIECE", 8)
    rnd = random.Random(3)
    rows = [(c, i, rnd.choice("ua"), rnd.choice("xy")) for c in range(300) for i in range(rnd.choice([1, 2, 3, 12]))]
    rows += [(c, i, "u", "z") for c in (2000, 2001) for i in range(1500)]     # one long shared run
    rows += [(c, i, "u", "hot") for c in range(4000, 4200) for i in range(9)]  # copies
    odd = [(3001, None, None, None), (3001, None, "a", ""), (3001, 1, "u", "é" * 6000), (3002, 1, "u", "q"), (3002, 1, "u", "q"),
           (None, 1, "u", "q"), (-7, 1, "a", "n")]
    for part in (rows + odd, odd, [odd[5]], []):
        df = spark.createDataFrame(part, "conv_id long, turn long, role string, text string")
        got = prefix_trie.conversation_trie(df.withColumns({"p": F.lit(1), "depth": F.lit("d"), "no": F.lit(0)}))
        same(map(tuple, got.collect()), plain_trie(part))


@pytest.mark.parametrize("last", [1 << 16, 4])
def test_list_of_one_chain_and_of_scattered_elements(spark, monkeypatch, last):
    monkeypatch.setattr(prefix_trie, "LAST_CHAINS", last)  # 4: shorter lists and doubling
    for order in (list(range(300)), random.Random(5).sample(range(300), 300), [7]):
        rows = [(x, n, 1, x % 3) for x, n in zip(order, [*order[1:], None])]
        df = spark.createDataFrame(rows, "id long, next long, place long, w long")
        got = {r.id: (r.before_place, r.before_w) for r in prefix_trie.list_sums(df, ["place", "w"], len(order)).collect()}
        assert got == {x: (i, sum(y % 3 for y in order[:i])) for i, x in enumerate(order)}


# --- 13 ------------------------------------------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_hits(docs, items):
    windows = defaultdict(set)
    for i, text in items:
        words = WORD.findall((text or "").translate(FOLD))
        m = min(len(words), 10)
        for k in range(len(words) - m + 1 if m else 0):
            windows[tuple(words[k:k + m])].add(i)
    sizes = {len(w) for w in windows}
    out = Counter()
    for d, text in docs:
        words = WORD.findall((text or "").translate(FOLD))
        hit, found = set(), set()
        for m in sizes:
            for k in range(len(words) - m + 1):
                of = windows.get(tuple(words[k:k + m]))
                if of is not None:
                    hit.update(range(k, k + m))
                    found |= of
        out[d, len(words), len(hit), tuple(sorted(str(i) for i in found if i is not None))] += 1
    return out


def hits(docs, items):
    return [(r.doc_id, r.hits.n_words, r.hits.n_hit, tuple(r.hits["items"]))
            for r in decontaminate.find_passages(docs, items).collect()]


def test_passages_of_the_benchmark(spark):
    docs, items = Q.table(spark, SF, "documents"), Q.table(spark, SF, "benchmark")
    want = plain_hits(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    same(hits(docs, items), want)
    got = {r.doc_id: r for r in Q.op13_decontamination(spark, SF).collect()}
    assert sum(r.contaminated for r in got.values()) == sum(1 for k in want if k[2]) > 0
    for d, n_words, n_hit, ids in want:
        r = got[d]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            n_words, n_hit, len(ids), sha(",".join(ids)), n_hit > 0)


def odd_texts(rnd, n):
    return " ".join(rnd.choice(["A", "b", "ü", "9", "日本", "_x", "y-z", "\x00q"]) for _ in range(n))


@pytest.mark.parametrize("slice_bytes", [64 << 20, 3000])
def test_passages_of_odd_items(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(decontaminate, "RUN_WORDS", 64)
    rnd = random.Random(1)
    docs = [(i, odd_texts(rnd, rnd.choice([0, 1, 5, 30, 300]))) for i in range(200)]
    docs += [(1, None), (None, odd_texts(rnd, 40)), (2, ""), (3, "A " * 20000), (3, "A " * 20000)]
    items = [(1, None), (2, ""), (3, "a"), (4, "b ü 9"), (4, "b ü"), (None, "9 9 日本"), (11, odd_texts(rnd, 30)),
             (5, docs[3][1] + " " + docs[4][1]), (6, docs[9][1]), (7, docs[9][1])]
    items += [(20 + k, docs[k][1][3:]) for k in range(0, 200, 9)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"row": F.lit("r"), "n_words": F.lit(0)})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({"hash": F.lit(2), "words": F.lit("w")})
    same(hits(d, i), plain_hits(docs, items))
    assert hits(d.limit(0), i) == []
    assert {r[2:] for r in hits(d, i.limit(0))} == {(0, ())}


def test_spans_and_documents_are_removed(spark):
    docs = spark.createDataFrame([(1, "keep This. Is-A test, end!", 5), (2, None, 6), (3, "this is", 7), (4, "a THIS is A", 8)],
                                 "doc_id long, text string, spans int")
    items = spark.createDataFrame([(1, "this is a")], "item_id long, text string")
    cut = decontaminate.decontaminate(docs, items, "spans")
    assert cut.columns == docs.columns
    assert {(r.doc_id, r.text, r.spans) for r in cut.collect()} == {
        (1, "keep  test, end!", 5), (2, None, 6), (3, "this is", 7), (4, "a ", 8)}
    assert {r.doc_id for r in decontaminate.decontaminate(docs, items).collect()} == {2, 3}
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, items, "words")
