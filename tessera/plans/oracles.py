"""DuckDB SQL oracles for the named queries (``__spark_entry__.oracle_sql``).

Written in SQL lists and lambdas, with the same regex strings and word lists as
the Spark plans; texts that the queries append have their results as literals
(``params.CONTRACTION_RESULT``, ``params.LEMMA_CASES``).  Tables ``documents``, ``pages`` and ``benchmark`` are views.
Doubles are rounded to 6 places and integers are BIGINT on both sides.
"""

from __future__ import annotations

from ..config import TopicConfig
from ..functions import patterns as P
from ..functions.lexicon import (CONTRACTION_SUFFIXES, CONTRACTION_WORDS, CSV_NA_SPELLINGS,
                                 DOUBLED_STEM, JUNK_LITERALS, LEMMA_EXCEPTIONS, LEMMA_RULES,
                                 SILENT_E_STEM, VERB_FORM, VERB_STEM, default_stopwords)
from ..functions.text import CONTEXT_STEPS, CONTRACTION_TRIGGER, SLANG
from . import params as Q


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(items) -> str:
    return "[" + ", ".join(lit(x) for x in items) + "]"


def rx(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(repl)}, 'g')"


# --- injected inputs (the same construction as the Spark side) --------------
def junk_text_sql() -> str:
    """Text with a junk literal (sometimes padded) on every 17th document."""
    return (f"CASE WHEN doc_id % 17 = 0 THEN "
            f"CASE WHEN doc_id % 2 = 0 THEN {lst(JUNK_LITERALS)}[(doc_id % {len(JUNK_LITERALS)}) + 1] "
            f"ELSE ' ' || {lst(JUNK_LITERALS)}[(doc_id % {len(JUNK_LITERALS)}) + 1] || chr(9) END "
            f"ELSE text END")


def url_docs_sql() -> str:
    return ("SELECT d.doc_id, CASE WHEN p.url IS NULL THEN d.text "
            "ELSE d.text || ' see ' || p.url || ' and www.' || d.source || '.example.org/x now' END AS text "
            "FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id")


def email_text_sql() -> str:
    return "text || ' mail ' || source || '.x@mail.example.co.uk, or @' || source || ' #' || lang"


# --- N1..N11 -------------------------------------------------------------------
def strip_sql(e: str) -> str:
    return rx(f"CAST({e} AS VARCHAR)", P.STRIP, "")


def null_out_sql(e: str) -> str:
    return f"CASE WHEN {e} IN ({', '.join(lit(j) for j in JUNK_LITERALS)}) THEN NULL ELSE {e} END"


def bind_sql(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for a value that is written, and computed, once."""
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def map_sql(pairs) -> str:
    keys, values = zip(*pairs)
    return f"MAP({lst(keys)}, {lst(values)})"


def contracted_word_sql(x: str, depth: int = 2) -> str:
    known = f"{map_sql(CONTRACTION_WORDS.items())}[{x}]"
    if depth == 0:
        return f"coalesce({known}, {x})"
    ends = "|".join(s for s, _ in CONTRACTION_SUFFIXES)
    stem = bind_sql(f"left({x}, length({x}) - length(e{depth}))", f"w{depth}", contracted_word_sql(f"w{depth}", depth - 1))
    rest = bind_sql(f"regexp_extract({x}, {lit(f'[a-z]({ends})$')}, 1)", f"e{depth}",
                    f"CASE WHEN e{depth} = '' THEN {x} ELSE {stem} || {map_sql(CONTRACTION_SUFFIXES)}[e{depth}] END")
    return f"coalesce({known}, {rest})"


def contractions_sql(e: str) -> str:
    told = e
    for pattern, full in CONTEXT_STEPS:
        told = rx(told, pattern, P.re2_group(full))
    full = bind_sql(contracted_word_sql("p"), "f", "CASE WHEN f <> p THEN f ELSE x END")
    word = bind_sql("replace(x, '’', '''')", "p",
                    f"CASE WHEN contains(p, '''') OR x IN ({', '.join(map(lit, SLANG))}) THEN {full} ELSE x END")
    out = (f"array_to_string(list_transform(regexp_extract_all({told}, {lit(P.WORDS_AND_GAPS)}), "
           f"lambda x: {word}), '')")
    return f"CASE WHEN regexp_matches({e}, {lit(CONTRACTION_TRIGGER)}) THEN {out} ELSE {e} END"


def clean_sql(e: str, contractions: bool = True) -> str:
    t = f"lower({e})"
    if contractions:
        t = contractions_sql(t)
    t = rx(t, P.URL, " ")
    t = rx(t, P.EMAIL, " ")
    t = rx(t, P.HANDLE, " ")
    t = rx(t, P.HASHTAG, " ")
    return f"trim({rx(t, P.NON_LETTERS, ' ')})"


# --- N12..N18 ------------------------------------------------------------------
def lemma_sql(x: str) -> str:
    known = f"MAP({lst(sorted(LEMMA_EXCEPTIONS))}, {lst(LEMMA_EXCEPTIONS[k] for k in sorted(LEMMA_EXCEPTIONS))})"
    rules = " ".join(f"WHEN regexp_matches({x}, {lit(p)}) THEN "
                     f"regexp_replace({x}, {lit(p)}, {lit(P.re2_group(t))})"
                     for p, t in LEMMA_RULES)
    stem = f"left({x}, length({x}) - CASE WHEN {x} LIKE '%ed' THEN 2 ELSE 3 END)"
    verb = (f"WHEN regexp_matches({x}, {lit(VERB_FORM)}) AND regexp_matches({stem}, {lit(VERB_STEM)}) "
            f"THEN CASE WHEN regexp_matches({stem}, {lit(DOUBLED_STEM)}) THEN left({stem}, length({stem}) - 1) "
            f"WHEN regexp_matches({stem}, {lit(SILENT_E_STEM)}) THEN {stem} || 'e' ELSE {stem} END")
    return (f"coalesce({known}[{x}], CASE WHEN NOT regexp_matches({x}, '(s|ed|ing)$') THEN {x} "
            f"{rules} {verb} ELSE {x} END)")


def tokens_sql(e: str) -> str:
    return f"list_filter(string_split({e}, ' '), lambda x: x <> '')"


def lemmas_sql(tokens: str) -> str:
    return f"list_transform({tokens}, lambda x: {lemma_sql('x')})"


def kept_sql(lemmas: str, min_len: int = 2) -> str:
    stop = lst(default_stopwords())
    return (f"list_filter({lemmas}, lambda x: NOT list_contains({stop}, x) "
            f"AND length(x) >= {min_len} AND regexp_matches(x, {lit(P.ALPHA)}))")


def prepared_cte(src: str = "documents", text: str = "text") -> str:
    """N1..N4 as CTEs ending in ``prepared(doc_id, text, lang, source)``."""
    return (f"s AS (SELECT doc_id, {null_out_sql(strip_sql(text))} AS text, lang, source FROM {src}), "
            f"nn AS (SELECT * FROM s WHERE text IS NOT NULL), "
            f"prepared AS (SELECT doc_id, text, lang, source FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM nn) WHERE rn = 1)")


def normalized_cte(src: str = "documents", text: str = "text") -> str:
    """N1..N18 -> ``normalized(doc_id, lang, source, narrative_clean)``."""
    return (prepared_cte(src, text) + ", "
            f"cl AS (SELECT doc_id, lang, source, "
            f"array_to_string({kept_sql(lemmas_sql(tokens_sql(clean_sql('text'))))}, ' ') AS c FROM prepared), "
            f"normalized AS MATERIALIZED (SELECT doc_id, lang, source, c AS narrative_clean FROM cl WHERE length(c) > 0)")


# --- V*, W* --------------------------------------------------------------------
def word_runs_sql(e: str) -> str:
    return f"regexp_split_to_array(coalesce({e}, ''), {lit(P.NOT_WORD)})"


def bow_tokens_sql(e: str) -> str:
    return f"list_filter({word_runs_sql(e)}, lambda x: regexp_matches(x, {lit(P.BOW_TOKEN)}))"


def word_tokens_sql(e: str) -> str:
    return f"list_filter({word_runs_sql(e)}, lambda x: length(x) >= 2)"


def ngram12_sql(t: str) -> str:
    return (f"list_concat({t}, list_transform(generate_series(1, len({t}) - 1), "
            f"lambda i: {t}[i] || ' ' || {t}[i + 1]))")


def tf_ctes(docs: str, text_col: str, tokens=bow_tokens_sql, binary: bool = False,
            ngram: bool = True, pre=None) -> str:
    """``toks``, ``terms``, ``tf(doc_id, term, tf)`` from a docs relation."""
    t = text_col if pre is None else pre(text_col)
    g = ngram12_sql("t") if ngram else "t"
    tfv = "1" if binary else "count(*)"
    return (f"toks AS (SELECT doc_id, {tokens(t)} AS t FROM {docs}), "
            f"terms AS (SELECT doc_id, {g} AS terms FROM toks), "
            f"tf AS MATERIALIZED (SELECT doc_id, term, CAST({tfv} AS BIGINT) AS tf FROM "
            f"(SELECT doc_id, unnest(terms) AS term FROM terms) GROUP BY doc_id, term)")


def vocab_ctes(docs: str, max_features: int | None = Q.MAX_FEATURES, min_df: int = Q.MIN_DF,
               rank_by: str = "ctf", smooth: bool = True) -> str:
    cap = f"ORDER BY {rank_by} DESC, term ASC LIMIT {max_features}" if max_features else ""
    idf = ("ln((1.0 + n) / (1.0 + df)) + 1.0" if smooth else "ln(n * 1.0 / df) + 1.0")
    return (f"stats AS (SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS ctf "
            f"FROM tf GROUP BY term), "
            f"vocab0 AS (SELECT * FROM stats WHERE df >= {min_df} {cap}), "
            f"ndocs AS (SELECT CAST(count(*) AS BIGINT) AS n FROM {docs}), "
            f"vocab AS (SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS term_id, "
            f"term, df, ctf, {idf} AS idf FROM vocab0, ndocs)")


def tfidf_ctes(sublinear: bool = True, norm: str | None = "l2") -> str:
    tfw = "(1.0 + ln(tf))" if sublinear else "CAST(tf AS DOUBLE)"
    if norm == "l2":
        val = "w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))"
    elif norm == "l1":
        val = "w / sum(abs(w)) OVER (PARTITION BY doc_id)"
    else:
        val = "w"
    return (f"w AS (SELECT doc_id, term_id, term, {tfw} * idf AS w FROM tf JOIN vocab USING (term)), "
            f"tfidf AS (SELECT doc_id, term_id, term, {val} AS value FROM w)")


def bow_ctes() -> str:
    return "bow AS (SELECT doc_id, term_id, term, CAST(tf AS DOUBLE) AS value FROM tf JOIN vocab USING (term))"


def corpus_ctes(binary: bool = False) -> str:
    """normalized -> tf -> vocab -> bow + tfidf on ``narrative_clean``."""
    return ("WITH " + normalized_cte() + ", " +
            tf_ctes("normalized", "narrative_clean", binary=binary) + ", " +
            vocab_ctes("normalized", rank_by="df" if binary else "ctf") + ", " +
            bow_ctes() + ", " + tfidf_ctes())


def r6(e: str) -> str:
    return f"round({e}, 6)"


def stats_select(rel: str, name: str) -> str:
    return (f"SELECT {lit(name)} AS name, (SELECT n FROM ndocs) AS n_rows, "
            f"(SELECT CAST(count(*) AS BIGINT) FROM vocab) AS n_cols, "
            f"CAST(count(*) AS BIGINT) AS nnz, "
            f"{r6('count(*) * 1.0 / ((SELECT n FROM ndocs) * (SELECT count(*) FROM vocab))')} AS density, "
            f"{r6('coalesce(avg(value), 0.0)')} AS mean_weight FROM {rel}")


def top_terms_select(rel: str, k: int = 5) -> str:
    return (f"SELECT CAST(row_number() OVER (ORDER BY m DESC, term DESC) AS BIGINT) AS rank, term, "
            f"{r6('m')} AS mean_weight FROM (SELECT term, sum(value) / (SELECT n FROM ndocs) AS m "
            f"FROM {rel} GROUP BY term ORDER BY m DESC, term DESC LIMIT {k})")


def lang_topics_ctes(method_rel: str = "tfidf", sfx: str = "") -> str:
    """Deterministic 'topics': one per language, term weight = sum of the
    matrix values over that language's documents; top 15 by weight."""
    return (f"lt{sfx} AS (SELECT CAST(dense_rank() OVER (ORDER BY n.lang) - 1 AS BIGINT) AS topic_id, "
            f"m.term, sum(m.value) AS weight FROM {method_rel} m JOIN normalized n USING (doc_id) "
            f"GROUP BY n.lang, m.term), "
            f"ltr{sfx} AS (SELECT topic_id, CAST(row_number() OVER (PARTITION BY topic_id "
            f"ORDER BY weight DESC, term DESC) AS BIGINT) AS rank, term, weight FROM lt{sfx}), "
            f"ltop{sfx} AS (SELECT * FROM ltr{sfx} WHERE rank <= {Q.N_TOP_TERMS})")


def overview_select(rel: str, method: str, k: int = 10) -> str:
    return (f"SELECT {lit(method)} AS method, topic_id, "
            f"string_agg(term, ', ' ORDER BY rank) AS top_{k}_terms FROM {rel} WHERE rank <= {k} "
            f"GROUP BY topic_id")


def oracle_sql() -> dict[str, str]:
    Z = {}
    pos_long = ("SELECT doc_id, CAST(generate_subscripts(l, 1) AS BIGINT) AS pos, unnest(l) AS token "
                "FROM {rel}")
    # S*
    Z["scan_csv_roundtrip"] = (f"SELECT doc_id, CASE WHEN text IN ({', '.join(lit(x) for x in CSV_NA_SPELLINGS)}) "
                               f"THEN NULL ELSE text END AS text, lang FROM documents")
    Z["scan_normalized"] = f"WITH {normalized_cte()} SELECT doc_id, narrative_clean FROM normalized"
    Z["sink_normalized"] = (f"WITH {normalized_cte()} SELECT doc_id, lang, source, narrative_clean "
                            f"FROM normalized")
    # N*
    Z["strip_text"] = f"SELECT doc_id, {strip_sql('text')} AS text FROM documents"
    Z["null_out_junk"] = (f"SELECT doc_id, {null_out_sql(strip_sql('t'))} AS text FROM "
                          f"(SELECT doc_id, {junk_text_sql()} AS t FROM documents)")
    Z["drop_null_text"] = (f"SELECT doc_id, text FROM (SELECT doc_id, {null_out_sql(strip_sql('t'))} AS text "
                           f"FROM (SELECT doc_id, {junk_text_sql()} AS t FROM documents)) WHERE text IS NOT NULL")
    Z["dedup_keep_first"] = (f"WITH src AS (SELECT doc_id, {junk_text_sql()} AS text, lang, source FROM documents), "
                             f"{prepared_cte('src')} SELECT doc_id, text FROM prepared")
    Z["lowercase_text"] = "SELECT doc_id, lower(text) AS text FROM documents"
    Z["expand_contractions"] = (f"SELECT doc_id, {contractions_sql('lower(text)')} || "
                                f"{lit(Q.CONTRACTION_RESULT)} AS text FROM documents")
    Z["strip_urls"] = f"SELECT doc_id, {rx('lower(text)', P.URL, ' ')} AS text FROM ({url_docs_sql()})"
    Z["strip_emails"] = (f"SELECT doc_id, {rx('lower(t)', P.EMAIL, ' ')} AS text FROM "
                         f"(SELECT doc_id, {email_text_sql()} AS t FROM documents)")
    Z["strip_handles"] = (f"SELECT doc_id, {rx('lower(t)', P.HANDLE, ' ')} AS text FROM "
                          f"(SELECT doc_id, {email_text_sql()} AS t FROM documents)")
    Z["strip_hashtags"] = (f"SELECT doc_id, {rx('lower(t)', P.HASHTAG, ' ')} AS text FROM "
                           f"(SELECT doc_id, {email_text_sql()} AS t FROM documents)")
    Z["letters_only"] = (f"SELECT doc_id, trim({rx('lower(text)', P.NON_LETTERS, ' ')}) AS text "
                         f"FROM documents")
    Z["normalize_texts"] = (f"SELECT doc_id, {clean_sql('t')} AS text FROM "
                            f"(SELECT doc_id, {email_text_sql()} || {lit(Q.CONTRACTION_SUFFIX_TEXT)} AS t "
                            f"FROM ({url_docs_sql()}) JOIN (SELECT doc_id, source, lang FROM documents) USING (doc_id))")
    cleaned = f"(SELECT doc_id, {clean_sql('text')} AS c FROM documents)"
    Z["tokenize"] = pos_long.format(rel=f"(SELECT doc_id, {tokens_sql('c')} AS l FROM {cleaned})")
    Z["lemmatize_dict"] = pos_long.format(
        rel=f"(SELECT doc_id, list_concat({lemmas_sql(tokens_sql('c'))}, "
            f"{lst(Q.LEMMA_CASES.values())}) AS l FROM {cleaned})")
    Z["lemmatize_context"] = pos_long.format(
        rel=f"(SELECT doc_id, list_concat({lemmas_sql(tokens_sql('c'))}, string_split("
            f"{lst(Q.CONTEXT_CASES.values())}[doc_id % {len(Q.CONTEXT_CASES)} + 1], ' ')) AS l FROM {cleaned})")
    # of the two lemmas that the dictionary gives a form, the first in order is the shorter
    Z["lemmatize_user_dict"] = (
        f"WITH forms AS (SELECT DISTINCT unnest({tokens_sql(clean_sql('text'))}) AS form FROM benchmark), "
        f"t AS ({pos_long.format(rel=f'(SELECT doc_id, {tokens_sql(chr(99))} AS l FROM {cleaned})')}) "
        f"SELECT doc_id, pos, CASE WHEN form IS NULL THEN {lemma_sql('token')} ELSE left(token, 3) END AS token "
        f"FROM t LEFT JOIN forms ON form = token")
    stop = lst(default_stopwords())
    Z["remove_stopwords"] = pos_long.format(
        rel=f"(SELECT doc_id, list_filter({lemmas_sql(tokens_sql('c'))}, lambda x: NOT list_contains({stop}, x)) AS l FROM {cleaned})")
    Z["min_token_len"] = pos_long.format(
        rel=f"(SELECT doc_id, list_filter({tokens_sql('c')}, lambda x: length(x) >= {Q.MIN_TOKEN_LEN_QUERY}) AS l FROM {cleaned})")
    Z["alpha_tokens"] = pos_long.format(
        rel=f"(SELECT doc_id, list_filter(string_split(lower(text), ' '), lambda x: regexp_matches(x, {lit(P.ALPHA)})) AS l FROM documents)")
    Z["drop_empty_docs"] = f"WITH {normalized_cte()} SELECT doc_id FROM normalized"
    Z["normalize_corpus"] = f"WITH {normalized_cte()} SELECT doc_id, lang, source, narrative_clean FROM normalized"
    Z["stage_incremental"] = Z["normalize_corpus"]
    # V*
    Z["bow_tokens"] = pos_long.format(rel=f"(SELECT doc_id, {bow_tokens_sql('text')} AS l FROM documents)")
    Z["tfidf_tokens"] = pos_long.format(rel=f"(SELECT doc_id, {word_tokens_sql('text')} AS l FROM documents)")
    Z["ngrams_1_2"] = pos_long.format(
        rel=f"(SELECT doc_id, {ngram12_sql('t')} AS l FROM (SELECT doc_id, {tokens_sql('c')} AS t FROM {cleaned}))")
    P0 = corpus_ctes()
    Z["term_counts"] = f"{P0} SELECT doc_id, term, tf FROM tf"
    Z["doc_frequency"] = f"{P0} SELECT term, df, ctf FROM stats WHERE df >= {Q.MIN_DF}"
    Z["vocab_topk"] = f"{P0} SELECT term, df, ctf FROM vocab0"
    Z["vocab_index"] = f"{P0} SELECT term_id, term FROM vocab"
    Z["feature_list"] = f"{P0} SELECT term_id, term AS feature FROM vocab"
    Z["bow_matrix"] = f"{P0} SELECT doc_id, term_id, term, value FROM bow"
    Z["matrix_coo"] = f"{P0} SELECT doc_id, term_id, CAST(round(value, 6) AS FLOAT) AS value FROM tfidf"
    Z["zero_row_docs"] = (f"{P0} SELECT n.doc_id, CAST(count(b.term_id) AS BIGINT) AS nnz FROM normalized n "
                          f"LEFT JOIN bow b USING (doc_id) GROUP BY n.doc_id")
    PB = corpus_ctes(binary=True)
    Z["bow_binary"] = f"{PB} SELECT doc_id, term_id, term, value FROM bow"
    Z["tf_sublinear"] = (f"{P0} SELECT doc_id, term, {r6('1.0 + ln(tf)')} AS tf_weight FROM tf "
                         f"WHERE term IN (SELECT term FROM vocab)")
    Z["idf_smooth"] = f"{P0} SELECT term_id, term, df, {r6('idf')} AS idf FROM vocab"
    Z["idf_plain"] = (f"{P0} SELECT term_id, term, df, {r6('ln((SELECT n FROM ndocs) * 1.0 / df) + 1.0')} AS idf "
                      f"FROM vocab")
    Z["tfidf_matrix"] = f"{P0} SELECT doc_id, term_id, term, {r6('value')} AS value FROM tfidf"
    base_nt = ("WITH " + normalized_cte() + ", " + tf_ctes("normalized", "narrative_clean") + ", " +
               vocab_ctes("normalized") + ", ")
    Z["tfidf_l2"] = (base_nt + tfidf_ctes(sublinear=False, norm="l2") +
                     f" SELECT doc_id, term_id, term, {r6('value')} AS value FROM tfidf")
    Z["tfidf_l1"] = (base_nt + tfidf_ctes(sublinear=True, norm="l1") +
                     f" SELECT doc_id, term_id, term, {r6('value')} AS value FROM tfidf")
    raw_docs = "(SELECT doc_id, text FROM documents)"
    Z["bow_lowercase"] = ("WITH " + tf_ctes(raw_docs, "text", pre=lambda c: f"lower({c})") +
                          ", " + vocab_ctes(raw_docs) + ", " + bow_ctes() +
                          " SELECT doc_id, term_id, term, value FROM bow")
    Z["bow_strip_accents"] = ("WITH " + tf_ctes(raw_docs, "text",
                                                pre=lambda c: f"strip_accents(lower({c}))") +
                              ", " + vocab_ctes(raw_docs) + ", " + bow_ctes() +
                              " SELECT doc_id, term_id, term, value FROM bow")
    Z["bow_raw_narrative"] = ("WITH " + tf_ctes(raw_docs, "text") + ", " + vocab_ctes(raw_docs) + ", " +
                              bow_ctes() + " SELECT doc_id, term_id, term, value FROM bow")
    Z["tfidf_raw_narrative"] = ("WITH " + tf_ctes(raw_docs, "text", tokens=word_tokens_sql) + ", " +
                                vocab_ctes(raw_docs) + ", " + tfidf_ctes() +
                                f" SELECT doc_id, term_id, term, {r6('value')} AS value FROM tfidf")
    bench = "(SELECT item_id AS doc_id, text FROM benchmark)"
    fixed = (normalized_cte() + ", " + tf_ctes("normalized", "narrative_clean") + ", " +
             vocab_ctes("normalized") + ", " +
             "bclean AS (SELECT doc_id, array_to_string(" + kept_sql(lemmas_sql(tokens_sql(clean_sql("text")))) +
             f", ' ') AS c FROM {bench}), "
             "btoks AS (SELECT doc_id, " + bow_tokens_sql("c") + " AS t FROM bclean), "
             "bterms AS (SELECT doc_id, " + ngram12_sql("t") + " AS terms FROM btoks), "
             "btf AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM "
             "(SELECT doc_id, unnest(terms) AS term FROM bterms) GROUP BY doc_id, term)")
    Z["bow_fixed_vocab"] = (f"WITH {fixed} SELECT doc_id, term_id, term, CAST(tf AS DOUBLE) AS value "
                            f"FROM btf JOIN vocab USING (term)")
    given = ", ".join(f"({lit(t)}, {i})" for t, i in Q.USER_VOCABULARY.items())
    Z["bow_user_vocab"] = ("WITH " + tf_ctes(raw_docs, "text", pre=lambda c: f"lower({c})") +
                           f", given(term, term_id) AS (VALUES {given}) SELECT doc_id, CAST(term_id AS BIGINT) AS term_id, term, "
                           "CAST(tf AS DOUBLE) AS value FROM tf JOIN given USING (term)")
    Z["tfidf_fixed_vocab"] = (f"WITH {fixed}, bw AS (SELECT doc_id, term_id, term, (1.0 + ln(tf)) * idf AS w "
                              f"FROM btf JOIN vocab USING (term)) SELECT doc_id, term_id, term, "
                              f"{r6('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))')} AS value FROM bw")
    # A*, S9, S14, T12
    Z["matrix_stats"] = f"{P0} {stats_select('bow', 'BoW')} UNION ALL {stats_select('tfidf', 'TF-IDF')}"
    Z["term_mean_weight"] = (f"{P0} SELECT 'bow' AS method, term_id, term, {r6('sum(value) / (SELECT n FROM ndocs)')} AS mean_weight "
                             f"FROM bow GROUP BY term_id, term UNION ALL "
                             f"SELECT 'tfidf' AS method, term_id, term, {r6('sum(value) / (SELECT n FROM ndocs)')} AS mean_weight "
                             f"FROM tfidf GROUP BY term_id, term")
    Z["top_terms_bow"] = f"{P0} {top_terms_select('bow')}"
    Z["top_terms_tfidf"] = f"{P0} {top_terms_select('tfidf')}"
    Z["vectorization_meta"] = (f"{P0} SELECT 'bow' AS method, (SELECT n FROM ndocs) AS n_rows, "
                               f"(SELECT CAST(count(*) AS BIGINT) FROM vocab) AS n_cols, "
                               f"(SELECT CAST(count(*) AS BIGINT) FROM bow) AS nnz, "
                               f"(SELECT CAST(count(*) AS BIGINT) FROM vocab) AS n_features, "
                               f"'CountVectorizer' AS vectorizer_type")
    line = ("printf('%s: shape=(%d, %d), nnz=%d, density=%.6f, mean_weight=%.6f', {name}, "
            "(SELECT n FROM ndocs), (SELECT count(*) FROM vocab), count(*), "
            "count(*) * 1.0 / ((SELECT n FROM ndocs) * (SELECT count(*) FROM vocab)), "
            "coalesce(avg(value), 0.0))")
    top = ("(SELECT string_agg(term, ', ' ORDER BY m DESC, term DESC) FROM (SELECT term, "
           "sum(value) / (SELECT n FROM ndocs) AS m FROM {rel} GROUP BY term "
           "ORDER BY m DESC, term DESC LIMIT 5))")
    Z["vectorization_report"] = (
        f"{P0} SELECT CAST(0 AS BIGINT) AS line_no, '=== VECTORISATION COMPARISON REPORT ===' AS line "
        f"UNION ALL SELECT 1, '' UNION ALL SELECT 4, '' UNION ALL SELECT 5, 'Top 5 terms by mean weight:' "
        f"UNION ALL SELECT 6, '' "
        f"UNION ALL SELECT 2, {line.format(name=lit('BoW'))} FROM bow "
        f"UNION ALL SELECT 3, {line.format(name=lit('TF-IDF'))} FROM tfidf "
        f"UNION ALL SELECT 7, 'BoW top-5 terms: ' || {top.format(rel='bow')} "
        f"UNION ALL SELECT 8, 'TF-IDF top-5 terms: ' || {top.format(rel='tfidf')}")
    Z["feature_variance_total"] = (f"{P0} SELECT {r6('coalesce(sum(v), 0.0)')} AS total_variance FROM "
                                   f"(SELECT sum(value * value) / (SELECT n FROM ndocs) - "
                                   f"pow(sum(value) / (SELECT n FROM ndocs), 2) AS v FROM tfidf GROUP BY term_id)")
    Z["topics_meta_counts"] = (f"WITH {normalized_cte()} SELECT 'lsa_tfidf' AS method, "
                               f"CAST({Q.N_TOPICS} AS BIGINT) AS n_topics, CAST(count(*) AS BIGINT) AS n_docs "
                               f"FROM normalized")
    # exact properties of the topic models
    topic_ids = f"generate_series(0, {Q.N_TOPICS - 1})"
    Z["lda_term_mass"] = f"{P0} SELECT term, {r6('CAST(ctf AS DOUBLE) + 1')} AS mass FROM vocab"
    Z["lda_doc_topic_sums"] = (f"WITH {normalized_cte()} SELECT doc_id, CAST({Q.N_TOPICS} AS BIGINT) AS n_topics, "
                               f"CAST(1 AS DOUBLE) AS weight_sum FROM normalized")
    cfg = TopicConfig()
    Z["lda_online_mass"] = (
        f"{P0}, lots AS (SELECT doc_id, ('0x' || left(md5(CAST(doc_id AS VARCHAR)), 8))::BIGINT % {cfg.mini_batches} AS lot FROM normalized), "
        f"sizes AS (SELECT lot, count(*) AS n, row_number() OVER (ORDER BY lot) - 1 AS place, count(*) OVER () AS m FROM lots GROUP BY lot), "
        f"steps AS (SELECT lot, n, p * m + place AS t, pow({cfg.learning_offset} + p * m + place, -{cfg.learning_decay}) AS rho "
        f"FROM sizes, (SELECT unnest(range({Q.N_ITER})) AS p)), "
        f"kept AS (SELECT lot, n, rho * exp(coalesce(sum(ln(1 - rho)) OVER (ORDER BY t DESC ROWS BETWEEN UNBOUNDED PRECEDING "
        f"AND 1 PRECEDING), 0)) AS c FROM steps), "
        f"bylot AS (SELECT lot, sum(c) * (SELECT count(*) FROM normalized) / max(n) AS a FROM kept GROUP BY lot), "
        f"seen AS (SELECT term, sum(tf * a) AS mass FROM tf JOIN lots USING (doc_id) JOIN bylot USING (lot) GROUP BY term) "
        f"SELECT term, {r6('seen.mass + (SELECT sum(c) FROM kept)')} AS mass FROM vocab JOIN seen USING (term)")
    Z["lda_online_reads"] = (
        f"WITH {normalized_cte()}, lots AS (SELECT ('0x' || left(md5(CAST(doc_id AS VARCHAR)), 8))::BIGINT % {cfg.mini_batches} AS lot "
        f"FROM normalized) SELECT pass, count(DISTINCT lot) AS n_updates, count(*) AS n_read "
        f"FROM lots, (SELECT unnest(range({Q.N_ITER})) AS pass) GROUP BY pass")
    Z["lsa_spectrum_moments"] = (
        "WITH x AS (SELECT row_number() OVER () AS r, embedding FROM embeddings), "
        "e AS (SELECT r, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS j FROM x), "
        "gram AS (SELECT sum(a.v * b.v) AS g FROM e a JOIN e b USING (r) GROUP BY a.j, b.j) "
        "SELECT CAST(2 AS BIGINT) AS power, round(sum(v * v), 3) AS total FROM e UNION ALL "
        "SELECT CAST(4 AS BIGINT), round(sum(g * g), 3) FROM gram")
    Z["lsa_doc_topic_norms"] = (f"WITH {normalized_cte()}, {tf_ctes('normalized', 'narrative_clean')}, {vocab_ctes('normalized')} "
                                f"SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM tf JOIN vocab USING (term)) "
                                f"THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS norm FROM normalized")
    Z["lsa_coordinate_energy"] = f"SELECT unnest({topic_ids}) AS topic_id, CAST(1 AS DOUBLE) AS share"
    Z["lsa_gram"] = (f"SELECT a AS topic_a, b AS topic_b, CAST(a = b AS DOUBLE) AS product FROM "
                     f"(SELECT unnest({topic_ids}) AS a), (SELECT unnest({topic_ids}) AS b)")
    Z["lsa_signs"] = f"SELECT unnest({topic_ids}) AS topic_id, true AS positive"
    Z["topic_rank_counts"] = (f"SELECT method, topic_id, CAST({Q.N_TOP_TERMS} AS BIGINT) AS n_terms, "
                              f"CAST({Q.N_TOP_TERMS} AS BIGINT) AS last_rank, CAST(0 AS BIGINT) AS rises FROM "
                              f"(SELECT unnest(['lsa_tfidf', 'lda_bow']) AS method), (SELECT unnest({topic_ids}) AS topic_id)")
    Z["doc_topic_wide_shape"] = (f"WITH {normalized_cte()} SELECT CAST(count(*) AS BIGINT) AS n_rows, "
                                 f"CAST(count(*) AS BIGINT) AS n_docs, CAST({Q.N_TOPICS + 1} AS BIGINT) AS n_columns FROM normalized")
    # R1, R2, A10, U1, P1, P2 on the deterministic by-language topics
    PL = P0 + ", " + lang_topics_ctes("tfidf")
    Z["topic_term_rank_by_lang"] = (f"{PL} SELECT 'lang_tfidf' AS method, topic_id, rank, term, "
                                    f"{r6('weight')} AS weight FROM ltop")
    Z["topic_overview_by_lang"] = f"{PL} {overview_select('ltop', 'lang_tfidf')}"
    PL2 = P0 + ", " + lang_topics_ctes("tfidf") + ", " + lang_topics_ctes("bow", "2")
    Z["topics_comparison_by_lang"] = (f"{PL2} {overview_select('ltop', 'lang_tfidf')} UNION ALL "
                                      f"{overview_select('ltop2', 'lang_bow')}")
    Z["normalize_topics"] = (f"{PL} SELECT 'objects' AS shape, topic_id, rank, term, {r6('weight')} AS weight FROM ltop "
                             f"UNION ALL SELECT 'pairs' AS shape, topic_id, rank, term, {r6('weight')} AS weight FROM ltop "
                             f"UNION ALL SELECT 'lists' AS shape, topic_id, rank, term, CAST(NULL AS DOUBLE) AS weight FROM ltop")
    Z["term_weight_pairs"] = (f"{PL} SELECT topic_id, rank, term, "
                              f"CASE WHEN rank % 3 = 0 THEN NULL ELSE {r6('weight')} END AS weight FROM ltop")
    return Z
