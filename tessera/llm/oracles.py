"""DuckDB SQL for the ``opN_`` queries that SQL can express."""

from __future__ import annotations

OP6 = """
WITH turns AS (
  SELECT conv_id, coalesce(turn, 0) AS turn, turn IS NOT NULL AS numbered,
         coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|im_', '<| im_') AS said
  FROM conversations),
said AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY numbered, turn, speaker, said) - 1) // 512 AS part FROM turns),
speakers AS (SELECT DISTINCT conv_id AS of_conv, speaker AS perspective FROM said WHERE speaker <> 'system'),
shown AS (
  SELECT conv_id, perspective, part, speaker = perspective AS own, numbered, turn, speaker, said,
         '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
           ELSE 'user name=' || replace(speaker, '<|im_', '<| im_') END || chr(10) AS head
  FROM said JOIN speakers ON conv_id IS NOT DISTINCT FROM of_conv),
pieces AS (SELECT *, head || said || '<|im_end|>' || chr(10) AS piece FROM shown),
placed AS (
  SELECT *, sum(length(piece)) OVER w - length(piece) AS pos, row_number() OVER w AS k
  FROM pieces WINDOW w AS (PARTITION BY conv_id, perspective, part ORDER BY numbered, turn, speaker, said
                           ROWS UNBOUNDED PRECEDING)),
parts AS (
  SELECT conv_id, perspective, part, count(*) AS n_turns, sum(length(piece)) AS chars,
         string_agg(piece, '' ORDER BY k) AS text,
         coalesce(string_agg((pos + length(head))::BIGINT || '-' || (pos + length(piece) - 1)::BIGINT, ',' ORDER BY k)
           FILTER (WHERE own), '') AS masks
  FROM placed GROUP BY conv_id, perspective, part)
SELECT conv_id, perspective, part, n_turns,
       coalesce(sum(chars) OVER (PARTITION BY conv_id, perspective ORDER BY part
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
       text, masks
FROM parts
"""

OP7 = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT rowid_ AS r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT row_number() OVER () AS rowid_, words FROM w), LATERAL (SELECT unnest(range(1, len(words) - 1)) AS i)),
repeats AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM repeats, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
counts AS (
  SELECT doc_id, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - coalesce(len(list_distinct(lines)), 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines,
         len(regexp_extract_all(text, '\p{L}')) AS letters, len(regexp_extract_all(text, '\p{Lu}')) AS upper,
         len(list_filter(words, lambda x: regexp_matches(x, '[\p{L}\p{N}]'))) AS lettered
  FROM (SELECT row_number() OVER () AS r, * FROM w) w LEFT JOIN covered USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * n_words
            OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2.5 * n_words OR word_chars > 15.0 * n_words
            OR 100 * upper > 50 * letters OR 100 * lettered < 60 * n_words) AS kept
FROM counts
"""

OP9 = r"""
WITH pages AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
split AS (SELECT r, coalesce(source, '') AS host, text, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM pages),
bare AS (SELECT r, host, text, line, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS b FROM split),
totals AS (SELECT host, count(*) AS host_pages FROM (SELECT DISTINCT coalesce(source, '') AS host, text FROM documents) GROUP BY 1),
found AS (
  SELECT host, b FROM (SELECT host, b, count(DISTINCT text) AS n FROM bare WHERE b <> '' GROUP BY host, b)
  JOIN totals USING (host) WHERE n >= 3 AND n > 0.05 * host_pages),
kept AS (
  SELECT r, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
  FROM bare LEFT JOIN (SELECT host, b, TRUE AS hit FROM found) USING (host, b) WHERE hit IS NULL GROUP BY r)
SELECT doc_id, source, CASE WHEN pages.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
       (coalesce(len(lines), 0) - coalesce(kept.n, 0))::BIGINT AS n_dropped
FROM pages LEFT JOIN kept USING (r)
"""


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of an ASCII text, bit by bit."""
    byte = ("list_reduce(list_prepend(xor(crc, ch), range(8)), "
            "lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)")
    chars = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {chars}), lambda crc, ch: {byte}), 4294967295)"


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _tree(prefix: str, levels: int) -> str:
    """CTEs ``prefix_nodes0..levels`` (g, i, digest) and ``prefix_runs0..`` (g, p, ds, n) above ``prefix_nodes0``."""
    out = []
    for k in range(levels):
        out.append(f"""
{prefix}_runs{k} AS (
  SELECT g, i // 16 AS p, list(digest ORDER BY i) AS ds, max(n) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {prefix}_nodes{k}) GROUP BY g, i // 16),
{prefix}_nodes{k + 1} AS (
  SELECT g, p AS i, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS digest FROM {prefix}_runs{k}),""")
    return "".join(out)


def _climb(prefix: str, levels: int, start: str) -> str:
    """CTEs that carry ``start`` (r, g, i, folded, proof) up the levels of a tree."""
    out, before = [], start
    for k in range(levels):
        out.append(f"""
{prefix}_at{k + 1} AS (
  SELECT r, s.g, s.i // 16 AS i,
         CASE WHEN n = 1 THEN folded ELSE sha256(array_to_string(ds[:s.i % 16], '') || folded || array_to_string(ds[s.i % 16 + 2:], '')) END AS folded,
         CASE WHEN n = 1 THEN proof ELSE proof || array_to_string(ds[:s.i % 16], '') || array_to_string(ds[s.i % 16 + 2:], '') END AS proof
  FROM {before} s JOIN {prefix}_runs{k} u ON s.g = u.g AND s.i // 16 = u.p),""")
        before = f"{prefix}_at{k + 1}"
    return "".join(out)


#: 16 ** 8 rows a source and sources.
_LEVELS = 8
OP11 = f"""
WITH hashed AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS g,
         sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text")))}) AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN sha256(
           {" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))} ||
           {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS tampered
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, tampered NULLS FIRST) - 1 AS i FROM hashed),
low_nodes0 AS (SELECT g, i, leaf AS digest FROM leaves),{_tree("low", _LEVELS)}
subroots AS (SELECT g, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS i FROM low_nodes{_LEVELS}),
top_nodes0 AS (SELECT 0 AS g, i, subroot AS digest FROM subroots),{_tree("top", _LEVELS)}
low_at0 AS (SELECT r, g, i, coalesce(tampered, leaf) AS folded, '' AS proof FROM leaves),{_climb("low", _LEVELS, "low_at0")}
top_at0 AS (SELECT r, 0 AS g, subroots.i, folded, proof FROM low_at{_LEVELS} l JOIN subroots ON l.g = subroots.g),{_climb("top", _LEVELS, "top_at0")}
root AS (SELECT digest AS root FROM top_nodes{_LEVELS})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves JOIN subroots USING (g) JOIN top_at{_LEVELS} t ON leaves.r = t.r, root
"""

OP12 = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS k
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT c, c - c % 5 AS base, {_crc32("c::VARCHAR")} % 9 AS h FROM turns),
rebuilt AS (
  SELECT convs.c, 0 AS part, k, role, text FROM convs JOIN turns ON turns.c = base AND k < h
  UNION ALL SELECT convs.c, 1, k, role, text FROM convs JOIN turns ON turns.c = convs.c AND k >= h),
placed AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, k) AS depth, role, text FROM rebuilt),
prefixes AS (
  SELECT c, depth, string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (
           PARTITION BY c ORDER BY depth ROWS UNBOUNDED PRECEDING) AS p, strlen(text) AS n_bytes FROM placed
  UNION ALL SELECT c, 0, '', 0 FROM convs),
nodes AS (SELECT p, depth, min(c) AS conv_id, count(*) AS n_convs, min(n_bytes) AS n_bytes FROM prefixes GROUP BY p, depth),
kids AS (SELECT p[:64 * (depth - 1)] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
sums AS (
  SELECT above AS p, count(*) FILTER (kid IS NULL) AS n_leaves, sum((n_convs - 1) * n_bytes)::BIGINT AS saved_tokens
  FROM (SELECT n.*, kids.n AS kid, p[:64 * unnest(range(0, depth + 1))] AS above FROM nodes n LEFT JOIN kids USING (p)) GROUP BY above),
ends AS (
  SELECT p, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
  FROM (SELECT c, arg_max(p, depth) AS p FROM prefixes GROUP BY c) GROUP BY p)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN sums USING (p) LEFT JOIN kids USING (p) LEFT JOIN ends USING (p)
LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.p = n.p[:64 * (n.depth - 1)]
"""

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
OP13 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, m, array_to_string(words[k:k + m - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - m + 2)) AS k
        FROM (SELECT *, least(len(words), 10) AS m FROM items WHERE len(words) > 0))),
found AS (
  SELECT r, k, m, item_id
  FROM (SELECT r, m, k, array_to_string(words[k:k + m - 1], ' ') AS w
        FROM (SELECT r, words, m, unnest(range(1, len(words) - m + 2)) AS k FROM docs, (SELECT DISTINCT m FROM windows)))
  JOIN windows USING (m, w)),
hit AS (SELECT r, count(DISTINCT word) AS n FROM (SELECT r, k + unnest(range(m)) AS word FROM found) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(listed.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_chat_views": OP6, "op7_quality_rules": OP7, "op9_line_dedup": OP9, "op11_merkle_manifest": OP11,
            "op12_prefix_trie": OP12, "op13_decontamination": OP13}
