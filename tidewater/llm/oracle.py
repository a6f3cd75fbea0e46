"""DuckDB SQL with the rows of the queries that SQL can express, over whole tables."""

# words are runs of characters other than 0x20 and 0x09-0x0D
_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SHINGLES = """list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)"""


def _sets(table: str, key: str, shingles: str = _SHINGLES) -> str:
    words = _WORDS.format(text=_LOWER)
    return f"(SELECT {key}, {shingles} AS s FROM (SELECT {key}, {words} AS w FROM {table}))"


_OP3 = f"""
WITH RECURSIVE sets AS MATERIALIZED (SELECT doc_id, s, len(s) AS n FROM {_sets("documents", "doc_id")}),
sh AS MATERIALIZED (SELECT doc_id, n, unnest(s) AS x FROM sets),
links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (max(a.n) + max(b.n) - count(*))),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN comp USING (doc_id)
"""

_OP5 = f"""
WITH i AS MATERIALIZED (SELECT item_id, k, len(s) AS n, unnest(s) AS x FROM (SELECT item_id, least(len(w), 5) AS k, {_SHINGLES} AS s
    FROM (SELECT item_id, {_WORDS.format(text=_LOWER)} AS w FROM benchmark))),
w AS MATERIALIZED (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
d AS MATERIALIZED (SELECT doc_id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' ')))) AS x
  FROM w, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)
SELECT doc_id, item_id, max(n) AS n_item, count(*) AS n_shared FROM d JOIN i USING (k, x)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * max(n)
"""

_OP9 = f"""
WITH w AS MATERIALIZED (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
win AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM w)),
firsts AS (SELECT x, min(doc_id) AS d FROM win GROUP BY x HAVING min(doc_id) < max(doc_id)),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM win JOIN firsts USING (x) WHERE d < doc_id),
cuts AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(g), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN g IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(g, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN cuts USING (doc_id)
"""

_OP1 = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {_WORDS.format(text="t")} AS w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM t),
n AS (SELECT *, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
  length(regexp_replace(t, '\P{{L}}', '', 'g')) AS letters, length(regexp_replace(t, '\P{{Lu}}', '', 'g')) AS upper_letters,
  len(string_split(t, chr(10))) AS n_lines FROM w),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM w)),
twice AS (SELECT doc_id, x FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS r FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM win JOIN twice USING (doc_id, x)) GROUP BY doc_id),
f AS (SELECT *, coalesce(r, 0) AS n_repeat_words FROM n LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 100 > n_words * 10 OR upper_letters * 100 > letters * 30 OR word_chars > n_words * 15 OR word_chars < n_words * 2
    OR n_dup_lines * 100 > n_lines * 50) AS kept
FROM b
"""

_GRAMS = """list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END)"""

_OP11 = f"""
WITH RECURSIVE sets AS MATERIALIZED (SELECT doc_id, s, len(s) AS n FROM {_sets("documents", "doc_id", _GRAMS)}),
sh AS MATERIALIZED (SELECT doc_id, n, unnest(s) AS x FROM sets),
links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 90 * (max(a.n) + max(b.n) - count(*))),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id FROM sets JOIN comp USING (doc_id)
"""

_OP13 = """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_inner_product(a.q, v.q)::BIGINT AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 50 = 0),
p AS MATERIALIZED (SELECT anchor_id, vec_id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER nearest)::INTEGER AS rank, s.vec_id AS negative_id,
  p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
WINDOW nearest AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER nearest <= 3
"""

SQL = {
    "op1_quality_rules": _OP1, "op3_near_dedup": _OP3, "op5_decontamination": _OP5, "op9_substring_dedup": _OP9,
    "op11_ngram_join": _OP11, "op13_hard_negatives": _OP13,
}
