"""DuckDB SQL that gives the same rows as the queries that SQL can express."""

from __future__ import annotations

CHATS = """
WITH turns AS (
  SELECT conv_id, turn, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)
),
whole AS (
  SELECT conv_id, count(*) AS n_turns, list({'r': role, 't': text} ORDER BY place) AS turns
  FROM turns GROUP BY conv_id
),
ends AS (
  SELECT min(conv_id) AS conv_id, n_turns, turns, count(*) AS copies FROM whole GROUP BY n_turns, turns
),
prefixes AS (
  SELECT DISTINCT turns[1:k] AS turns
  FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM whole)
),
kept AS (SELECT * FROM ends WHERE turns NOT IN (SELECT turns FROM prefixes))
SELECT conv_id, ((place - 1) // 256)::INTEGER AS segment, any_value(n_turns) AS n_turns,
  any_value(copies) AS copies,
  string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '')
    || '<|im_end|>' || chr(10), '' ORDER BY place) AS rendered
FROM kept JOIN turns USING (conv_id) GROUP BY ALL
"""

TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"


def _windows(words: str, size: int) -> str:
    """First places of all windows of ``size`` words, one shorter window of a shorter list."""
    return f"CASE WHEN len({words}) > 0 THEN range(1, greatest(len({words}) - {size}, 0) + 2) ELSE [] END"


HITS = f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_LETTERS}') AS w
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all({_LOWER.format('text')}, '{_LETTERS}') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
),
phrases AS (
  SELECT DISTINCT item_id, w[k:k + 12] AS p
  FROM (SELECT item_id, w, unnest({_windows('w', 13)}) AS k FROM items)
),
lengths AS (SELECT DISTINCT len(p) AS n FROM phrases),
places AS (
  SELECT doc_id, k, n, w[k:k + n - 1] AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM docs, lengths WHERE len(w) >= n)
),
hits AS (SELECT doc_id, k, n, item_id FROM places JOIN phrases USING (p)),
words_hit AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS i FROM hits) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words_hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_SPACED}') AS w
  FROM documents
),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(w[k:k + 3]) AS s
  FROM (SELECT doc_id, w, unnest({_windows('w', 4)}) AS k FROM docs)
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
  SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 100 * c >= 85 * (a.n + b.n - c)
),
edges AS MATERIALIZED (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM docs
  UNION
  SELECT doc_id, v FROM reach JOIN edges ON u = other
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

REPEATS = f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents
),
windows AS MATERIALIZED (
  SELECT doc_id, k, hash(w[k:k + 12]) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM docs WHERE len(w) >= 13)
),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS i
  FROM windows JOIN firsts USING (h) WHERE first < doc_id
),
kept AS (
  SELECT d.doc_id, count(g.i) AS n_removed,
    string_agg(d.word, ' ' ORDER BY d.i) FILTER (g.i IS NULL) AS rest
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs) d
  LEFT JOIN gone g ON g.doc_id = d.doc_id AND g.i = d.i
  GROUP BY d.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

AUDIT = f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w
  FROM documents
),
firsts AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY text),
flags AS (
  SELECT doc_id, part,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
     regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first, false)] AS f
  FROM docs JOIN firsts USING (text)
),
marked AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM flags LEFT JOIN (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
  ) USING (doc_id)
  GROUP BY part, f
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (
  SELECT filter_order, step, ascii(filter_order[step]) - 64 AS own,
    [ascii(c) - 64 FOR c IN string_split(filter_order[1:step - 1], '') IF c <> ''] AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
),
cells AS (
  SELECT part, filter_order, step, own, n, n_good, n_toxic, f[own] AS fails,
    len([k FOR k IN earlier IF f[k]]) > 0 AS gone, len([k FOR k IN f IF k]) AS k
  FROM steps, marked
),
report AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails AND k = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(n_toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM cells GROUP BY ALL
)
SELECT * EXCLUDE (own, step), step::INTEGER AS step,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM report
"""

#: The remainder of the usual CRC-32 (fixed polynomial), bit by bit over decimal digits.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(d)::BIGINT FOR d IN string_split({}::VARCHAR, '')]),
  lambda crc, d: list_reduce(list_prepend(xor(crc, d), range(8)),
    lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

TRIE = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT c, c - c % 20 AS base, {_CRC32.format('c')} % 4 AS h, list({{'r': r, 't': t}} ORDER BY place) AS own
  FROM turns GROUP BY c
),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS w
  FROM convs a LEFT JOIN convs b ON a.base = b.c
),
members AS (
  SELECT c, d, w[1:d] AS p, len(w) AS n FROM (SELECT c, w, unnest(range(0, len(w) + 1)) AS d FROM rebuilt)
),
nodes AS MATERIALIZED (
  SELECT d, p, min(c) AS rep, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '') AS ends,
    CASE WHEN d > 0 THEN len(regexp_extract_all(p[d].t, '{_SPACED}')) ELSE 0 END AS n_words
  FROM members GROUP BY d, p
),
named AS MATERIALIZED (
  SELECT n.*, above.rep AS parent
  FROM nodes n LEFT JOIN nodes above ON n.d > 0 AND above.d = n.d - 1 AND above.p = n.p[1:n.d - 1]
),
children AS (SELECT parent AS rep, d - 1 AS d, count(*) AS n_children FROM named WHERE d > 0 GROUP BY ALL),
counted AS MATERIALIZED (
  SELECT named.*, coalesce(n_children, 0) AS n_children FROM named LEFT JOIN children USING (rep, d)
),
paths AS (SELECT m.d AS at, n.rep AS top, n.d AS top_d, m.rep, m.d FROM counted m JOIN counted n
  ON n.d <= m.d AND n.p = m.p[1:n.d]),
totals AS (
  SELECT top AS rep, top_d AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * n_words) AS saved
  FROM paths JOIN counted USING (rep, d) GROUP BY ALL
)
SELECT rep AS conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves,
  saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM counted JOIN totals USING (rep, d)
"""

CHECKS = {
    "op1_chat_formatting": CHATS,
    "op3_exact_top_k": TOP_K,
    "op5_benchmark_decontamination": HITS,
    "op7_jaccard_join": JACCARD,
    "op8_substring_dedup": REPEATS,
    "op11_filter_audit": AUDIT,
    "op12_prefix_trie": TRIE,
}
