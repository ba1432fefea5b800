"""DuckDB SQL of the queries that SQL can express over whole tables (windows as joined strings; no hashing)."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SPAN_DEDUP = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(w[i:i + 49], ' ')) AS first
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50) x),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win WHERE first < doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS body
         FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)"""

_FOLDED = rf"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {_FOLDED} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_FOLDED} AS w, least(13, len(w)) AS n FROM benchmark WHERE len(w) > 0),
phrase AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b) x),
win AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM phrase) s WHERE len(w) >= n) x),
hit AS (SELECT doc_id, i, n, item FROM win JOIN phrase USING (n, g)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) x GROUP BY doc_id),
names AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN names USING (doc_id)"""

LINE_QUALITY = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) AS c
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8) x),
again AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win WHERE c > 1) x GROUP BY doc_id),
lines AS (SELECT doc_id, source, t, raw, len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS k,
            trim(regexp_replace({_LOWER.format('raw')}, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
          FROM (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS raw FROM d) x),
hosts AS (SELECT source, count(DISTINCT t) AS n FROM d GROUP BY source),
bad AS (SELECT source, line FROM (SELECT source, line, count(DISTINCT t) AS c FROM lines WHERE k > 0 GROUP BY source, line) x
        JOIN hosts USING (source) WHERE c > 10 AND c > 0.10 * n),
cut AS (SELECT doc_id, sum(k) AS n FROM lines JOIN bad USING (source, line) GROUP BY doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n FROM lines WHERE k > 0 GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
        coalesce(again.n, 0) AS n_repeat_words, coalesce(cut.n, 0) AS removed_words
      FROM d LEFT JOIN again USING (doc_id) LEFT JOIN cut USING (doc_id) LEFT JOIN dup USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(removed_words AS BIGINT) AS removed_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - removed_words >= 20 AND n_words - removed_words >= 0.5 * n_words AS kept
FROM m"""

#: Turns in order, the rebuilt conversations, every prefix as a list, and subtree sums by joining nodes to all their prefixes.
CONVERSATION_TRIE = """
WITH RECURSIVE bits(i, v, step) AS (
  SELECT i, CAST(i AS BIGINT), 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM bits WHERE step < 8),
crc(c, s, k, v) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 1, CAST(4294967295 AS BIGINT) FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL) x
  UNION ALL SELECT c, s, k + 1, xor(crc.v >> 8, bits.v) FROM crc JOIN bits ON bits.step = 8 AND bits.i = xor(crc.v, ord(substr(s, k, 1))) & 255 WHERE k <= length(s)),
heads AS (SELECT c, xor(v, 4294967295) % 6 AS h FROM crc WHERE k = length(s) + 1),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      substr(sha256(concat_ws(' ', CAST(length(coalesce(role, '')) AS VARCHAR), coalesce(role, ''), coalesce(text, ''))), 1, 32)) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
parts AS (
  SELECT heads.c, 0 AS part, t.pos, t.role, t.text FROM heads JOIN turns t ON t.c = heads.c - heads.c % 100 AND t.pos < heads.h
  UNION ALL SELECT heads.c, 1, t.pos, t.role, t.text FROM heads JOIN turns t ON t.c = heads.c AND t.pos >= heads.h),
whole AS (
  SELECT heads.c, coalesce(list({'role': p.role, 'text': p.text} ORDER BY p.part, p.pos) FILTER (WHERE p.pos IS NOT NULL), []) AS s
  FROM heads LEFT JOIN parts p ON p.c = heads.c GROUP BY heads.c),
prefixes AS (SELECT c, len(s) AS size, d, list_slice(s, 1, d) AS prefix FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM whole) x),
nodes AS (
  SELECT prefix, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = d), '')) AS ends_sha256
  FROM prefixes GROUP BY prefix, d),
linked AS (SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = list_slice(n.prefix, 1, n.depth - 1)),
counted AS (
  SELECT l.*, coalesce(k.n, 0) AS n_children FROM linked l
  LEFT JOIN (SELECT parent_conv_id AS c, depth - 1 AS d, count(*) AS n FROM linked WHERE depth > 0 GROUP BY 1, 2) k ON k.c = l.conv_id AND k.d = l.depth),
sums AS (
  SELECT list_slice(prefix, 1, d) AS top, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    sum(CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(prefix[depth].text) END) AS saved
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted) x GROUP BY 1)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, c.parent_conv_id, CAST(c.n_convs AS BIGINT) AS n_convs, CAST(c.n_children AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums s ON s.top = c.prefix"""
