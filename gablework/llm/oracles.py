"""DuckDB SQL that the queries of this subpackage must equal."""

from __future__ import annotations

# Runs of fewer than six code points give no word, spoiled or not. The CRC goes byte by byte: letters are one byte, or
# 195 and one more. Near words share what is left after one deletion, at the same place if their lengths agree.
SPELLING = """
WITH RECURSIVE
crc_table AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) AS r(i))),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{6,}')) AS run FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT run, c,
    xor(list_reduce(
      [4294967295] || flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
        lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)),
      lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc_table),
words AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                  ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6
  GROUP BY word HAVING sum(c) >= 5),
cuts AS (
  SELECT word, n, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS rest
  FROM words, range(1, 1000) AS r(i) WHERE i <= length(word)),
shorter AS (SELECT DISTINCT c.word, c.n, w.word AS near, w.n AS near_n FROM cuts c JOIN words w ON w.word = c.rest),
near AS (
  SELECT word, near, near_n FROM shorter
  UNION ALL SELECT near, word, n FROM shorter
  UNION ALL SELECT a.word, b.word, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, form, word AS root FROM formed WHERE form IS NULL
  UNION ALL SELECT f.word, f.form, chain.root FROM formed f JOIN chain ON f.form = chain.word)
SELECT f.word, f.form, chain.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain USING (word)
"""

ORACLES = {"op11_spelling_variants": SPELLING}
