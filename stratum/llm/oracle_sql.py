"""DuckDB SQL for the queries whose result SQL can state, written the plain way."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_WORD = r"'[^\x20\x09-\x0D]+'"
_ITEM_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

ORACLES: dict[str, str] = {}

ORACLES["op1_near_duplicates"] = f"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {_WORD}) AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda p: w[p] || ' ' || w[p + 1])
                                      ELSE w END) AS s
  FROM split
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM pairs JOIN sizes i ON i.doc_id = x JOIN sizes j ON j.doc_id = y
  WHERE 100 * c >= 80 * (i.n + j.n - c)
),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS seen FROM documents
  UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.seen
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(seen) AS component_id, d.doc_id = min(seen) AS kept
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
GROUP BY d.doc_id, n
"""

ORACLES["op4_substring_dedup"] = f"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
windows AS (
  SELECT doc_id, p, sha256(array_to_string(w[p:p + 49], ' ')) AS h
  FROM split, unnest(range(1, len(w) - 48)) AS t(p) WHERE len(w) >= 50
),
firsts AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q
  FROM windows JOIN firsts USING (h) WHERE first_id < doc_id
),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM split),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS t FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id
),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM split s LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES["op9_decontamination"] = f"""
WITH split AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {_ITEM_WORD}) AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOWERED}, {_ITEM_WORD}) AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, w[p:p + least(10, len(w)) - 1] AS g
  FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(p) WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT k FROM item_windows),
windows AS (
  SELECT doc_id, p, k, w[p:p + k - 1] AS g
  FROM split, lengths, unnest(range(1, len(w) - k + 2)) AS t(p) WHERE len(w) >= k
),
hits AS (SELECT doc_id, p, x.k, CAST(item_id AS VARCHAR) AS item FROM windows x JOIN item_windows y ON x.k = y.k AND x.g = y.g),
covered AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM split s LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
