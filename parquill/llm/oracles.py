"""DuckDB forms of the operators that SQL expresses, straight from their definitions.

The others have none: scores of a hashed model, line families in hashed orders, subword merging,
balanced shards and trained networks.
"""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_ITEM_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("text"))

SUBSTRING = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS ws FROM documents),
starts AS (SELECT r, doc_id, unnest(range(1, len(ws) - 48)) AS s, ws FROM d WHERE len(ws) >= 50 AND doc_id IS NOT NULL),
windows AS MATERIALIZED (SELECT r, doc_id, s, array_to_string(ws[s : s + 49], ' ') AS w FROM starts),
firsts AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 50)) AS p FROM windows JOIN firsts USING (w) WHERE doc_id > least),
placed AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (
  SELECT r, array_to_string(list(word ORDER BY p), ' ') AS kept, count(*) AS n FROM placed ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

JACCARD = rf"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS ws FROM documents),
sets AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS shingles FROM d
),
each AS MATERIALIZED (SELECT r, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
pairs AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM each a JOIN each b ON a.shingle = b.shingle AND a.r < b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
),
links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reached AS (SELECT r AS a, r AS b FROM sets UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
classes AS (SELECT reached.a AS r, min(doc_id) AS class_id FROM reached JOIN sets ON sets.r = reached.b GROUP BY reached.a),
counts AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, class_id, coalesce(n, 0)::BIGINT AS n_links, len(shingles)::BIGINT AS n_shingles, coalesce(doc_id = class_id, true) AS kept
FROM sets JOIN classes USING (r) LEFT JOIN counts USING (r)
"""

URLS = rf"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
cut AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS body FROM pages),
parts AS (SELECT r, page_id, body, regexp_extract(body, '^[^/?#]*') AS raw FROM cut),
urls AS MATERIALIZED (SELECT r, page_id, {_LOWER.format("raw")} AS host, regexp_extract(substr(body, length(raw) + 1), '^[^?#]*') AS path FROM parts),
fits AS (
  SELECT r, r_host || r_path AS rule, r_verdict FROM urls JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(r_host || r_path) DESC, length(r_host) DESC) = 1
)
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (r)
"""

EMBEDDINGS = """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
usable AS MATERIALIZED (
  SELECT vec_id, label, e FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id < b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
),
links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reached AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

DECONTAMINATION = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS ws FROM documents),
items AS (SELECT item_id, {_ITEM_WORDS} AS ws FROM benchmark),
spans AS (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS s FROM items WHERE len(ws) > 0),
known AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(ws[s : s + n - 1], ' ') AS w FROM spans),
starts AS (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d JOIN (SELECT DISTINCT n FROM known) sizes ON len(ws) >= n),
found AS MATERIALIZED (
  SELECT r, s, n, item_id FROM (SELECT r, s, n, array_to_string(ws[s : s + n - 1], ' ') AS w FROM starts) JOIN known USING (n, w)
),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM found) GROUP BY r),
own AS (
  SELECT r, count(*) AS n_items, array_to_string(list(item ORDER BY item), ',') AS listed
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN own USING (r)
"""
