"""SQL for the queries that SQL can express."""

from __future__ import annotations

DECONTAMINATE = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
    array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i
        FROM item_words WHERE len(w) > 0)),
places AS (
  SELECT doc_id, i, s.size, array_to_string(w[i : i + s.size - 1], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc_words)
  JOIN (SELECT DISTINCT size FROM windows) s ON i + s.size - 1 <= len(w)),
hits AS (SELECT p.doc_id, p.i, p.size, x.item_id FROM places p JOIN windows x USING (size, words)),
words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

URL_FILTER = r"""
WITH rules(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
rest AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0
    THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r FROM pages),
hosts AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
parts AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM hosts),
fits AS (
  SELECT p.page_id, arg_max(x.host || x.path, length(x.host || x.path)) AS rule,
    arg_max(x.verdict, length(x.host || x.path)) AS verdict
  FROM parts p JOIN rules x
    ON (p.host = x.host OR ends_with(p.host, '.' || x.host)) AND starts_with(p.path, x.path)
  GROUP BY p.page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""

TOP_PRODUCTS = """
WITH w AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM w q JOIN w c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLES = {
    "op3_decontaminate": DECONTAMINATE,
    "op10_url_filter": URL_FILTER,
    "op12_pivot_topk": TOP_PRODUCTS,
}
