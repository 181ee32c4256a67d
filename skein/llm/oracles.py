"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LETTERS = r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+'"
_SPACED = r"'[^\x20\x09-\x0D]+'"

JACCARD_JOIN = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACED}) AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), often AS MATERIALIZED (SELECT g FROM s GROUP BY g HAVING count(*) > 1
), few AS MATERIALIZED (SELECT s.doc_id, s.g FROM s JOIN often USING (g)
), link AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM few x JOIN few y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.o >= 75 * (na.n + nb.n - p.o)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept, CAST(coalesce(l.n, 0) AS BIGINT) AS n_links
FROM d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) l ON l.a = d.doc_id
"""

DECONTAMINATION = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all({_LOWER}, {_ALNUM}) END AS w FROM documents
), i AS (SELECT item_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all({_LOWER}, {_ALNUM}) END AS w FROM benchmark
), iw AS MATERIALIZED (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM iw
), dw AS MATERIALIZED (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
), hit AS MATERIALIZED (SELECT DISTINCT dw.doc_id, dw.k, dw.n, iw.item_id FROM dw JOIN iw ON iw.n = dw.n AND iw.g = dw.g
), places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id
), items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NEAR_VECTORS = """
WITH RECURSIVE e AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), link AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, c.component_id = v.vec_id AS kept
FROM embeddings v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""

SOURCE_DIVERGENCE = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOWER}, {_LETTERS}) AS w FROM documents
), t AS MATERIALIZED (SELECT k, lang, source, unnest(w) AS term FROM d
), v AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 30
), n AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN v USING (lang, term) GROUP BY ALL
), g AS MATERIALIZED (SELECT g.lang, g.source, coalesce((SELECT sum(n.n) FROM n WHERE n.lang = g.lang AND n.source = g.source), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g
), l AS MATERIALIZED (SELECT lang, count(*) AS kept, sum(n) AS total FROM v GROUP BY lang
), p AS MATERIALIZED (
  SELECT g.lang, g.source, v.term, coalesce(n.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n.n, 0) + 5)) // CAST(g.total + 5 * l.kept AS HUGEINT) AS p, 1 + (CAST(1000000000 AS HUGEINT) * (v.n + 5)) // CAST(l.total + 5 * l.kept AS HUGEINT) AS q
  FROM g JOIN l USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = v.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y USING (lang, term) WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
), r AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL
  SELECT * FROM (SELECT lang, source, 'term' AS part, term AS item, p - q AS value, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS rank FROM p WHERE n > 0 AND p > q) WHERE rank <= 50
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r
"""
