"""DuckDB statements for the queries of this folder that SQL can express."""

from __future__ import annotations

OP1 = """
WITH RECURSIVE h AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS bits,
         strlen(coalesce(text, '')) AS n_bytes
  FROM documents
),
split(depth, prefix, shard_bytes, shard_rows, fits) AS (
  SELECT 0, 0::BIGINT, sum(n_bytes)::BIGINT, count(*), sum(n_bytes) <= 1048576 OR min(bits) = max(bits) FROM h
  UNION ALL
  (SELECT s.depth + 1, h.bits >> (59 - s.depth), sum(h.n_bytes)::BIGINT, count(*),
          sum(h.n_bytes) <= 1048576 OR min(h.bits) = max(h.bits)
   FROM split s JOIN h ON (h.bits >> (60 - s.depth)) = s.prefix
   WHERE NOT s.fits AND s.depth < 60
   GROUP BY 1, 2)
)
SELECT h.doc_id, h.n_bytes,
       CASE WHEN depth = 0 THEN '' ELSE right(repeat('0', 64) || bin(prefix), depth) END AS shard,
       depth, shard_bytes, shard_rows, shard_bytes > 1048576 AS oversized
FROM split JOIN h ON (h.bits >> (60 - depth)) = prefix
WHERE fits OR depth = 60
"""

OP9 = """
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
r(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
)
SELECT p.page_id, p.host, p.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
FROM p LEFT JOIN LATERAL (
  SELECT r.host || r.path AS rule, r.verdict FROM r
  WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  ORDER BY length(r.host || r.path) DESC LIMIT 1
) best ON true
"""

OP11 = """
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
),
o AS (SELECT i, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM o GROUP BY 1, 2 HAVING count(DISTINCT i) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS n FROM kept GROUP BY 1),
groups AS (SELECT DISTINCT lang, source FROM d),
seen AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
totals AS (SELECT lang, source, sum(n) AS n FROM seen GROUP BY 1, 2),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(s.n, 0) + 2)) // (coalesce(t.n, 0) + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (l.n + 2 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
),
parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM parts
QUALIFY part = 'pair' OR rank <= 10
"""

OP12 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS i, vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
),
f AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(x) > 0
    AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0
),
links AS (
  SELECT a.i, a.vec_id AS a, b.vec_id AS b FROM f a JOIN f b
  ON a.label = b.label AND a.i <> b.i AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.93
),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY 1),
counted AS (SELECT i, count(*) AS n FROM links GROUP BY 1)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, coalesce(least(l.b, v.vec_id), v.vec_id) AS component_id,
       v.vec_id = coalesce(least(l.b, v.vec_id), v.vec_id) AS kept
FROM v LEFT JOIN counted c USING (i) LEFT JOIN least l ON l.a = v.vec_id
"""


def statements() -> dict[str, str]:
    return {
        "op1_extendible_sharding": OP1,
        "op9_url_rules": OP9,
        "op11_divergence_quadtree": OP11,
        "op12_metric_range_join": OP12,
    }
