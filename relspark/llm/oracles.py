"""DuckDB SQL for the near-duplicate and repeat queries, by plain comparison of everything with everything."""

from __future__ import annotations

_REACH = """
reach(x, y) AS (SELECT id, id FROM nodes UNION SELECT r.x, l.b FROM reach r JOIN links l ON l.a = r.y),
comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)"""

#: All pairs of vectors with equal labels by cosine.
EMBEDDINGS = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE e IS NOT NULL AND label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.label = q.label AND len(p.e) = len(q.e) AND p.vec_id <> q.vec_id WHERE list_cosine_similarity(p.e, q.e) >= 0.93),
nodes AS (SELECT vec_id AS id FROM v), {_REACH},
n AS (SELECT a, count(*) AS n FROM links GROUP BY a), c AS (SELECT label, e, count(*) AS copies FROM good GROUP BY ALL)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept, CAST(coalesce(copies, 1) AS BIGINT) AS n_copies
FROM v JOIN comp ON x = vec_id LEFT JOIN n ON a = vec_id LEFT JOIN c ON c.label = v.label AND c.e = v.e"""

#: Pairs of documents that share a shingle, by full intersection and union.
MINHASH = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM w, unnest(range(1, len(w) - 1)) u(i) WHERE len(w) >= 3
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 2),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
both_ AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM s p JOIN s q ON p.s = q.s AND p.doc_id <> q.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM both_ JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
nodes AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN comp ON x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

#: Every 50-byte string (as 100 hexadecimal digits) with the smallest document it starts in.
SUFFIXES = """
WITH t AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS MATERIALIZED (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM t, unnest(range(0, greatest(len(h) // 2 - 49, 0))) u(i)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
c AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 1 ELSE 0 END AS fresh FROM w JOIN f USING (s) WHERE first < doc_id),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM c),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, k),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
    UNION ALL SELECT t.doc_id, coalesce(max(b), 0), any_value(len(h)) // 2 FROM t LEFT JOIN spans USING (doc_id) GROUP BY t.doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS h FROM gaps JOIN t USING (doc_id) GROUP BY doc_id),
r AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(len(t.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM t JOIN kept USING (doc_id) LEFT JOIN r USING (doc_id)"""
