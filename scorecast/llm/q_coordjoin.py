"""Query of the near-duplicate groups."""

from __future__ import annotations

from ..session import table
from .coordjoin import near_duplicates
from .registry import query

SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS k
      FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(a, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.a AND r.c < l.a),
m AS (SELECT a AS doc_id, min(c) AS component_id FROM r GROUP BY a)
SELECT m.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, m.doc_id = m.component_id AS kept
FROM m LEFT JOIN n USING (doc_id)
"""


@query("op9_minhash_near_dedup", SQL)
def op9(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), similarity=0.85)
