"""Query of the substring dedup."""

from __future__ import annotations

from ..session import table
from .registry import query
from .substring import repeats_digest

SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM w, unnest(range(1, len(ws) - 11)) AS t(i)),
f AS (SELECT k, min(doc_id) AS d FROM g GROUP BY k),
gone AS (SELECT DISTINCT g.doc_id, g.i + o AS p FROM g JOIN f USING (k), unnest(range(0, 13)) AS u(o) WHERE f.d < g.doc_id),
words AS (SELECT doc_id, p, ws[p] AS x FROM w, unnest(range(1, len(ws) + 1)) AS t(p)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query("op7_substring_dedup", SQL)
def op7(spark, sf_dir):
    return repeats_digest(table(spark, sf_dir, "documents"))
