"""Query of the filter interaction audit and its SQL."""

from __future__ import annotations

from ..session import table
from .failaudit import audit
from .registry import query

_BIT = "CAST(CASE {} WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 4 WHEN 'D' THEN 8 ELSE 16 END AS INTEGER)"

SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
f AS (SELECT doc_id, part,
        CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
        + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
x(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e
      WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, {_BIT.format("filter_order[step]")} AS bit,
        list_sum([0] || [{_BIT.format("y")} for y in string_split(filter_order[1:step - 1], '') if y <> '']) AS prefix
      FROM o, unnest([1, 2, 3, 4, 5]) AS t(step)),
r AS (SELECT s.filter_order, s.step, s.bit, c.part,
        sum(CASE WHEN mask & (prefix | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & bit > 0 AND mask & prefix = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & bit > 0 AND mask & prefix > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & bit > 0 AND mask & prefix = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & bit > 0 AND mask & prefix = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM s, c GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r
"""


@query("op12_filter_audit", SQL)
def op12(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
