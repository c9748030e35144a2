"""The ``habits`` stand-in source: the 16-column raw table derived from the
driver tables ``orders`` and ``customer``.

The same SQL text runs in Spark (with the two tables bound as DataFrames) and
in DuckDB (as a CTE of the oracle queries), so both engines see identical
rows. It carries nulls, padded and mixed-case levels, an unknown level and a
target with real signal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import table

# FIXED VALUES: stand-in table definition (shared with the SQL oracle).
HABITS_SQL_TEMPLATE = """
WITH b AS (
  SELECT o.o_orderkey AS k, c.c_custkey AS ck, o.o_orderstatus AS st, o.o_orderpriority AS pr,
         c.c_mktsegment AS seg, CAST(floor(o.o_totalprice * 1e2 + 5e-1) AS BIGINT) AS cents
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey),
r AS (
  SELECT k, concat('S', CAST(k AS STRING)) AS student_id,
    CAST(17 + k % 8 AS INT) AS age,
    CASE WHEN k % 7 = 0 THEN ' male ' ELSE CASE st WHEN 'P' THEN 'Male' WHEN 'O' THEN 'FEMALE' ELSE 'Other' END END AS gender,
    (k * 7919 % 84) / 1e1 AS study_hours_per_day,
    (k * 104729 % 73) / 1e1 AS social_media_hours,
    (cents % 55) / 1e1 AS netflix_hours,
    CASE WHEN ck % 4 = 0 THEN 'Yes' ELSE 'no' END AS part_time_job,
    56 + (cents % 441) / 1e1 AS attendance_percentage,
    32e-1 + (k * 31 % 69) / 1e1 AS sleep_hours,
    CASE WHEN pr IN ('1-URGENT','2-HIGH') THEN 'Poor' WHEN pr IN ('3-MEDIUM','4-NOT SPECIFIED') THEN 'Fair' ELSE 'Good' END AS diet_quality,
    CAST(cents % 7 AS INT) AS exercise_frequency,
    CASE WHEN k % 11 = 0 THEN NULL WHEN seg IN ('AUTOMOBILE','BUILDING') THEN 'high school' WHEN seg IN ('FURNITURE','HOUSEHOLD') THEN 'Bachelor' ELSE 'Master' END AS parental_education_level,
    CASE WHEN k % 997 = 0 THEN 'Dialup' WHEN ck % 3 = 0 THEN 'Poor' WHEN ck % 3 = 1 THEN 'Average' ELSE 'Good' END AS internet_quality,
    CAST(1 + k * 17 % 10 AS INT) AS mental_health_rating,
    CASE WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS extracurricular_participation,
    (cents % 1201) / 1e2 - 6e0 AS noise
  FROM b)
SELECT student_id, age, gender, study_hours_per_day, social_media_hours, netflix_hours, part_time_job,
  attendance_percentage, sleep_hours, diet_quality, exercise_frequency, parental_education_level,
  internet_quality, mental_health_rating, extracurricular_participation,
  greatest(0e0, least(1e2, 5e0 + 9e0 * study_hours_per_day - 25e-1 * social_media_hours - 2e0 * netflix_hours
    + 15e-2 * attendance_percentage + 2e0 * sleep_hours + 15e-1 * exercise_frequency + 2e0 * mental_health_rating + noise)) AS exam_score
FROM r
"""

# Plain-table form for DuckDB.
HABITS_SQL = HABITS_SQL_TEMPLATE.format(orders="orders", customer="customer")


def habits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw 16-column table, derived by Spark from ``orders`` x ``customer``."""
    return spark.sql(
        HABITS_SQL_TEMPLATE,
        orders=table(spark, sf_dir, "orders"),
        customer=table(spark, sf_dir, "customer"),
    )
