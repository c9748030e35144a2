"""Queries: profiling statistics over the stand-in table and the driver tables."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import functions as F

from ..functions.stats import f_sf_udf, pearson_p_udf
from ..operators.gram import corr_wide
from ..operators.prepare import Preparer, derived_features, impute
from ..operators.profile import (anova_stats, box_stats, corr_matrix, corr_ranked, describe, duplicate_counts,
                                 group_means, histogram, kde_curve, level_counts, linear_fit, missing_report,
                                 outlier_total, pearson_target, schema_report, skew_table, target_summary,
                                 tukey_outliers)
from ..schema import (CATEGORICAL_COLUMNS, CORR_COLUMNS, HIST_BINS_FEATURE, HIST_BINS_TARGET, LEVEL_ORDER,
                      OUTLIER_COLUMNS, PROFILE_NUMERIC, SCATTER_FEATURES, TARGET_COLUMN)
from ..session import table
from ..sources.standin import HABITS_SQL, habits
from .registry import D_MODE_PARENT, WITH_HABITS, d_lerp, d_strip, d_title, dlit, dr, query, rnd

DESCRIBE_COLUMNS = OUTLIER_COLUMNS + ["total_screen_time", "study_to_leisure_ratio"]
LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

WITH_HD = (f"{WITH_HABITS}, hd AS (SELECT *, social_media_hours + netflix_hours AS total_screen_time, "
           f"study_hours_per_day / ((social_media_hours + netflix_hours) + 1e-1) AS study_to_leisure_ratio "
           f"FROM habits)")
WITH_HI = (f"{WITH_HABITS}, hi AS (SELECT * REPLACE (coalesce(parental_education_level, {D_MODE_PARENT}) "
           f"AS parental_education_level) FROM habits)")


def d_long(columns: list[str], src: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value{extra} FROM {src}" for c in columns)


def d_levels(columns: list[str], src: str, y: str = "exam_score", clean: bool = False) -> str:
    def lv(c):
        return d_title(d_strip(c)) if clean else c

    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {lv(c)} AS level, CAST({y} AS DOUBLE) AS y FROM {src}" for c in columns)


def hd(spark, sf_dir):
    return derived_features(habits(spark, sf_dir))


def imputed(spark, sf_dir):
    h = habits(spark, sf_dir)
    return impute(h, Preparer().fit(h).fills)


# --- A1 -------------------------------------------------------------------

_MISS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS missing, count(*) AS n, {i} AS pos "
    f"FROM habits" for i, c in enumerate(
        ["student_id", "age", "gender", "study_hours_per_day", "social_media_hours", "netflix_hours",
         "part_time_job", "attendance_percentage", "sleep_hours", "diet_quality", "exercise_frequency",
         "parental_education_level", "internet_quality", "mental_health_rating", "extracurricular_participation",
         "exam_score"]))


@query("missing_report", f"{WITH_HABITS}, m AS ({_MISS}) SELECT column_name, missing, "
                         f"{dr('CAST(missing AS DOUBLE) / n * 1e2', 2)} AS percent FROM m WHERE missing > 0")
def q_missing_report(spark, sf_dir):
    return missing_report(habits(spark, sf_dir))


# --- A3 -------------------------------------------------------------------


def _describe_sql(with_clause: str, columns: list[str], src: str) -> str:
    return (f"{with_clause}, long AS ({d_long(columns, src)}), a AS (SELECT feature, count(value) AS n, avg(value) AS mean, "
            f"stddev_samp(value) AS std, min(value) AS mn, max(value) AS mx, "
            f"list_sort(list(value) FILTER (WHERE value IS NOT NULL)) AS arr FROM long GROUP BY feature) "
            f"SELECT feature, CAST(n AS BIGINT) AS count, "
            f"{dr('mean', 2)} AS mean, {dr('std', 2)} AS std, {dr('mn', 2)} AS min, "
            f"{dr(d_lerp('arr', 'n', 0.25), 2)} AS q25, {dr(d_lerp('arr', 'n', 0.5), 2)} AS q50, "
            f"{dr(d_lerp('arr', 'n', 0.75), 2)} AS q75, {dr('mx', 2)} AS max FROM a")


def _describe_out(d):
    return d.select("feature", F.col("count").cast("bigint").alias("count"),
                    *[rnd(c, 2).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


@query("describe_numeric", _describe_sql(WITH_HD, DESCRIBE_COLUMNS, "hd"))
def q_describe_numeric(spark, sf_dir):
    return _describe_out(describe(hd(spark, sf_dir), DESCRIBE_COLUMNS))


@query("describe_lineitem", _describe_sql("WITH x AS (SELECT 1)", LINEITEM_NUMERIC, "lineitem"))
def q_describe_lineitem(spark, sf_dir):
    return _describe_out(describe(table(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC))


# --- A4 / A5 ----------------------------------------------------------------


def _tukey_sql(with_clause: str, columns: list[str], src: str) -> str:
    return (
        f"{with_clause}, long AS ({d_long(columns, src)}), "
        f"qa AS (SELECT feature, count(value) AS n, list_sort(list(value) FILTER (WHERE value IS NOT NULL)) AS arr "
        f"FROM long GROUP BY feature), "
        f"q AS (SELECT feature, {d_lerp('arr', 'n', 0.25)} AS q1, {d_lerp('arr', 'n', 0.75)} AS q3 FROM qa), "
        f"f AS (SELECT feature, q1, q3, q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM q), "
        f"t AS (SELECT f.feature, q1, q3, lo, hi, "
        f"sum(CASE WHEN value < lo OR value > hi THEN 1 ELSE 0 END) AS n_out, count(*) AS n_rows "
        f"FROM long JOIN f ON long.feature = f.feature GROUP BY f.feature, q1, q3, lo, hi)")


def _tukey_out(t):
    return t.select("feature", rnd("Q1", 2).alias("q1"), rnd("Q3", 2).alias("q3"),
                    rnd("lower_fence", 2).alias("lower_fence"), rnd("upper_fence", 2).alias("upper_fence"),
                    F.col("n_outliers").cast("bigint").alias("n_outliers"), rnd("pct", 2).alias("pct"))


_TUKEY_SELECT = (f"SELECT feature, {dr('q1', 2)} AS q1, {dr('q3', 2)} AS q3, {dr('lo', 2)} AS lower_fence, "
                 f"{dr('hi', 2)} AS upper_fence, CAST(n_out AS BIGINT) AS n_outliers, "
                 f"{dr('CAST(n_out AS DOUBLE) / n_rows * 1e2', 2)} AS pct FROM t")


@query("tukey_outliers", _tukey_sql(WITH_HABITS, OUTLIER_COLUMNS, "habits") + " " + _TUKEY_SELECT)
def q_tukey_outliers(spark, sf_dir):
    return _tukey_out(tukey_outliers(habits(spark, sf_dir), OUTLIER_COLUMNS))


@query("tukey_events", _tukey_sql("WITH x AS (SELECT 1)", ["value"], "events") + " " + _TUKEY_SELECT)
def q_tukey_events(spark, sf_dir):
    return _tukey_out(tukey_outliers(table(spark, sf_dir, "events"), ["value"]))


@query("outlier_total", _tukey_sql(WITH_HABITS, OUTLIER_COLUMNS, "habits")
       + " SELECT CAST(sum(n_out) AS BIGINT) AS total_outliers, CAST(sum(n_rows) AS BIGINT) AS numeric_cells, "
       + dr("CAST(sum(n_out) AS DOUBLE) / sum(n_rows) * 1e2", 2) + " AS pct_cells FROM t")
def q_outlier_total(spark, sf_dir):
    t = outlier_total(tukey_outliers(habits(spark, sf_dir), OUTLIER_COLUMNS))
    return t.select("total_outliers", "numeric_cells", rnd("pct_cells", 2).alias("pct_cells"))


# --- A6 -------------------------------------------------------------------

_DUP_SRC = "d AS (SELECT * FROM habits UNION ALL SELECT * FROM habits WHERE exercise_frequency = 0)"


@query("duplicate_counts",
       f"{WITH_HABITS}, {_DUP_SRC} SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS BIGINT) "
       f"AS full_row_duplicates, CAST(count(*) - count(DISTINCT student_id) AS BIGINT) AS duplicate_keys FROM d")
def q_duplicate_counts(spark, sf_dir):
    h = habits(spark, sf_dir)
    return duplicate_counts(h.unionByName(h.where(F.col("exercise_frequency") == 0)))


# --- A7 / A8 / A9 / A12 ----------------------------------------------------


@query("group_means", f"{WITH_HI}, l AS ({d_levels(CATEGORICAL_COLUMNS, 'hi')}) SELECT feature, level, "
                      f"{dr('avg(y)', 8)} AS mean_score, CAST(count(y) AS BIGINT) AS n FROM l WHERE level IS NOT NULL "
                      f"GROUP BY feature, level")
def q_group_means(spark, sf_dir):
    g = group_means(imputed(spark, sf_dir), CATEGORICAL_COLUMNS)
    return g.select("feature", "level", rnd("mean_score", 8).alias("mean_score"), F.col("n").cast("bigint"))


_ANOVA_SQL = (
    f"{WITH_HI}, l AS ({d_levels(CATEGORICAL_COLUMNS, 'hi')}), l2 AS (SELECT * FROM l WHERE level IS NOT NULL AND y IS NOT NULL), "
    f"g AS (SELECT feature, level, count(*) AS ng, avg(y) AS mg FROM l2 GROUP BY feature, level), "
    f"tot AS (SELECT feature, avg(y) AS m, count(*) AS n FROM l2 GROUP BY feature), "
    f"ssb AS (SELECT g.feature, count(*) AS k, sum(ng * (mg - m) * (mg - m)) AS ssb FROM g JOIN tot ON g.feature = tot.feature GROUP BY g.feature), "
    f"ssw AS (SELECT l2.feature, sum((y - mg) * (y - mg)) AS ssw FROM l2 JOIN g ON l2.feature = g.feature AND l2.level = g.level GROUP BY l2.feature) "
    f"SELECT ssb.feature, CAST(k AS BIGINT) AS k, CAST(n AS BIGINT) AS n, CAST(k - 1 AS DOUBLE) AS df_between, "
    f"CAST(n - k AS DOUBLE) AS df_within, "
    f"{dr('CASE WHEN k > 1 AND n > k AND ssw > 0 THEN (ssb / (k - 1)) / (ssw / (n - k)) END', 4)} AS F "
    f"FROM ssb JOIN ssw ON ssb.feature = ssw.feature JOIN tot ON ssb.feature = tot.feature")


@query("anova_f", _ANOVA_SQL)
def q_anova_f(spark, sf_dir):
    a = anova_stats(imputed(spark, sf_dir), CATEGORICAL_COLUMNS)
    return a.select("feature", "k", "n", "df_between", "df_within", rnd("F", 4).alias("F"))


@query("anova_test")
def q_anova_test(spark, sf_dir):
    """F with its p-value and the 0.05 significance flag (p from the F tail)."""
    a = anova_stats(imputed(spark, sf_dir), CATEGORICAL_COLUMNS)
    a = a.withColumn("p_value", f_sf_udf(F.col("F"), F.col("df_between"), F.col("df_within")))
    return a.select("feature", "F", "p_value", (F.col("p_value") < 0.05).alias("significant"))


def _level_counts_sql() -> str:
    ordered = [(c, lvl, i) for c in CATEGORICAL_COLUMNS if c in LEVEL_ORDER for i, lvl in enumerate(LEVEL_ORDER[c])]
    values = ", ".join(f"('{c}', '{lvl}', {i})" for c, lvl, i in ordered)
    nominal = ", ".join(f"'{c}'" for c in CATEGORICAL_COLUMNS if c not in LEVEL_ORDER)
    return (
        f"{WITH_HABITS}, l AS ({d_levels(CATEGORICAL_COLUMNS, 'habits', y='age', clean=True)}), "
        f"c AS (SELECT feature, level, count(*) AS n FROM l WHERE level IS NOT NULL GROUP BY feature, level), "
        f"o AS (SELECT * FROM (VALUES {values}) AS t(feature, level, position)) "
        f"SELECT o.feature, o.level, CAST(coalesce(c.n, 0) AS BIGINT) AS n, CAST(o.position AS INTEGER) AS position "
        f"FROM o LEFT JOIN c ON o.feature = c.feature AND o.level = c.level "
        f"UNION ALL SELECT feature, level, CAST(n AS BIGINT) AS n, "
        f"CAST(row_number() OVER (PARTITION BY feature ORDER BY n DESC, level) - 1 AS INTEGER) AS position "
        f"FROM c WHERE feature IN ({nominal})")


@query("level_counts", _level_counts_sql())
def q_level_counts(spark, sf_dir):
    return level_counts(habits(spark, sf_dir), CATEGORICAL_COLUMNS)


@query("box_stats",
       f"{WITH_HI}, l AS ({d_levels(CATEGORICAL_COLUMNS, 'hi')}), l2 AS (SELECT * FROM l WHERE level IS NOT NULL AND y IS NOT NULL), "
       f"qa AS (SELECT feature, level, count(y) AS n, list_sort(list(y)) AS arr FROM l2 GROUP BY feature, level), "
       f"q AS (SELECT feature, level, {d_lerp('arr', 'n', 0.25)} AS q1, {d_lerp('arr', 'n', 0.5)} AS med, "
       f"{d_lerp('arr', 'n', 0.75)} AS q3 FROM qa), "
       f"f AS (SELECT *, q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM q) "
       f"SELECT f.feature, f.level, {dr('q1')} AS q1, {dr('med')} AS median, {dr('q3')} AS q3, "
       f"{dr('min(CASE WHEN y >= lo AND y <= hi THEN y END)')} AS whisker_lo, "
       f"{dr('max(CASE WHEN y >= lo AND y <= hi THEN y END)')} AS whisker_hi, "
       f"CAST(sum(CASE WHEN y >= lo AND y <= hi THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers, CAST(count(*) AS BIGINT) AS n "
       f"FROM l2 JOIN f ON l2.feature = f.feature AND l2.level = f.level GROUP BY f.feature, f.level, q1, med, q3")
def q_box_stats(spark, sf_dir):
    b = box_stats(imputed(spark, sf_dir), CATEGORICAL_COLUMNS)
    return b.select("feature", "level", *[rnd(c).alias(c) for c in ["q1", "median", "q3", "whisker_lo", "whisker_hi"]],
                    F.col("n_outliers").cast("bigint"), F.col("n").cast("bigint"))


# --- A10 / A11 ---------------------------------------------------------------

HIST_COLUMNS = PROFILE_NUMERIC + [TARGET_COLUMN]
_BINS_VALUES = ", ".join(f"('{c}', {HIST_BINS_TARGET if c == TARGET_COLUMN else HIST_BINS_FEATURE})"
                         for c in HIST_COLUMNS)


@query("histogram",
       f"{WITH_HD}, long AS ({d_long(HIST_COLUMNS, 'hd')}), nb AS (SELECT * FROM (VALUES {_BINS_VALUES}) AS t(feature, bins)), "
       f"r AS (SELECT long.feature, min(value) AS vmin, max(value) AS vmax, any_value(bins) AS bins FROM long "
       f"JOIN nb ON long.feature = nb.feature WHERE value IS NOT NULL GROUP BY long.feature), "
       f"c AS (SELECT long.feature, CAST(CASE WHEN vmax - vmin > 0 THEN least(floor((value - vmin) * bins / (vmax - vmin)), bins - 1) "
       f"ELSE 0 END AS INTEGER) AS bin, count(*) AS n FROM long JOIN r ON long.feature = r.feature WHERE value IS NOT NULL GROUP BY 1, 2), "
       f"g AS (SELECT feature, vmin, vmax, bins, CAST(unnest(range(0, bins)) AS INTEGER) AS bin FROM r) "
       f"SELECT g.feature, g.bin, {dr('vmin + g.bin * ((vmax - vmin) / bins)')} AS lo, "
       f"{dr('vmin + (g.bin + 1) * ((vmax - vmin) / bins)')} AS hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n "
       f"FROM g LEFT JOIN c ON g.feature = c.feature AND g.bin = c.bin")
def q_histogram(spark, sf_dir):
    bins = {c: (HIST_BINS_TARGET if c == TARGET_COLUMN else HIST_BINS_FEATURE) for c in HIST_COLUMNS}
    h = histogram(hd(spark, sf_dir), HIST_COLUMNS, bins)
    return h.select("feature", "bin", rnd("lo").alias("lo"), rnd("hi").alias("hi"), "n")


@query("kde_curve",
       f"{WITH_HD}, long AS ({d_long(HIST_COLUMNS, 'hd')}), l2 AS (SELECT * FROM long WHERE value IS NOT NULL), "
       f"s AS (SELECT feature, min(value) AS vmin, max(value) AS vmax, count(*) AS N, "
       f"stddev_samp(value) * pow(CAST(count(*) AS DOUBLE), -2e-1) AS bw FROM l2 GROUP BY feature), "
       f"c AS (SELECT feature, value, count(*) AS c FROM l2 GROUP BY feature, value), "
       f"g AS (SELECT feature, vmin, bw, N, (vmax - vmin) / 199e0 AS step, CAST(unnest(range(0, 200)) AS INTEGER) AS i "
       f"FROM s WHERE bw > 0) "
       f"SELECT g.feature, g.i, {dr('vmin + g.i * step')} AS x, "
       f"{dr('sum(c * exp(-5e-1 * ((vmin + g.i * step - value) / bw) * ((vmin + g.i * step - value) / bw))) / (N * bw * ' + dlit(math.sqrt(2 * math.pi)) + ')', 8)} AS density "
       f"FROM g JOIN c ON g.feature = c.feature GROUP BY g.feature, g.i, vmin, step, bw, N")
def q_kde_curve(spark, sf_dir):
    k = kde_curve(hd(spark, sf_dir), HIST_COLUMNS)
    return k.select("feature", "i", rnd("x").alias("x"), rnd("density", 8).alias("density"))


# --- A18-A23 ---------------------------------------------------------------


@query("pearson_target",
       f"{WITH_HD} " + " UNION ALL ".join(
           f"SELECT '{c}' AS feature, {dr(f'corr({c}, exam_score)')} AS r, "
           f"CAST(count({c} + exam_score) AS BIGINT) AS n FROM hd" for c in SCATTER_FEATURES))
def q_pearson_target(spark, sf_dir):
    p = pearson_target(hd(spark, sf_dir), SCATTER_FEATURES)
    return p.select("feature", rnd("r").alias("r"), F.col("n").cast("bigint"))


@query("pearson_test")
def q_pearson_test(spark, sf_dir):
    """r with its two-sided p (t test on n-2 degrees of freedom)."""
    p = pearson_target(hd(spark, sf_dir), SCATTER_FEATURES)
    return p.select("feature", "r", "n", pearson_p_udf(F.col("r"), F.col("n").cast("double")).alias("p_value"))


@query("linear_fit",
       f"{WITH_HD} " + " UNION ALL ".join(
           f"SELECT '{c}' AS feature, {dr(f'regr_slope(exam_score, {c})')} AS slope, "
           f"{dr(f'regr_intercept(exam_score, {c})')} AS intercept FROM hd" for c in SCATTER_FEATURES))
def q_linear_fit(spark, sf_dir):
    f = linear_fit(hd(spark, sf_dir), SCATTER_FEATURES)
    return f.select("feature", rnd("slope").alias("slope"), rnd("intercept").alias("intercept"))


_PAIRS = [(a, b) for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[:i]]


@query("corr_matrix", f"{WITH_HD} " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {dr(f'corr({a}, {b})')} AS r FROM hd" for a, b in _PAIRS))
def q_corr_matrix(spark, sf_dir):
    c = corr_matrix(hd(spark, sf_dir), CORR_COLUMNS)
    return c.select("feature_a", "feature_b", rnd("r").alias("r"))


# the measures of a line item, and their products by two and by three
_WIDE = LINEITEM_NUMERIC + [" * ".join(c) for k in (2, 3) for c in itertools.combinations_with_replacement(LINEITEM_NUMERIC, k)]
_WIDE_NAMES = [f"x{i}" for i in range(len(_WIDE))]


@query("corr_wide", "WITH w AS (SELECT " + ", ".join(f"{e} AS {n}" for e, n in zip(_WIDE, _WIDE_NAMES)) + " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {dr(f'corr({a}, {b})')} AS r FROM w" for i, a in enumerate(_WIDE_NAMES) for b in _WIDE_NAMES[:i]))
def q_corr_wide(spark, sf_dir):
    """Correlations of many columns from tiles of the Gram matrix."""
    wide = table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {n}" for e, n in zip(_WIDE, _WIDE_NAMES)])
    return corr_wide(wide, _WIDE_NAMES, tile=16).select("feature_a", "feature_b", rnd("r").alias("r"))


@query("corr_ranked",
       f"{WITH_HD}, c AS (" + " UNION ALL ".join(
           f"SELECT '{c}' AS feature, corr({c}, exam_score) AS r FROM hd" for c in PROFILE_NUMERIC)
       + f") SELECT feature, {dr('r', 3)} AS r, abs({dr('r', 3)}) AS abs_r, "
         f"CASE WHEN r < 0 THEN 'negative' ELSE 'positive' END AS sign, abs(r) >= 1e-1 AS above_guide, "
         f"CAST(row_number() OVER (ORDER BY abs(r) DESC, feature) AS INTEGER) AS rank FROM c")
def q_corr_ranked(spark, sf_dir):
    return corr_ranked(hd(spark, sf_dir), PROFILE_NUMERIC)


@query("skew_adjusted", f"{WITH_HD}, long AS ({d_long(PROFILE_NUMERIC + [TARGET_COLUMN], 'hd')}) "
                        f"SELECT feature, {dr('skewness(value)')} AS skew, CAST(count(value) AS BIGINT) AS n "
                        f"FROM long GROUP BY feature")
def q_skew_adjusted(spark, sf_dir):
    s = skew_table(hd(spark, sf_dir), PROFILE_NUMERIC + [TARGET_COLUMN])
    return s.select("feature", rnd("skew").alias("skew"), F.col("n").cast("bigint"))


@query("target_summary",
       f"{WITH_HABITS} SELECT 'exam_score' AS feature, {dr('avg(exam_score)')} AS mean, "
       f"{dr(d_lerp('list_sort(list(exam_score) FILTER (WHERE exam_score IS NOT NULL))', 'count(exam_score)', 0.5))} AS median, {dr('stddev_samp(exam_score)')} AS std, "
       f"{dr('min(exam_score)')} AS min, {dr('max(exam_score)')} AS max, {dr('skewness(exam_score)')} AS skew FROM habits")
def q_target_summary(spark, sf_dir):
    t = target_summary(habits(spark, sf_dir))
    return t.select("feature", *[rnd(c).alias(c) for c in ["mean", "median", "std", "min", "max", "skew"]])


# --- P3, A24, O3 -----------------------------------------------------------


@query("derived_features", f"{WITH_HD} SELECT student_id, total_screen_time, study_to_leisure_ratio FROM hd")
def q_derived_features(spark, sf_dir):
    return hd(spark, sf_dir).select("student_id", "total_screen_time", "study_to_leisure_ratio")


@query("schema_report",
       "SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name, CASE column_type WHEN 'INTEGER' THEN 'int' "
       "WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS data_type, "
       f"(SELECT count(*) FROM ({HABITS_SQL})) AS n_rows, CAST(count(*) OVER () AS INTEGER) AS n_columns "
       f"FROM (DESCRIBE SELECT * FROM ({HABITS_SQL}))")
def q_schema_report(spark, sf_dir):
    return schema_report(habits(spark, sf_dir))


@query("head_rows", f"{WITH_HABITS} SELECT * FROM habits ORDER BY student_id LIMIT 5")
def q_head_rows(spark, sf_dir):
    return habits(spark, sf_dir).orderBy("student_id").limit(5)
