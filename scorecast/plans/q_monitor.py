"""Queries: reference set, bootstrap batches, KS drift, monitoring row, and the
scalar functions used along the way (clip, shift-clip, rounding, text, JSON).
"""

from __future__ import annotations

import datetime
import math

from pyspark.sql import functions as F

from ..functions.numeric import clip_score, round_half_even, shift_clip
from ..functions.text import clean_level
from ..operators.monitor import batch_quality, drift_summary, ks_drift, ks_statistics, monitoring_row
from ..operators.prepare import Preparer
from ..operators.sampling import bootstrap_sample, row_lookup
from ..schema import (CATEGORICAL_COLUMNS, DRIFT_P_THRESHOLD, DRIFT_SCENARIO, MONITOR_FEATURES, RAW_COLUMNS,
                      TARGET_COLUMN)
from ..session import table
from ..sources.files import latest_by
from ..sources.standin import habits
from .q_prepare import FIXED_COEF, FIXED_INTERCEPT, fixed_model
from .registry import WITH_HABITS, d_hash, d_linear, d_prepared, d_strip, d_title, dlit, dr, query, rnd

BATCH_N = 50
BATCH_SEED = 7
SAMPLE_N = 100
SAMPLE_SEED = 42
MONITOR_BATCH_ID = "batch-0007"


def apply_scenario(df, scenario=None):
    scenario = scenario or DRIFT_SCENARIO
    return df.select(*[shift_clip(c, *scenario[c]).alias(c) if c in scenario else F.col(c) for c in df.columns])


def scored_reference(spark, sf_dir):
    """Reference set: raw numeric features, target and rounded prediction."""
    h = habits(spark, sf_dir)
    prep = Preparer().fit(h)
    s = fixed_model().transform(prep.transform(h))
    return s.select(*MONITOR_FEATURES, TARGET_COLUMN, round_half_even(F.col("prediction"), 2).alias("prediction"))


def scored_batch(spark, sf_dir, n=BATCH_N, seed=BATCH_SEED, drift=True):
    """A bootstrap batch (exactly n rows), optionally shifted, then scored."""
    h = habits(spark, sf_dir)
    prep = Preparer().fit(h)
    b = bootstrap_sample(h, n, seed)
    if drift:
        b = apply_scenario(b)
    s = fixed_model().transform(prep.transform(b))
    return s.select("draw_id", *MONITOR_FEATURES, TARGET_COLUMN,
                    round_half_even(F.col("prediction"), 2).alias("prediction"))


def d_bootstrap(n: int, seed: int) -> str:
    return (f"idx AS (SELECT *, row_number() OVER (ORDER BY student_id) - 1 AS row_id FROM habits), "
            f"draws AS (SELECT range AS draw_id, {d_hash('range', f':draw:{seed}', 15)} % (SELECT count(*) FROM habits) "
            f"AS row_id FROM range({n})), "
            f"b0 AS (SELECT draws.draw_id, idx.* EXCLUDE (row_id) FROM draws JOIN idx ON draws.row_id = idx.row_id)")


D_SCENARIO = ("b AS (SELECT * REPLACE (least(study_hours_per_day + 2e0, 24e0) AS study_hours_per_day, "
              "greatest(social_media_hours + -1e0, 0e0) AS social_media_hours) FROM b0)")
_MF = ", ".join(MONITOR_FEATURES)
D_REF = (f"ref AS (SELECT {_MF}, exam_score, {dr(d_linear(FIXED_COEF, FIXED_INTERCEPT), 2)} AS prediction "
         f"FROM (SELECT {d_prepared()} FROM habits))")
D_BATCH = (f"{d_bootstrap(BATCH_N, BATCH_SEED)}, {D_SCENARIO}, "
           f"cur AS (SELECT draw_id, {_MF}, exam_score, {dr(d_linear(FIXED_COEF, FIXED_INTERCEPT), 2)} AS prediction "
           f"FROM (SELECT draw_id, {d_prepared()} FROM b))")


def d_ks() -> str:
    ref_long = " UNION ALL ".join(f"SELECT {i} AS pos, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, 'r' AS side FROM ref"
                                  for i, c in enumerate(MONITOR_FEATURES))
    cur_long = " UNION ALL ".join(f"SELECT {i} AS pos, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, 'c' AS side FROM cur"
                                  for i, c in enumerate(MONITOR_FEATURES))
    return (f"long AS ({ref_long} UNION ALL {cur_long}), "
            f"cnt AS (SELECT pos, feature, value, sum(CASE WHEN side = 'r' THEN 1 ELSE 0 END) AS nr, "
            f"sum(CASE WHEN side = 'c' THEN 1 ELSE 0 END) AS nc FROM long GROUP BY pos, feature, value), "
            f"cum AS (SELECT pos, feature, sum(nr) OVER (PARTITION BY feature ORDER BY value) AS cr, "
            f"sum(nc) OVER (PARTITION BY feature ORDER BY value) AS cc, sum(nr) OVER (PARTITION BY feature) AS n_ref, "
            f"sum(nc) OVER (PARTITION BY feature) AS n_cur FROM cnt), "
            f"ks AS (SELECT pos, feature, max(abs(CAST(cr AS DOUBLE) / n_ref - CAST(cc AS DOUBLE) / n_cur)) AS d, "
            f"CAST(max(n_ref) AS BIGINT) AS n_ref, CAST(max(n_cur) AS BIGINT) AS n_cur FROM cum GROUP BY pos, feature)")


_C_ALPHA = math.sqrt(-math.log(DRIFT_P_THRESHOLD / 2.0) / 2.0)
D_DRIFT = (f"dr AS (SELECT *, d > {dlit(_C_ALPHA)} * sqrt((CAST(n_ref AS DOUBLE) + CAST(n_cur AS DOUBLE)) / "
           f"(CAST(n_ref AS DOUBLE) * CAST(n_cur AS DOUBLE))) AS drifted FROM ks), "
           f"ds AS (SELECT CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS INTEGER) AS num_drifted_features, "
           f"sum(CASE WHEN drifted THEN 1 ELSE 0 END) / 8e0 AS share_drifted_features, "
           f"string_agg(CASE WHEN drifted THEN feature END, ', ' ORDER BY pos) AS drifted_feature_names FROM dr)")


@query("reference_set", f"{WITH_HABITS}, {D_REF} SELECT * FROM ref")
def q_reference_set(spark, sf_dir):
    return scored_reference(spark, sf_dir)


@query("bootstrap_sample", f"{WITH_HABITS}, {d_bootstrap(SAMPLE_N, SAMPLE_SEED)} SELECT * FROM b0")
def q_bootstrap_sample(spark, sf_dir):
    s = bootstrap_sample(habits(spark, sf_dir), SAMPLE_N, SAMPLE_SEED)
    return s.select("draw_id", *RAW_COLUMNS)


@query("bootstrap_dup_key",
       "WITH idx AS (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey) - 1 AS row_id, count(*) OVER () AS n FROM lineitem), "
       f"draws AS (SELECT range AS draw_id, {d_hash('range', f':draw:{SAMPLE_SEED}', 15)} % (SELECT max(n) FROM idx) AS row_id "
       f"FROM range({SAMPLE_N})) SELECT draw_id, l_orderkey FROM draws JOIN idx USING (row_id)")
def q_bootstrap_dup_key(spark, sf_dir):
    """A bootstrap over a key that several rows share."""
    return bootstrap_sample(table(spark, sf_dir, "lineitem"), SAMPLE_N, SAMPLE_SEED, key="l_orderkey").select("draw_id", "l_orderkey")


@query("latest_batch_files", f"{WITH_HABITS}, {D_REF} SELECT '1234e567' AS batch_id, * FROM ref")
def q_latest_batch_files(spark, sf_dir):
    """Two batches of several files each, written one after the other: the whole newer one comes back."""
    from ..session import scratch_path
    from ..sources.files import latest_batch, write_batch

    root = scratch_path(spark, "batches")
    rows = scored_reference(spark, sf_dir)
    write_batch(rows.where("exam_score > 50"), root, "00123456")
    write_batch(rows.repartition(4), root, "1234e567")
    batch_id, newest = latest_batch(spark, root)
    return newest.select(F.lit(batch_id).alias("batch_id"), "*")


@query("scored_batch", f"{WITH_HABITS}, {D_BATCH} SELECT * FROM cur")
def q_scored_batch(spark, sf_dir):
    return scored_batch(spark, sf_dir)


@query("ks_drift", f"{WITH_HABITS}, {D_REF}, {D_BATCH}, {d_ks()} SELECT feature, d, n_ref, n_cur FROM ks")
def q_ks_drift(spark, sf_dir):
    ks = ks_statistics(scored_reference(spark, sf_dir), scored_batch(spark, sf_dir), MONITOR_FEATURES)
    return ks.select("feature", "d", "n_ref", "n_cur")


@query("ks_test")
def q_ks_test(spark, sf_dir):
    """D with the exact/asymptotic p-value and the p < 0.05 verdict."""
    ks = ks_drift(scored_reference(spark, sf_dir), scored_batch(spark, sf_dir), MONITOR_FEATURES, method="pvalue")
    return ks.select("feature", "d", "n_ref", "n_cur", "p_value", "drifted", "warning")


@query("drift_summary", f"{WITH_HABITS}, {D_REF}, {D_BATCH}, {d_ks()}, {D_DRIFT} SELECT * FROM ds")
def q_drift_summary(spark, sf_dir):
    ks = ks_drift(scored_reference(spark, sf_dir), scored_batch(spark, sf_dir), MONITOR_FEATURES, method="critical")
    return drift_summary(ks)


_ERR = "(exam_score - prediction)"


@query("prediction_stats",
       f"{WITH_HABITS}, {D_BATCH} SELECT {dr('avg(prediction)')} AS pred_mean, {dr('stddev_samp(prediction)')} AS pred_std, "
       f"{dr('min(prediction)')} AS pred_min, {dr('max(prediction)')} AS pred_max FROM cur")
def q_prediction_stats(spark, sf_dir):
    q = batch_quality(scored_batch(spark, sf_dir))
    return q.select(*[rnd(c).alias(c) for c in ["pred_mean", "pred_std", "pred_min", "pred_max"]])


@query("monitoring_row",
       f"{WITH_HABITS}, {D_REF}, {D_BATCH}, {d_ks()}, {D_DRIFT}, "
       f"q AS (SELECT CAST(count(*) AS INTEGER) AS batch_size, sqrt(avg({_ERR} * {_ERR})) AS rmse, avg(abs({_ERR})) AS mae, "
       f"CASE WHEN var_pop(exam_score) * count(exam_score) > 0 THEN 1e0 - sum({_ERR} * {_ERR}) / (var_pop(exam_score) * count(exam_score)) "
       f"WHEN sum({_ERR} * {_ERR}) = 0 THEN 1e0 ELSE 0e0 END AS r2, avg(prediction) AS pred_mean, "
       f"stddev_samp(prediction) AS pred_std, min(prediction) AS pred_min, max(prediction) AS pred_max FROM cur) "
       f"SELECT '{MONITOR_BATCH_ID}' AS batch_id, batch_size, num_drifted_features, share_drifted_features, "
       f"drifted_feature_names, {dr('rmse')} AS rmse, {dr('mae')} AS mae, {dr('r2')} AS r2, {dr('pred_mean')} AS pred_mean, "
       f"{dr('pred_std')} AS pred_std, {dr('pred_min')} AS pred_min, {dr('pred_max')} AS pred_max FROM ds, q")
def q_monitoring_row(spark, sf_dir):
    row = monitoring_row(scored_reference(spark, sf_dir), scored_batch(spark, sf_dir), MONITOR_BATCH_ID,
                         timestamp=datetime.datetime(2000, 1, 1), method="critical")
    return row.select("batch_id", "batch_size", "num_drifted_features", "share_drifted_features",
                      "drifted_feature_names",
                      *[rnd(c).alias(c) for c in ["rmse", "mae", "r2", "pred_mean", "pred_std", "pred_min", "pred_max"]])


@query("monitor_batch")
def q_monitor_batch(spark, sf_dir):
    """The full 13-column metrics row: p-value drift rule and a UTC timestamp."""
    return monitoring_row(scored_reference(spark, sf_dir), scored_batch(spark, sf_dir), MONITOR_BATCH_ID)


# --- scalar functions ---------------------------------------------------------


@query("shift_clip",
       f"{WITH_HABITS} SELECT student_id, least(study_hours_per_day + 2e0, 24e0) AS study_hours_per_day, "
       f"greatest(social_media_hours + -1e0, 0e0) AS social_media_hours FROM habits")
def q_shift_clip(spark, sf_dir):
    h = habits(spark, sf_dir).select("student_id", "study_hours_per_day", "social_media_hours")
    return apply_scenario(h)


@query("clip_scores",
       f"{WITH_HABITS} SELECT student_id, raw, CASE WHEN raw IS NOT NULL THEN greatest(least(raw, 1e2), 0e0) END AS clipped "
       f"FROM (SELECT student_id, {d_linear({k: v * 1.5 for k, v in FIXED_COEF.items()}, -20.0)} AS raw "
       f"FROM (SELECT {d_prepared()} FROM habits))")
def q_clip_scores(spark, sf_dir):
    h = habits(spark, sf_dir)
    p = Preparer().fit(h).transform(h, keep=["student_id"])
    from ..operators.models.linear import LinearModel
    from ..schema import FEATURE_COLUMNS

    steep = LinearModel(FEATURE_COLUMNS, [FIXED_COEF[c] * 1.5 for c in FEATURE_COLUMNS], -20.0)
    s = steep.transform(p, "raw")
    return s.select("student_id", "raw", clip_score("raw").alias("clipped"))


@query("round_modes",
       "SELECT l_orderkey, l_linenumber, " + dr("l_extendedprice * (1e0 - l_discount)", 2) + " AS v2, "
       + dr("l_extendedprice * (1e0 - l_discount) * (1e0 + l_tax)", 4) + " AS v4, "
       + dr("l_quantity / 3e0", 3) + " AS v3 FROM lineitem")
def q_round_modes(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", round_half_even(net, 2).alias("v2"),
                     round_half_even(net * (F.lit(1.0) + F.col("l_tax")), 4).alias("v4"),
                     round_half_even(F.col("l_quantity") / F.lit(3.0), 3).alias("v3"))


@query("clean_text", f"{WITH_HABITS} SELECT student_id, "
       + ", ".join(f"{d_title(d_strip(c))} AS {c}" for c in CATEGORICAL_COLUMNS) + " FROM habits")
def q_clean_text(spark, sf_dir):
    h = habits(spark, sf_dir)
    return h.select("student_id", *[clean_level(c).alias(c) for c in CATEGORICAL_COLUMNS])


@query("json_events",
       "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
       "CAST(to_json({'event_id': event_id, 'event_type': event_type, 'k': CAST(json_extract_string(props, '$.k') AS INTEGER)}) AS VARCHAR) "
       "AS payload FROM events")
def q_json_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    parsed = ev.select("event_id", "event_type", F.from_json("props", "k int").alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"),
                         F.to_json(F.struct("event_id", "event_type", F.col("p.k").alias("k"))).alias("payload"))


@query("latest_batch",
       "SELECT * FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def q_latest_batch(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("__day", F.to_date("ts"))
    return latest_by(ev, "__day").drop("__day")


@query("row_lookup", f"{WITH_HABITS} SELECT *, CAST(2 AS BIGINT) AS row_id FROM habits ORDER BY student_id LIMIT 1 OFFSET 2")
def q_row_lookup(spark, sf_dir):
    return row_lookup(habits(spark, sf_dir), 2)


@query("monitoring_cycle")
def q_monitoring_cycle(spark, sf_dir):
    """Reference set -> fresh-id drifted batch -> latest batch -> metrics row appended, read back."""
    from ..session import scratch_path
    from .monitoring import run_monitoring

    h = habits(spark, sf_dir)
    return run_monitoring(spark, h, fixed_model(), Preparer().fit(h), scratch_path(spark, "monitoring"), seed=BATCH_SEED)


LINEITEM_KS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _d_ks_lineitem() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, l_linestatus AS side FROM lineitem"
        for c in LINEITEM_KS)
    return (f"WITH long AS ({long}), cnt AS (SELECT feature, value, sum(CASE WHEN side = 'F' THEN 1 ELSE 0 END) AS nr, "
            f"sum(CASE WHEN side = 'O' THEN 1 ELSE 0 END) AS nc FROM long WHERE value IS NOT NULL AND side IN ('F', 'O') "
            f"GROUP BY feature, value), "
            f"cum AS (SELECT feature, sum(nr) OVER (PARTITION BY feature ORDER BY value) AS cr, "
            f"sum(nc) OVER (PARTITION BY feature ORDER BY value) AS cc, sum(nr) OVER (PARTITION BY feature) AS n_ref, "
            f"sum(nc) OVER (PARTITION BY feature) AS n_cur FROM cnt) "
            f"SELECT feature, max(abs(CAST(cr AS DOUBLE) / n_ref - CAST(cc AS DOUBLE) / n_cur)) AS d, "
            f"CAST(max(n_ref) AS BIGINT) AS n_ref, CAST(max(n_cur) AS BIGINT) AS n_cur FROM cum GROUP BY feature")


def lineitem_sides(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_linestatus", *LINEITEM_KS)
    return li.where(F.col("l_linestatus") == "F"), li.where(F.col("l_linestatus") == "O")


@query("ks_lineitem", _d_ks_lineitem())
def q_ks_lineitem(spark, sf_dir):
    """Two-sample KS D between shipped-and-finished (F) and open (O) line items, on the whole table."""
    ks = ks_statistics(*lineitem_sides(spark, sf_dir), LINEITEM_KS)
    return ks.select("feature", "d", "n_ref", "n_cur")
