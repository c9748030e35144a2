"""Queries: the two streaming jobs, run to completion with ``availableNow``
over files Spark derives from the stand-in table, then read back."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..schema import CATEGORY_MAPS, FEATURE_COLUMNS, MONITOR_FEATURES
from ..session import scratch_path
from ..sources.files import read_metrics, write_batch
from ..sources.standin import habits
from ..streaming.monitor_stream import start_monitor_stream
from ..streaming.score_stream import encode_message, start_scoring_stream
from .q_monitor import D_REF, D_DRIFT, d_ks, scored_batch, scored_reference
from .q_prepare import FIXED_COEF, FIXED_INTERCEPT, fixed_model
from ..functions.text import python_list
from ..schema import MSG_EVENT_MISSING_FEATURES, MSG_EVENT_UNKNOWN_LEVEL
from .registry import WITH_HABITS, d_code, d_fill, d_hash, d_linear, d_prepared, d_round_python, dr, query, rnd

# --- T1 -----------------------------------------------------------------------


def _d_stream_error() -> str:
    cat = []
    for c, m in CATEGORY_MAPS.items():
        cat.append(f"CASE WHEN {c} IS NOT NULL AND {d_code(c)} IS NULL THEN "
                   f"{d_fill(MSG_EVENT_UNKNOWN_LEVEL, value='sql:' + c, field=c, allowed=python_list(m))} END")
    missing_items = " || ".join(f"CASE WHEN {c} IS NULL THEN '{c},' ELSE '' END" for c in FEATURE_COLUMNS)
    names = (f"'[' || array_to_string(list_transform(list_filter(string_split(({missing_items}), ','), "
             f"lambda x: x <> ''), lambda x: '''' || x || ''''), ', ') || ']'")
    missing = f"CASE WHEN ({missing_items}) <> '' THEN {d_fill(MSG_EVENT_MISSING_FEATURES, names='sql:' + names)} END"
    return "coalesce(" + ", ".join(cat + [missing]) + ")"


_ENC = ", ".join(f"{d_code(c)} AS {c}" if c in CATEGORY_MAPS else c for c in FEATURE_COLUMNS)
_RAW = f"greatest(least({d_linear(FIXED_COEF, FIXED_INTERCEPT)}, 1e2), 0e0)"


@query("stream_score",
       f"{WITH_HABITS}, e AS (SELECT student_id, {_d_stream_error()} AS error, {_ENC} FROM habits), "
       f"p AS (SELECT student_id, error, {_RAW} AS raw FROM e), "
       f"s AS (SELECT student_id, error, CASE WHEN error IS NULL THEN {d_round_python('raw')} END AS predicted_exam_score FROM p) "
       f"SELECT student_id, predicted_exam_score, error, "
       f"'{{\"prediction\":{{\"student_id\":' || to_json(student_id) || CASE WHEN error IS NULL THEN "
       f"',\"predicted_exam_score\":' || CAST(predicted_exam_score AS VARCHAR) ELSE ',\"error\":' || CAST(to_json(error) AS VARCHAR) END "
       f"|| '}}}}' AS response FROM s")
def q_stream_score(spark, sf_dir):
    """Habits rows sent as base64 JSON messages, scored by the stream, sink read back."""
    base = scratch_path(spark, "stream-score")
    msgs = encode_message(habits(spark, sf_dir)).select(
        F.struct(F.col("data"), F.lit(None).cast("string").alias("message_id")).alias("message"))
    msgs.write.mode("overwrite").json(f"{base}/in")
    q = start_scoring_stream(spark, f"{base}/in", f"{base}/out", f"{base}/dead", f"{base}/ckpt", fixed_model())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("student_id", "predicted_exam_score", "error", "response")


# --- T4 -----------------------------------------------------------------------

STREAM_BATCHES = [(7, True), (11, False), (13, True)]


def _d_batch(seed: int, drift: bool, s: str) -> str:
    shift = ("least(study_hours_per_day + 2e0, 24e0) AS study_hours_per_day, "
             "greatest(social_media_hours + -1e0, 0e0) AS social_media_hours")
    mf = ", ".join(MONITOR_FEATURES)
    b = (f"SELECT * REPLACE ({shift}) FROM b0{s}" if drift else f"SELECT * FROM b0{s}")
    return (f"draws{s} AS (SELECT range AS draw_id, {d_hash('range', f':draw:{seed}', 15)} % (SELECT count(*) FROM habits) "
            f"AS row_id FROM range(50)), "
            f"b0{s} AS (SELECT draws{s}.draw_id, idx.* EXCLUDE (row_id) FROM draws{s} JOIN idx ON draws{s}.row_id = idx.row_id), "
            f"b{s} AS ({b}), "
            f"cur{s} AS (SELECT {mf}, exam_score, {dr(d_linear(FIXED_COEF, FIXED_INTERCEPT), 2)} AS prediction "
            f"FROM (SELECT {d_prepared()} FROM b{s}))")


def _d_stream_monitor() -> str:
    ctes = [f"{WITH_HABITS}, {D_REF}, idx AS (SELECT *, row_number() OVER (ORDER BY student_id) - 1 AS row_id FROM habits)"]
    rows = []
    err = "(exam_score - prediction)"
    for seed, drift in STREAM_BATCHES:
        s = f"_{seed}"
        ks = d_ks().replace("FROM cur", f"FROM cur{s}")
        for name in ("long", "cnt", "cum", "ks", "dr", "ds"):
            ks = ks.replace(f"{name} AS (", f"{name}{s} AS (").replace(f"FROM {name})", f"FROM {name}{s})").replace(
                f"FROM {name} ", f"FROM {name}{s} ")
        drift_sql = D_DRIFT
        for name in ("ks", "dr", "ds"):
            drift_sql = drift_sql.replace(f"{name} AS (", f"{name}{s} AS (").replace(f"FROM {name})", f"FROM {name}{s})")
        ctes.append(f"{_d_batch(seed, drift, s)}, {ks}, {drift_sql}, "
                    f"q{s} AS (SELECT CAST(count(*) AS INTEGER) AS batch_size, sqrt(avg({err} * {err})) AS rmse, "
                    f"avg(abs({err})) AS mae, CASE WHEN var_pop(exam_score) * count(exam_score) > 0 THEN 1e0 - "
                    f"sum({err} * {err}) / (var_pop(exam_score) * count(exam_score)) WHEN sum({err} * {err}) = 0 THEN 1e0 "
                    f"ELSE 0e0 END AS r2, avg(prediction) AS pred_mean, stddev_samp(prediction) AS pred_std, "
                    f"min(prediction) AS pred_min, max(prediction) AS pred_max FROM cur{s})")
        rows.append(f"SELECT 'batch-{seed:04d}' AS batch_id, batch_size, num_drifted_features, share_drifted_features, "
                    f"drifted_feature_names, {dr('rmse')} AS rmse, {dr('mae')} AS mae, {dr('r2')} AS r2, "
                    f"{dr('pred_mean')} AS pred_mean, {dr('pred_std')} AS pred_std, {dr('pred_min')} AS pred_min, "
                    f"{dr('pred_max')} AS pred_max FROM ds{s}, q{s}")
    return ", ".join(ctes) + " " + " UNION ALL ".join(rows)


@query("stream_monitor", _d_stream_monitor())
def q_stream_monitor(spark, sf_dir):
    """Three scored batch files monitored once each by a file-source stream."""
    base = scratch_path(spark, "stream-monitor")
    for seed, drift in STREAM_BATCHES:
        write_batch(scored_batch(spark, sf_dir, seed=seed, drift=drift), f"{base}/batches", f"batch-{seed:04d}")
    q = start_monitor_stream(spark, f"{base}/batches", scored_reference(spark, sf_dir), f"{base}/metrics",
                             f"{base}/ckpt", method="critical", clock=lambda: datetime.datetime(2000, 1, 1))
    q.awaitTermination()
    m = read_metrics(spark, f"{base}/metrics")
    return m.select("batch_id", "batch_size", "num_drifted_features", "share_drifted_features", "drifted_feature_names",
                    *[rnd(c).alias(c) for c in ["rmse", "mae", "r2", "pred_mean", "pred_std", "pred_min", "pred_max"]])
