"""Queries: Gram sums, standardisation, model fits and search, ensemble and
best-model choice, scoring of requests, validation, and sources/sinks."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators.models.knn import build_knn_index, fold_scales, knn_neighbors, knn_predictions, neighbor_recall
from ..operators.models.linear import LinearModel, gram_stats, lasso_from_stats, ridge_from_stats, standardize
from ..operators.models.lsh import build_lsh_index, lsh_neighbors
from ..operators.models.search import search_linear, search_trees
from ..operators.score import score_requests
from ..operators.validate import feature_array, validate_categories, validate_ranges, validate_vector
from ..schema import (CATEGORY_MAPS, FEATURE_COLUMNS, KEY_COLUMN, LASSO_ALPHAS, MONITOR_FEATURES, REQUEST_RULES,
                      RIDGE_ALPHAS, TARGET_COLUMN)
from ..session import cut_lineage, scratch_path
from ..sources.artifacts import log_run, runs
from ..sources.files import read_category_maps, read_csv_typed, write_category_maps, write_csv
from ..sources.standin import habits
from .q_prepare import FIXED_COEF, FIXED_INTERCEPT, prepared
from ..functions.text import python_list
from ..schema import (MSG_REQUEST_ABOVE, MSG_REQUEST_BELOW, MSG_REQUEST_MISSING, MSG_REQUEST_NOT_TEXT,
                      MSG_REQUEST_UNKNOWN_LEVEL, MSG_VECTOR_TYPES)
from .registry import (WITH_HABITS, d_code, d_fill, d_hash, d_linear, d_prepared, d_str, d_strip, d_title, d_round_python, dr, query,
                       rnd)
from .train import FULL_GRIDS, prepare_split, run_training

_SPLIT = f"({d_hash('student_id', ':42')} % 100 < 20)"
_FOLD = f"CAST({d_hash('student_id', ':fold:42')} % 5 AS INTEGER)"
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLUMNS + [TARGET_COLUMN])
D_TRAIN = (f"prep AS (SELECT {d_prepared()} FROM habits), "
           f"tr AS (SELECT *, {_FOLD} AS fold FROM prep WHERE {_COMPLETE} AND NOT {_SPLIT}), "
           f"te AS (SELECT * FROM prep WHERE {_COMPLETE} AND {_SPLIT})")


def split_frames(spark, sf_dir):
    _, data = prepare_split(habits(spark, sf_dir))
    good = data.where("__complete")
    return good.where(~F.col("is_test")), good.where(F.col("is_test"))


def _kept(rows):
    """Rows that several passes read, persisted."""
    from pyspark import StorageLevel

    return rows.persist(StorageLevel.MEMORY_AND_DISK)


# --- M5 / M3 ---------------------------------------------------------------

GRAM_COLS = FEATURE_COLUMNS + [TARGET_COLUMN]
_GRAM_PAIRS = [(i, j) for i in range(len(GRAM_COLS)) for j in range(i, len(GRAM_COLS))]


_GRAM_CENTRE = "c AS (SELECT " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}" for i, c in enumerate(GRAM_COLS)) + " FROM tr)"


@query("gram_matrix", f"{WITH_HABITS}, {D_TRAIN}, {_GRAM_CENTRE} " + " UNION ALL ".join(
    f"SELECT fold, {i} AS i, {j} AS j, '{GRAM_COLS[i]}' AS feature_a, '{GRAM_COLS[j]}' AS feature_b, CAST(count(*) AS BIGINT) AS n, "
    f"{dr(f'sum((CAST({GRAM_COLS[i]} AS DOUBLE) - m{i}) * (CAST({GRAM_COLS[j]} AS DOUBLE) - m{j}))', 3)} AS sum_prod FROM tr, c GROUP BY fold"
    for i, j in _GRAM_PAIRS))
def q_gram_matrix(spark, sf_dir):
    """The centred Gram sums that every linear fit starts from, per fold."""
    tr, _ = split_frames(spark, sf_dir)
    stats = gram_stats(tr, FEATURE_COLUMNS, TARGET_COLUMN, group_col="fold")
    p, rows = len(FEATURE_COLUMNS), []
    for fold, g in stats.groups.items():
        for i, j in _GRAM_PAIRS:
            value = g["syy"] if i == p else g["sxy"][i] if j == p else g["sxx"][i, j]
            rows.append((int(fold), i, j, GRAM_COLS[i], GRAM_COLS[j], int(g["n"]), float(value)))
    out = spark.createDataFrame(rows, "fold int, i int, j int, feature_a string, feature_b string, n long, sum_prod double")
    return out.withColumn("sum_prod", rnd("sum_prod", 3))


@query("standardize", f"{WITH_HABITS} SELECT student_id, " + ", ".join(
    f"{dr(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()')} AS {c}" for c in MONITOR_FEATURES) + " FROM habits")
def q_standardize(spark, sf_dir):
    h = habits(spark, sf_dir).select(KEY_COLUMN, *MONITOR_FEATURES)
    z = standardize(h, MONITOR_FEATURES)
    return z.select(KEY_COLUMN, *[rnd(c).alias(c) for c in MONITOR_FEATURES])


def _linear_table(model: LinearModel, results) -> "list":
    best = min(results, key=lambda r: r.cv_rmse)
    rows = []
    scaled = model.coef_scaled() or [None] * len(model.coef)
    for i, (c, b, bs) in enumerate(zip(model.features, model.coef, scaled)):
        rows.append((model.name, float(model.params["alpha"]), float(best.cv_rmse), i, c, float(b),
                     float(bs) if bs is not None else None, float(model.intercept)))
    return rows


_LIN_SCHEMA = ("model_name string, alpha double, cv_rmse double, position int, feature string, coef double, "
               "coef_scaled double, intercept double")


_PAIR = ["study_hours_per_day", "mental_health_rating"]
_D_PAIR = ("s AS (SELECT CAST(count(*) AS DOUBLE) AS n, " + ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_pop(CAST({c} AS DOUBLE)) AS s{i}, covar_pop(CAST({c} AS DOUBLE), exam_score) AS c{i}"
    for i, c in enumerate(_PAIR)) + f", covar_pop(CAST({_PAIR[0]} AS DOUBLE), CAST({_PAIR[1]} AS DOUBLE)) AS c01, avg(exam_score) AS my FROM tr)")


@query("ridge_pair",
       f"{WITH_HABITS}, {D_TRAIN}, {_D_PAIR}, "
       "z AS (SELECT *, n * c01 / (s0 * s1) AS z01, n * c0 / s0 AS y0, n * c1 / s1 AS y1, n + 10e0 AS d FROM s), "
       "w AS (SELECT *, (d * y0 - z01 * y1) / (d * d - z01 * z01) / s0 AS b0, (d * y1 - z01 * y0) / (d * d - z01 * z01) / s1 AS b1 FROM z) "
       f"SELECT {dr('b0')} AS coef_0, {dr('b1')} AS coef_1, {dr('my - b0 * m0 - b1 * m1')} AS intercept FROM w")
def q_ridge_pair(spark, sf_dir):
    """Ridge (alpha 10) on two features, which SQL can solve in closed form."""
    tr, _ = split_frames(spark, sf_dir)
    stats = gram_stats(tr, _PAIR, TARGET_COLUMN, group_col="fold")
    beta, intercept, *_ = ridge_from_stats(stats.total(), 10.0, stats)
    out = spark.createDataFrame([(float(beta[0]), float(beta[1]), float(intercept))], "coef_0 double, coef_1 double, intercept double")
    return out.select(*[rnd(c).alias(c) for c in out.columns])


@query("lasso_single",
       f"{WITH_HABITS}, {D_TRAIN}, {_D_PAIR}, "
       "w AS (SELECT *, sign(c0 / s0) * greatest(abs(c0 / s0) - 1e0, 0e0) / s0 AS b0 FROM s) "
       f"SELECT {dr('b0')} AS coef_0, {dr('my - b0 * m0')} AS intercept FROM w")
def q_lasso_single(spark, sf_dir):
    """Lasso (alpha 1) on one feature: its soft threshold in closed form."""
    tr, _ = split_frames(spark, sf_dir)
    stats = gram_stats(tr, _PAIR[:1], TARGET_COLUMN, group_col="fold")
    beta, intercept, *_ = lasso_from_stats(stats.total(), 1.0, stats)
    out = spark.createDataFrame([(float(beta[0]), float(intercept))], "coef_0 double, intercept double")
    return out.select(*[rnd(c).alias(c) for c in out.columns])


@query("ridge_fit")
def q_ridge_fit(spark, sf_dir):
    """Ridge over the alpha grid (5-fold CV from fold Gram sums), refit on all training rows."""
    tr, _ = split_frames(spark, sf_dir)
    model, res, _ = search_linear(tr, "ridge", RIDGE_ALPHAS)
    return spark.createDataFrame(_linear_table(model, res), _LIN_SCHEMA)


@query("lasso_fit")
def q_lasso_fit(spark, sf_dir):
    """Lasso by coordinate descent on the same Gram sums."""
    tr, _ = split_frames(spark, sf_dir)
    model, res, _ = search_linear(tr, "lasso", LASSO_ALPHAS)
    return spark.createDataFrame(_linear_table(model, res), _LIN_SCHEMA)


@query("feature_weights")
def q_feature_weights(spark, sf_dir):
    """Best ridge: scaled coefficient, effect per original unit, ordered by |effect|."""
    from ..operators.models.weights import feature_weights

    tr, _ = split_frames(spark, sf_dir)
    model, _, _ = search_linear(tr, "ridge", RIDGE_ALPHAS)
    return feature_weights(spark, model)


_KNN_SCALE = "sc AS (SELECT " + ", ".join(f"stddev_pop(CAST({c} AS DOUBLE)) AS s{i}" for i, c in enumerate(FEATURE_COLUMNS)) + " FROM tr)"
_KNN_DIST = " + ".join(f"power((q.{c} - p.{c}) / CASE WHEN s{i} > 0 THEN s{i} ELSE 1e0 END, 2)" for i, c in enumerate(FEATURE_COLUMNS))


@query("knn_predict",
       f"{WITH_HABITS}, {D_TRAIN}, {_KNN_SCALE}, "
       f"d AS (SELECT q.student_id, p.exam_score AS y, round_even(sqrt({_KNN_DIST}), 9) AS dist, p.student_id AS other FROM te q, tr p, sc), "
       "r AS (SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY dist, other) AS n FROM d QUALIFY n <= 5) "
       f"SELECT student_id, {dr('avg(y)', 4)} AS pred_uniform, "
       f"{dr('CASE WHEN min(dist) = 0 THEN avg(CASE WHEN dist = 0 THEN y END) ELSE sum(y / dist) / sum(1 / dist) END', 4)} AS pred_distance "
       "FROM r GROUP BY student_id")
def q_knn_predict(spark, sf_dir):
    """Exact 5-NN predictions (uniform and 1/d) for every test row."""
    from pyspark import StorageLevel

    tr, te = split_frames(spark, sf_dir)
    tr = tr.select(KEY_COLUMN, "fold", *FEATURE_COLUMNS, TARGET_COLUMN).persist(StorageLevel.MEMORY_AND_DISK)
    scale = fold_scales(tr, FEATURE_COLUMNS, None)[-1]
    index = build_knn_index(tr, FEATURE_COLUMNS, TARGET_COLUMN, KEY_COLUMN, "fold")
    nb = knn_neighbors(index, te.select(KEY_COLUMN, *FEATURE_COLUMNS), 5, {-1: scale}, qid=KEY_COLUMN)
    p = cut_lineage(knn_predictions(nb, [5], ["uniform", "distance"], KEY_COLUMN))
    tr.unpersist()
    return p.select(KEY_COLUMN, rnd("pred_k5_uniform", 4).alias("pred_uniform"),
                    rnd("pred_k5_distance", 4).alias("pred_distance"))


def _lsh_found(tr, te):
    scale = fold_scales(tr, FEATURE_COLUMNS, None)[-1]
    index = build_lsh_index(tr, FEATURE_COLUMNS, TARGET_COLUMN, KEY_COLUMN, scale)
    return cut_lineage(lsh_neighbors(index, te.select(KEY_COLUMN, *FEATURE_COLUMNS), 5, KEY_COLUMN)), scale


@query("knn_lsh")
def q_knn_lsh(spark, sf_dir):
    """Approximate 5-NN predictions (uniform and 1/d) for every test row, by random projections with multi-probe buckets."""
    tr, te = map(_kept, split_frames(spark, sf_dir))
    nb, _ = _lsh_found(tr, te)
    tr.unpersist()
    te.unpersist()
    p = knn_predictions(nb, [5], ["uniform", "distance"], KEY_COLUMN)
    return p.select(KEY_COLUMN, rnd("pred_k5_uniform", 4).alias("pred_uniform"), rnd("pred_k5_distance", 4).alias("pred_distance"))


@query("knn_lsh_recall")
def q_knn_lsh_recall(spark, sf_dir):
    """Share of the exact 5 neighbours of all test rows that ``knn_lsh`` finds: one row."""
    tr, te = map(_kept, split_frames(spark, sf_dir))
    nb, scale = _lsh_found(tr, te)
    index = build_knn_index(tr, FEATURE_COLUMNS, TARGET_COLUMN, KEY_COLUMN, "fold")
    exact = cut_lineage(knn_neighbors(index, te.select(KEY_COLUMN, *FEATURE_COLUMNS), 5, {-1: scale}, qid=KEY_COLUMN))
    tr.unpersist()
    te.unpersist()
    return spark.createDataFrame([(exact.count(), float(neighbor_recall(nb, exact, KEY_COLUMN)))], "neighbours long, recall double")


def _tree_query(spark, sf_dir, family):
    tr, te = split_frames(spark, sf_dir)
    tr = _kept(tr.select(KEY_COLUMN, "fold", *FEATURE_COLUMNS, TARGET_COLUMN))
    pm, res, best = search_trees(tr, family, FULL_GRIDS[family])
    tr.unpersist()
    m = pm.transform(te).agg(F.sqrt(F.avg((F.col(TARGET_COLUMN) - F.col("prediction")) ** 2)).alias("rmse")).first()
    rows = [(family, json.dumps(r.params, sort_keys=True), float(r.cv_rmse), float(m["rmse"])) for r in res]
    return spark.createDataFrame(rows, "family string, params string, cv_rmse double, test_rmse double")


@query("rf_fit")
def q_rf_fit(spark, sf_dir):
    """Random forests (all features per split): every candidate read off one forest per fold."""
    return _tree_query(spark, sf_dir, "rf")


@query("gbt_fit")
def q_gbt_fit(spark, sf_dir):
    """Gradient-boosted trees (squared loss, L2 leaf penalty): all settings and folds grown together."""
    return _tree_query(spark, sf_dir, "gbt")


@query("cv_results")
def q_cv_results(spark, sf_dir):
    """The training job: all five families tuned on the full grids, ensemble added, every run
    logged with its bundle; the report sorted by test RMSE."""
    out = scratch_path(spark, "training")
    run_training(spark, habits(spark, sf_dir), out, grids=FULL_GRIDS)
    return spark.read.parquet(f"{out}/report").orderBy("rmse", "position")


# --- M10 / M11 / O4 ----------------------------------------------------------

FIXED_MEMBERS = {
    "fixed_a": (FIXED_INTERCEPT, FIXED_COEF),
    "fixed_b": (0.0, {k: v * 0.9 for k, v in FIXED_COEF.items()}),
    "fixed_c": (10.0, {k: v * 0.8 for k, v in FIXED_COEF.items()}),
}


def _member_models():
    return {n: LinearModel(FEATURE_COLUMNS, [coef[c] for c in FEATURE_COLUMNS], b0, name=n)
            for n, (b0, coef) in FIXED_MEMBERS.items()}


_D_ENS = "(" + " + ".join(d_linear(coef, b0) for b0, coef in FIXED_MEMBERS.values()) + ") / 3e0"


@query("ensemble_average",
       f"{WITH_HABITS}, prep AS (SELECT {d_prepared()} FROM habits) "
       f"SELECT student_id, {dr(_D_ENS)} AS prediction FROM prep")
def q_ensemble_average(spark, sf_dir):
    from .train import EnsembleModel

    p = EnsembleModel(list(_member_models().values())).transform(prepared(spark, sf_dir))
    return p.select(KEY_COLUMN, rnd("prediction").alias("prediction"))


def _metrics_sql(pred: str, name: str, pos: int) -> str:
    e = f"(exam_score - {pred})"
    return (f"SELECT '{name}' AS model_name, {pos} AS pos, sqrt(avg({e} * {e})) AS rmse, avg(abs({e})) AS mae, "
            f"1e0 - sum({e} * {e}) / (var_pop(exam_score) * count(exam_score)) AS r2 FROM te")


@query("best_model",
       f"{WITH_HABITS}, {D_TRAIN}, r AS (" + " UNION ALL ".join(
           [_metrics_sql(d_linear(coef, b0), n, i) for i, (n, (b0, coef)) in enumerate(FIXED_MEMBERS.items())]
           + [_metrics_sql(_D_ENS, "ensemble", len(FIXED_MEMBERS))])
       + f") SELECT model_name, {dr('rmse')} AS rmse, {dr('mae')} AS mae, {dr('r2')} AS r2 FROM r "
         f"ORDER BY rmse, pos LIMIT 1")
def q_best_model(spark, sf_dir):
    from .train import EnsembleModel, evaluate, pick_best

    _, scored = split_frames(spark, sf_dir)
    members = _member_models()
    for n, m in {**members, "ensemble": EnsembleModel(list(members.values()))}.items():
        scored = m.transform(scored, output=f"p_{n}")
    results = [{"model_name": n, "cv_rmse": None, **m} for n, m in evaluate(scored, [*members, "ensemble"]).items()]
    best = pick_best(results)
    row = spark.createDataFrame([(best["model_name"], best["rmse"], best["mae"], best["r2"])],
                                "model_name string, rmse double, mae double, r2 double")
    return row.select("model_name", *[rnd(c).alias(c) for c in ("rmse", "mae", "r2")])


# --- M13 / P11 / P13 / P15 ----------------------------------------------------


def _bound(v) -> str:
    return str(int(v)) if float(v).is_integer() else repr(float(v))


def _d_range_checks() -> list[str]:
    out = []
    for col, (_, lo, hi) in REQUEST_RULES.items():
        out.append(f"CASE WHEN {col} IS NULL THEN {d_fill(MSG_REQUEST_MISSING, field=col)} END")
        if lo is not None:
            out.append(f"CASE WHEN {col} < {lo} THEN {d_fill(MSG_REQUEST_BELOW, field=col, bound=_bound(lo))} END")
        if hi is not None:
            out.append(f"CASE WHEN {col} > {hi} THEN {d_fill(MSG_REQUEST_ABOVE, field=col, bound=_bound(hi))} END")
    return out


def _d_category_checks() -> list[str]:
    out = []
    for col, mapping in CATEGORY_MAPS.items():
        out.append(f"CASE WHEN {col} IS NULL THEN {d_fill(MSG_REQUEST_NOT_TEXT, field=col)} "
                   f"WHEN {d_code(col)} IS NULL THEN "
                   f"{d_fill(MSG_REQUEST_UNKNOWN_LEVEL, field=col, allowed=python_list(mapping))} END")
    return out


_REQ_ERR = "coalesce(" + ", ".join(_d_range_checks() + _d_category_checks()) + ")"


def _d_requests() -> str:
    enc = ", ".join(f"{d_code(c)} AS {c}" if c in CATEGORY_MAPS else c for c in FEATURE_COLUMNS)
    return (f"req AS (SELECT student_id AS request_id, * EXCLUDE (student_id, exam_score) FROM habits), "
            f"v AS (SELECT request_id, {_REQ_ERR} AS error, {enc} FROM req)")


@query("score_requests",
       f"{WITH_HABITS}, {_d_requests()}, p AS (SELECT request_id, error, "
       f"{'greatest(least(' + d_linear(FIXED_COEF, FIXED_INTERCEPT) + ', 1e2), 0e0)'} AS raw FROM v) "
       f"SELECT request_id, CASE WHEN error IS NULL THEN {d_round_python('raw')} END AS predicted_exam_score, error FROM p")
def q_score_requests(spark, sf_dir):
    from .q_prepare import fixed_model

    req = habits(spark, sf_dir).withColumnRenamed(KEY_COLUMN, "request_id").drop(TARGET_COLUMN)
    return score_requests(req, fixed_model(), key="request_id")


_SCEN = {"netflix_hours": -3.0, "social_media_hours": -2.0}


@query("validate_ranges",
       f"{WITH_HABITS}, s AS (SELECT * REPLACE (netflix_hours + -3e0 AS netflix_hours, social_media_hours + -2e0 "
       f"AS social_media_hours) FROM habits) SELECT student_id, concat_ws('; ', {', '.join(_d_range_checks())}) AS errors, "
       f"coalesce({', '.join(_d_range_checks())}) IS NULL AS is_valid FROM s")
def q_validate_ranges(spark, sf_dir):
    h = habits(spark, sf_dir)
    s = h.select(*[(F.col(c) + F.lit(_SCEN[c])).alias(c) if c in _SCEN else F.col(c) for c in h.columns])
    v = validate_ranges(s)
    return v.select(KEY_COLUMN, F.array_join("errors", "; ").alias("errors"), "is_valid")


@query("validate_categories",
       f"{WITH_HABITS} SELECT student_id, coalesce({', '.join(_d_category_checks())}) AS error, "
       f"CAST(" + " + ".join(f"(CASE WHEN ({c}) IS NULL THEN 0 ELSE 1 END)" for c in _d_category_checks())
       + " AS INTEGER) AS n_errors FROM habits")
def q_validate_categories(spark, sf_dir):
    v = validate_categories(habits(spark, sf_dir))
    return v.select(KEY_COLUMN, "error", F.size("errors").cast("int").alias("n_errors"))


@query("validate_vector",
       f"{WITH_HABITS}, prep AS (SELECT {d_prepared()} FROM habits) SELECT student_id, CAST(14 AS INTEGER) AS n_features, "
       f"CASE WHEN {' OR '.join(f'{c} IS NULL' for c in FEATURE_COLUMNS)} THEN {d_str(MSG_VECTOR_TYPES)} "
       f"END AS error, NOT ({' OR '.join(f'{c} IS NULL' for c in FEATURE_COLUMNS)}) AS is_valid FROM prep")
def q_validate_vector(spark, sf_dir):
    p = prepared(spark, sf_dir).withColumn("features", feature_array())
    return validate_vector(p).select(KEY_COLUMN, "n_features", "error", "is_valid")


# --- S1 / S2 / S11 -------------------------------------------------------------


@query("scan_na_tokens", f"{WITH_HABITS} SELECT * FROM habits")
def q_scan_na_tokens(spark, sf_dir):
    """Habits written as CSV with 'NA' for nulls, read back with the NA-token list."""
    path = scratch_path(spark, "habits-csv")
    write_csv(habits(spark, sf_dir), path, na="NA")
    return read_csv_typed(spark, path)


def _maps_values() -> str:
    return ", ".join(f"('{c}', '{lvl}', {code}, {i})" for c, m in CATEGORY_MAPS.items()
                     for i, (lvl, code) in enumerate(m.items()))


@query("category_map_table",
       f"{WITH_HABITS}, m AS (SELECT * FROM (VALUES {_maps_values()}) AS t(column_name, level, code, position)), "
       f"l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {d_title(d_strip(c))} AS level FROM habits"
                                      for c in CATEGORY_MAPS) + "), "
       f"c AS (SELECT column_name, level, count(*) AS n FROM l GROUP BY ALL) "
       f"SELECT m.column_name, m.level, CAST(m.code AS INTEGER) AS code, CAST(coalesce(c.n, 0) AS BIGINT) AS n "
       f"FROM m LEFT JOIN c ON m.column_name = c.column_name AND m.level = c.level")
def q_category_map_table(spark, sf_dir):
    """Code maps written and read back as JSON, joined with observed cleaned levels."""
    from ..functions.text import clean_level

    path = scratch_path(spark, "maps")
    write_category_maps(spark, path)
    maps = read_category_maps(spark, path)
    h = habits(spark, sf_dir)
    lv = h.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), clean_level(c).alias("level"))
                                      for c in CATEGORY_MAPS])).alias("s")).select("s.*")
    counts = lv.groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    # observed levels can be many (junk text): no forced broadcast, AQE sizes the join at runtime
    return maps.join(counts, ["column", "level"], "left").select(
        F.col("column").alias("column_name"), "level", F.col("code").cast("int"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query("runs_table")
def q_runs_table(spark, sf_dir):
    """One run per linear family logged with params and metrics, read back from the runs table."""
    tr, te = split_frames(spark, sf_dir)
    path = scratch_path(spark, "runs")
    for fam, alphas in (("ridge", RIDGE_ALPHAS), ("lasso", LASSO_ALPHAS)):
        model, res, _ = search_linear(tr, fam, alphas)
        e = F.col(TARGET_COLUMN) - model.prediction_column()
        m = te.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae")).first().asDict()
        log_run(spark, path, model.name, {"alpha": model.params["alpha"], "cv_folds": 5}, m, None)
    return runs(spark, path).select("run_id", "run_name", F.to_json("params").alias("params"),
                                    F.to_json("metrics").alias("metrics"))
