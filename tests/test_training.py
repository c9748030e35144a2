"""The training job: every family tuned, logged, saved, loaded back and able to score a batch."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from scorecast.operators.sampling import bootstrap_sample
from scorecast.operators.score import score_batch
from scorecast.plans.train import SMOKE_GRIDS, run_training
from scorecast.schema import FEATURE_COLUMNS
from scorecast.sources.artifacts import load_bundle, load_run_model, runs
from scorecast.sources.standin import habits


def test_training_job(spark, tmp_out):
    raw = habits(spark, SF_SMALL)
    best_run, result = run_training(spark, raw, tmp_out, grids=SMOKE_GRIDS)
    names = {"RidgeRegression", "Lasso", "KNN", "RandomForest", "XGBoost", "VotingRegressor"}
    report = spark.read.parquet(f"{tmp_out}/report").orderBy("rmse", "position").collect()
    assert {r["model_name"] for r in report} == names and report[0]["model_name"] == result.best_name
    logged = {r["run_name"]: r for r in runs(spark, f"{tmp_out}/runs").collect()}
    assert set(logged) == names and logged[result.best_name]["run_id"] == best_run
    assert all(set(r["metrics"]) >= {"rmse", "mae", "r2"} for r in logged.values())
    for r in logged.values():  # how the run came about
        assert {"cv_folds", "param_grid", "train_rows", "test_rows", "n_features", "error_rows"} <= set(r["params"])
        assert r["params"]["n_features"] == "14" and r["params"]["cv_folds"] == "5" and int(r["params"]["train_rows"]) > int(r["params"]["test_rows"]) > 0
    assert all(r[m] == round(r[m], 4) for r in report for m in ("rmse", "mae", "r2"))
    assert load_bundle(spark, f"{tmp_out}/best")["model_info"]["best_model_name"] == result.best_name
    batch = bootstrap_sample(raw, 12, seed=5).drop("student_id", "exam_score").cache()
    for name, run in logged.items():  # all five kinds and the ensemble
        bundle = load_run_model(spark, f"{tmp_out}/runs", run["run_id"])
        assert bundle["feature_columns"] == FEATURE_COLUMNS
        got = {r["draw_id"]: r["predicted_exam_score"] for r in score_batch(batch, bundle["model"], bundle["preparer"]).collect()}
        want = {r["draw_id"]: r["predicted_exam_score"] for r in score_batch(batch, result.models[name], result.preparer).collect()}
        assert len(got) == 12 and got == pytest.approx(want), name
    assert batch.select(F.count_distinct("draw_id")).first()[0] == 12
