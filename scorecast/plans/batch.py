"""End-to-end train-and-score job (the monthly flow), as one Spark application.

load -> quality report -> prepare -> split -> train two fixed models (ridge
alpha=1, forest 100 trees depth 10) -> runs table -> save best bundle ->
sample n rows with replacement -> reload the model by run id -> score ->
write predictions partitioned by run id. The model is handed over through
the runs table and saved artefacts, not in memory.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import regression_metric_columns
from ..operators.models.linear import gram_stats, ridge_from_stats, LinearModel
from ..operators.models.search import tree_estimator
from ..operators.profile import missing_report
from ..operators.sampling import bootstrap_sample
from ..operators.score import score_batch
from ..schema import BATCH_SAMPLE_SIZE, FEATURE_COLUMNS, KEY_COLUMN, SPLIT_SEED, TARGET_COLUMN
from ..session import scratch_path
from ..sources.artifacts import load_run_model, log_run, new_run_id, save_best_model
from ..sources.files import write_predictions
from ..sources.standin import habits
from .train import TreeModel, prepare_split


@dataclass
class BatchRun:
    run_id: str
    best_name: str
    metrics: dict
    predictions_path: str
    quality: list


def quality_report(raw: DataFrame) -> list:
    """Missing counts per column (only columns with nulls) plus target summary."""
    miss = [r.asDict() for r in missing_report(raw).collect()]
    tgt = raw.agg(F.count(TARGET_COLUMN).alias("count"), F.avg(TARGET_COLUMN).alias("mean"),
                  F.stddev_samp(TARGET_COLUMN).alias("std"), F.min(TARGET_COLUMN).alias("min"),
                  F.max(TARGET_COLUMN).alias("max")).first().asDict()
    return miss + [{"target": tgt}]


def generate_batch(raw: DataFrame, n: int = BATCH_SAMPLE_SIZE, seed: int | None = SPLIT_SEED) -> DataFrame:
    """n rows drawn with replacement; key and target removed (``draw_id`` kept)."""
    return bootstrap_sample(raw, n, seed).drop(KEY_COLUMN, TARGET_COLUMN)


def train_fixed_models(spark: SparkSession, raw: DataFrame, runs_path: str, models_root: str, seed: int = 42):
    preparer, data = prepare_split(raw)
    good = data.where("__complete")
    train_df = good.where(~F.col("is_test")).select(KEY_COLUMN, *FEATURE_COLUMNS, TARGET_COLUMN).cache()
    test_df = good.where(F.col("is_test")).select(KEY_COLUMN, *FEATURE_COLUMNS, TARGET_COLUMN)

    stats = gram_stats(train_df, FEATURE_COLUMNS, TARGET_COLUMN)
    beta, b0, mean_x, scale = ridge_from_stats(stats.total(), 1.0, stats)
    ridge = LinearModel(FEATURE_COLUMNS, list(map(float, beta)), float(b0), name="RidgeRegression",
                        params={"alpha": 1.0}, mean=list(map(float, mean_x)), scale=list(map(float, scale)))
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    rf_params = {"numTrees": 100, "maxDepth": 10, "minSplit": 2}
    rf_pipe = Pipeline(stages=[VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features"),
                               tree_estimator("rf", rf_params, seed=seed)]).fit(train_df)
    forest = TreeModel(rf_pipe, "RandomForest", rf_params)

    scored = forest.transform(ridge.transform(test_df, "p_ridge"), output="p_rf")
    row = scored.agg(*regression_metric_columns(TARGET_COLUMN, "p_ridge", "ridge_"),
                     *regression_metric_columns(TARGET_COLUMN, "p_rf", "rf_")).first()
    candidates = [("RidgeRegression", ridge, {"model_type": "RidgeRegression", "alpha": 1.0}, "ridge_"),
                  ("RandomForest", forest, {"model_type": "RandomForest", "n_estimators": 100, "max_depth": 10,
                                            "random_state": seed}, "rf_")]
    best = None
    for name, model, params, pre in candidates:
        metrics = {m: float(row[f"{pre}{m}"]) for m in ("rmse", "mae", "r2")}
        run_id = new_run_id()
        path = f"{models_root}/{run_id}"
        save_best_model(spark, path, model, name, metrics, preparer)
        log_run(spark, runs_path, name, params, metrics, path, run_id=run_id)
        if best is None or metrics["rmse"] < best[2]["rmse"]:
            best = (run_id, name, metrics)
    train_df.unpersist()
    return best, preparer


def run_batch(spark: SparkSession, raw: DataFrame, out_root: str, n_samples: int = BATCH_SAMPLE_SIZE,
              seed: int = SPLIT_SEED) -> tuple[BatchRun, DataFrame]:
    quality = quality_report(raw)
    runs_path, models_root = f"{out_root}/runs", f"{out_root}/models"
    (run_id, best_name, metrics), _ = train_fixed_models(spark, raw, runs_path, models_root, seed)
    batch = generate_batch(raw, n_samples, seed)
    bundle = load_run_model(spark, runs_path, run_id)           # hand-over through the runs table
    scored = score_batch(batch, bundle["model"], bundle["preparer"])
    pred_path = write_predictions(scored, f"{out_root}/predictions", run_id)
    # the id comes back as text whatever it looks like
    written = spark.read.schema(scored.withColumn("run_id", F.lit(run_id)).schema).parquet(f"{out_root}/predictions")
    result = written.where(F.col("run_id") == run_id)
    return BatchRun(run_id, best_name, metrics, pred_path, quality), result


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's smoke query: the full monthly flow on the stand-in table."""
    out = scratch_path(spark, "flagship")
    _, result = run_batch(spark, habits(spark, sf_dir), out)
    return result.drop("run_id")
