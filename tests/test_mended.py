"""Cases that once gave wrong results."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecast.functions.numeric import round_python
from scorecast.functions.text import clean_level, encode_level
from scorecast.operators.models.knn import KnnModel, build_knn_index
from scorecast.operators.models.linear import LinearModel
from scorecast.operators.monitor import drift_summary, ks_drift
from scorecast.operators.sampling import bootstrap_sample
from scorecast.operators.score import predict
from scorecast.operators.validate import validate_vector
from scorecast.plans.train import EnsembleModel
from scorecast.schema import METRICS_SCHEMA
from scorecast.sources.files import append_metrics, latest_batch, read_metrics, write_batch

SCORED = ("age int, study_hours_per_day double, social_media_hours double, netflix_hours double, attendance_percentage double, "
          "sleep_hours double, exercise_frequency int, mental_health_rating int, exam_score double, prediction double")


@pytest.mark.parametrize("method", ["pvalue", "critical"])
def test_drift_of_an_all_null_feature(spark, method):
    ref = spark.createDataFrame([(float(i), float(i)) for i in range(50)], "a double, b double")
    cur = spark.createDataFrame([(None, float(i) + 40) for i in range(20)], "a double, b double")
    ks = ks_drift(ref, cur, ["a", "b"], method=method)
    rows = {r["feature"]: r for r in ks.collect()}
    assert not rows["a"]["drifted"] and rows["a"]["d"] is None and rows["a"]["warning"] and rows["b"]["drifted"]
    assert drift_summary(ks, 2).first()["drifted_feature_names"] == "b"


def test_nan_counts_as_missing(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(30)], "a double")
    cur = spark.createDataFrame([(float("nan"),)] + [(float(i),) for i in range(9)], "a double")
    r = ks_drift(ref, cur, ["a"]).first()
    assert (r["n_cur"], r["null_cur"], r["drifted"]) == (9, 1, False) and r["warning"]


def test_bootstrap_on_a_repeated_key(spark):
    df = spark.range(100).select((F.col("id") / 10).cast("int").alias("k"), "id")
    rows = bootstrap_sample(df, 20, seed=1, key="k").collect()
    assert sorted(r["draw_id"] for r in rows) == list(range(20))
    assert all(r["k"] == r["id"] // 10 for r in rows)


def knn(spark, n=60):
    train = spark.createDataFrame([(f"p{i}", float(i), float(i)) for i in range(n)], "student_id string, x double, y double")
    index = build_knn_index(train, ["x"], "y", "student_id", fold_col=None)
    return KnnModel(index, 3, "uniform", np.array([1.0]))


def test_knn_queries_that_share_a_key(spark):
    queries = spark.createDataFrame([("a", 1.0), ("a", 50.0), (None, 30.0)], "student_id string, x double")
    assert sorted(round(r["prediction"], 6) for r in knn(spark).transform(queries).collect()) == [1.0, 30.0, 50.0]


def test_ensemble_with_a_knn_member_scores_rows_without_the_training_key(spark):
    ensemble = EnsembleModel([knn(spark), LinearModel(["x"], [1.0], 2.0, "line")])
    batch = spark.createDataFrame([(0, 10.0), (1, 20.0), (1, 20.0)], "draw_id int, x double")
    out = predict(ensemble, batch, ["x"])
    assert sorted(round(r["prediction"], 6) for r in out.collect()) == [11.0, 21.0, 21.0]


def test_newest_batch_of_several_files(spark, tmp_out):
    rows = [(20, 6.0, 2.0, 1.0, 90.0, 7.0, 3, 8, 70.0, float(i)) for i in range(10)]
    write_batch(spark.createDataFrame(rows[:4], SCORED), f"{tmp_out}/b", "ffff0000")
    write_batch(spark.createDataFrame(rows, SCORED).repartition(3), f"{tmp_out}/b", "00123456")
    batch_id, newest = latest_batch(spark, f"{tmp_out}/b")
    assert batch_id == "00123456" and sorted(r["prediction"] for r in newest.collect()) == [float(i) for i in range(10)]
    with pytest.raises(FileNotFoundError):
        latest_batch(spark, f"{tmp_out}/none")


@pytest.mark.parametrize("batch_id", ["00123456", "1234e567", "1234567d"])
def test_batch_ids_stay_text(spark, tmp_out, batch_id):
    row = [(datetime.datetime(2020, 1, 1), batch_id, 3, 0, 0.0, None, 1.0, 1.0, 0.0, 71.0, 0.0, 71.0, 71.0)]
    append_metrics(spark.createDataFrame(row, METRICS_SCHEMA), f"{tmp_out}/m")
    assert [r["batch_id"] for r in read_metrics(spark, f"{tmp_out}/m").collect()] == [batch_id]


def test_python_rounding(spark):
    values = [2.675, 2.665, 0.125, 0.375, 1.005, -2.675, -0.125, 99.995, 1e17, 0.0, -0.004, 33.335, 47.145, 1 / 3] + [i / 1000 for i in range(0, 5000, 7)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_python("v", 2).alias("r"), round_python("v", 1).alias("r1"))
    for r in df.collect():
        assert r["r"] == round(r["v"], 2) and r["r1"] == round(r["v"], 1), r
    assert spark.range(1).select(round_python(F.lit(None).cast("double")).alias("r")).first()["r"] is None


def test_levels_are_cleaned_as_python_does(spark):
    values = ["\u00a0Male\u2003", "high-school  o'neil", "3rd year", " \t fair\x1c", "MASTER", "\u00e9cole", "", "bachelor\u200a"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", clean_level("v").alias("c"), encode_level("v", {"Male": 0, "Fair": 1}).alias("e"))
    for r in df.collect():
        assert r["c"] == r["v"].strip().title()
    assert [r["e"] for r in df.collect()][:4] == [0, None, None, 1]


def test_nan_is_a_number_in_a_feature_vector(spark):
    df = spark.createDataFrame([([1.0, float("nan")],), ([1.0, None],), ([1.0],)], "features array<double>")
    assert [r["is_valid"] for r in validate_vector(df, expected=2).collect()] == [True, False, False]
