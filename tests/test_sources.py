"""Sources and sinks: NA tokens, code maps, latest batch, metrics append,
model artefacts and the runs table."""

import datetime
import os
import time

import pytest
from pyspark.sql import functions as F

from scorecast.operators.models.linear import LinearModel
from scorecast.operators.prepare import Preparer
from scorecast.schema import CATEGORY_MAPS, FEATURE_COLUMNS, METRICS_SCHEMA, RAW_COLUMNS
from scorecast.sources.artifacts import load_run_model, log_run, save_best_model
from scorecast.sources.files import (append_metrics, latest_batch, maps_to_dict, read_category_maps, read_csv_typed,
                                     read_metrics, write_batch)


def test_na_tokens(spark, tmp_out):
    header = ",".join(RAW_COLUMNS)
    lines = [header,
             "S1,20,Male,6.0,2.0,1.0,No,90.0,7.0,Good,3,None,Good,8,Yes,70.5",
             "S2,NA,Female,n/a,2.0,1.0,No,90.0,7.0,Good,3,Master,Good,8,Yes,",
             "S3,abc,Other,5.5,NULL,1.0,Yes,88.0,6.5,Poor,2,#N/A,Poor,5,No,60.0"]
    os.makedirs(f"{tmp_out}/csv")
    with open(f"{tmp_out}/csv/part.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    df = {r["student_id"]: r for r in read_csv_typed(spark, f"{tmp_out}/csv").collect()}
    assert df["S1"]["parental_education_level"] is None          # the literal 'None' is missing
    assert df["S2"]["age"] is None and df["S2"]["study_hours_per_day"] is None and df["S2"]["exam_score"] is None
    assert df["S3"]["age"] is None and df["S3"]["social_media_hours"] is None   # unparsable -> null
    assert df["S1"]["exam_score"] == 70.5


def test_nested_maps_document(spark, tmp_out):
    import json

    os.makedirs(f"{tmp_out}/maps")
    with open(f"{tmp_out}/maps/category_maps.json", "w") as fh:
        json.dump(CATEGORY_MAPS, fh, indent=2)
    assert maps_to_dict(read_category_maps(spark, f"{tmp_out}/maps")) == CATEGORY_MAPS


def test_latest_batch_and_metrics(spark, tmp_out):
    rows = [(20, 6.0, 2.0, 1.0, 90.0, 7.0, 3, 8, 70.0, 71.0)]
    cols = "age int, study_hours_per_day double, social_media_hours double, netflix_hours double, " \
           "attendance_percentage double, sleep_hours double, exercise_frequency int, mental_health_rating int, " \
           "exam_score double, prediction double"
    write_batch(spark.createDataFrame(rows, cols), f"{tmp_out}/b", "aaaa1111")
    time.sleep(1.2)
    write_batch(spark.createDataFrame(rows * 3, cols), f"{tmp_out}/b", "bbbb2222")
    bid, batch = latest_batch(spark, f"{tmp_out}/b")
    assert bid == "bbbb2222" and batch.count() == 3
    with pytest.raises(FileNotFoundError):
        latest_batch(spark, f"{tmp_out}/empty")
    row = spark.createDataFrame([(datetime.datetime(2020, 1, 1), bid, 3, 0, 0.0, None, 1.0, 1.0, 0.0, 71.0, 0.0, 71.0,
                                  71.0)], METRICS_SCHEMA)
    append_metrics(row, f"{tmp_out}/m")
    append_metrics(row, f"{tmp_out}/m")          # replay of the same batch
    append_metrics(row.withColumn("batch_id", F.lit("other")), f"{tmp_out}/m")
    m = read_metrics(spark, f"{tmp_out}/m")
    assert m.count() == 2 and m.schema["timestamp"].dataType.typeName() == "timestamp_ntz"


def test_model_bundle_and_runs(spark, tmp_out):
    model = LinearModel(FEATURE_COLUMNS, [0.5] * 14, 3.0, name="RidgeRegression", params={"alpha": 1.0},
                        mean=[1.0] * 14, scale=[2.0] * 14)
    prep = Preparer(fills={"parental_education_level": "Master"})
    path = save_best_model(spark, f"{tmp_out}/bundle", model, "RidgeRegression", {"rmse": 1.0, "mae": 0.5, "r2": 0.9},
                           prep)
    run_id = log_run(spark, f"{tmp_out}/runs", "RidgeRegression", {"alpha": 1.0}, {"rmse": 1.0}, path)
    b = load_run_model(spark, f"{tmp_out}/runs", run_id)
    assert b["model"].coef == model.coef and b["model"].intercept == 3.0
    assert b["feature_columns"] == FEATURE_COLUMNS
    assert b["model_info"]["best_model_name"] == "RidgeRegression"
    assert b["category_maps"] == CATEGORY_MAPS
    assert b["preparer"].fills == {"parental_education_level": "Master"}
    with pytest.raises(KeyError):
        load_run_model(spark, f"{tmp_out}/runs", "missing")


def test_short_id_and_utc_clock():
    from scorecast.plans.monitoring import new_batch_id, utc_now

    ids = {new_batch_id() for _ in range(50)}
    assert len(ids) == 50 and all(len(i) == 8 and int(i, 16) >= 0 for i in ids)
    before = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    assert utc_now().tzinfo is None and 0 <= (utc_now() - before).total_seconds() < 60


def test_monitoring_cycle_appends_once_per_batch(spark, tmp_out):
    from scorecast.operators.models.linear import LinearModel
    from scorecast.plans.monitoring import calculate_metrics, generate_batch, prepare_reference
    from scorecast.sources.standin import habits

    from conftest import SF_SMALL

    raw = habits(spark, SF_SMALL)
    prep = Preparer().fit(raw)
    model = LinearModel(FEATURE_COLUMNS, [1.0] * 14, 10.0)
    prepare_reference(raw, model, prep, f"{tmp_out}/ref")
    first = generate_batch(raw, model, prep, f"{tmp_out}/b", seed=1)
    assert calculate_metrics(spark, f"{tmp_out}/ref", f"{tmp_out}/b", f"{tmp_out}/m") == first
    assert calculate_metrics(spark, f"{tmp_out}/ref", f"{tmp_out}/b", f"{tmp_out}/m") == first   # replay
    time.sleep(1.2)
    second = generate_batch(raw, model, prep, f"{tmp_out}/b", seed=2, drift=False)
    assert calculate_metrics(spark, f"{tmp_out}/ref", f"{tmp_out}/b", f"{tmp_out}/m") == second
    m = {r["batch_id"]: r for r in read_metrics(spark, f"{tmp_out}/m").collect()}
    assert set(m) == {first, second} and m[first]["batch_size"] == 50
    assert "study_hours_per_day" in (m[first]["drifted_feature_names"] or "")
