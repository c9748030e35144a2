"""The reference's prediction-core and API cases, as table-level checks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorecast.functions.numeric import clip_score
from scorecast.operators.models.linear import LinearModel
from scorecast.operators.score import score_requests
from scorecast.operators.validate import check_vector_schema, validate_vector
from scorecast.schema import FEATURE_COLUMNS

VECTOR = [20, 0, 6.0, 2.0, 1.0, 0, 90.0, 7.0, 2, 3, 1, 2, 8, 1]
REQUEST = {"age": 20, "gender": "Male", "study_hours_per_day": 6.0, "social_media_hours": 2.0, "netflix_hours": 1.0,
           "part_time_job": "No", "attendance_percentage": 90.0, "sleep_hours": 7.0, "diet_quality": "Good",
           "exercise_frequency": 3, "parental_education_level": "Bachelor", "internet_quality": "Good",
           "mental_health_rating": 8, "extracurricular_participation": "Yes"}
REQ_SCHEMA = T.StructType([T.StructField("request_id", T.StringType())] + [
    T.StructField(c, T.IntegerType() if c in ("age", "exercise_frequency", "mental_health_rating") else
                  T.DoubleType() if isinstance(REQUEST[c], float) else T.StringType()) for c in FEATURE_COLUMNS])


def constant(v):
    return LinearModel(FEATURE_COLUMNS, [0.0] * 14, v, name="constant")


def test_vector_checks(spark):
    rows = [("ok", [float(x) for x in VECTOR]), ("few", [20.0, 0.0, 6.0]), ("many", [float(x) for x in VECTOR] + [1.0]),
            ("null", [float(x) if i != 3 else None for i, x in enumerate(VECTOR)])]
    df = spark.createDataFrame(rows, "id string, features array<double>")
    out = {r["id"]: r for r in validate_vector(df).collect()}
    assert out["ok"]["is_valid"] and out["ok"]["n_features"] == 14
    assert out["few"]["error"] == "Student-habits input must contain exactly 14 features, got 3."
    assert out["many"]["error"] == "Student-habits input must contain exactly 14 features, got 15."
    assert out["null"]["error"] == "All features must be numeric (int or float)."


def test_vector_schema_rejects_text_and_boolean(spark):
    good = spark.createDataFrame([tuple(float(x) for x in VECTOR)], FEATURE_COLUMNS)
    check_vector_schema(good)
    with pytest.raises(ValueError):
        check_vector_schema(good.withColumn("gender", F.lit("zero")))
    with pytest.raises(ValueError):
        check_vector_schema(good.withColumn("part_time_job", F.lit(False)))


def test_constant_model_and_shape(spark):
    df = spark.createDataFrame([tuple(float(x) for x in VECTOR)], FEATURE_COLUMNS)
    assert constant(75.0).transform(df).first()["prediction"] == 75.0
    assert constant(82.5).transform(df).count() == 1


@pytest.mark.parametrize("raw,expected", [(50.0, 50.0), (150.0, 100.0), (-10.0, 0.0), (75, 75.0), (None, None)])
def test_clip(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "s int" if isinstance(raw, int) else "s double")
    assert df.select(clip_score("s").alias("c")).first()["c"] == expected


def _requests(spark, variants):
    rows = []
    for rid, changes in variants.items():
        r = dict(REQUEST, **changes)
        rows.append((rid, *[r.get(c) for c in FEATURE_COLUMNS]))
    return spark.createDataFrame(rows, REQ_SCHEMA)


def test_request_cases(spark):
    df = _requests(spark, {"happy": {}, "no_age": {"age": None}, "mental15": {"mental_health_rating": 15},
                           "robot": {"gender": "Robot"}, "lower": {"gender": "male"}, "padded": {"gender": "  FEMALE\t"}})
    out = {r["request_id"]: r for r in score_requests(df, constant(75.0)).collect()}
    assert out["happy"]["predicted_exam_score"] == 75.0 and out["happy"]["error"] is None
    assert out["no_age"]["error"] == "age: field required"
    assert out["mental15"]["error"] == "mental_health_rating: must be less than or equal to 10"
    assert out["robot"]["error"] == "Invalid value for gender. Allowed values: ['Male', 'Female', 'Other']"
    assert out["robot"]["predicted_exam_score"] is None
    assert out["lower"]["error"] is None and out["lower"]["predicted_exam_score"] == 75.0
    assert out["padded"]["error"] is None


def test_request_text_fields_must_be_text(spark):
    df = _requests(spark, {"r1": {}}).withColumn("gender", F.lit(0))
    out = score_requests(df, constant(75.0)).first()
    assert out["error"] == "Invalid value for gender. This field must be text"
    assert out["predicted_exam_score"] is None


def test_request_prediction_is_clipped(spark):
    df = _requests(spark, {"hi": {}})
    assert score_requests(df, constant(150.0)).first()["predicted_exam_score"] == 100.0
    assert score_requests(df, constant(150.0), clip=False).first()["predicted_exam_score"] == 150.0
