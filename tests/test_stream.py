"""Event decoding, strict encoding and error responses; stream vs batch equality."""

import base64
import json

from pyspark.sql import functions as F

from scorecast.operators.models.linear import LinearModel
from scorecast.schema import FEATURE_COLUMNS
from scorecast.streaming.score_stream import ENVELOPE_SCHEMA, decode_messages, score_events, start_scoring_stream

FEATURES = {"age": 20, "gender": "Male", "study_hours_per_day": 6.0, "social_media_hours": 2.0, "netflix_hours": 1.0,
            "part_time_job": "No", "attendance_percentage": 90.0, "sleep_hours": 7.0, "diet_quality": "Good",
            "exercise_frequency": 3, "parental_education_level": "Bachelor", "internet_quality": "Good",
            "mental_health_rating": 8, "extracurricular_participation": "Yes"}
MODEL = LinearModel(FEATURE_COLUMNS, [1.0 if c == "study_hours_per_day" else 0.0 for c in FEATURE_COLUMNS], 60.0)


def b64(obj) -> str:
    text = obj if isinstance(obj, str) else json.dumps(obj)
    return base64.b64encode(text.encode()).decode()


def cases():
    return {
        "ok": b64({"student_id": "ok", "features": FEATURES}),
        "unknown": b64({"student_id": "unknown", "features": dict(FEATURES, gender="Robot")}),
        "absent": b64({"student_id": "absent", "features": {k: v for k, v in FEATURES.items() if k != "age"}}),
        "nofeatures": b64({"student_id": "nofeatures"}),
        "flat": b64(dict(FEATURES, student_id="flat")),
        "badnum": b64({"student_id": "badnum", "features": dict(FEATURES, sleep_hours="lots")}),
        "badjson": b64("{not json"),
        "badb64": "%%%not-base64%%%",
    }


def test_event_errors(spark):
    c = cases()
    df = spark.createDataFrame([(k, v) for k, v in c.items()], "case string, data string")
    dec = decode_messages(df)
    errs = {r["case"]: r["decode_error"] for r in dec.select("case", "decode_error").collect()}
    assert errs["badjson"] == "invalid JSON" and errs["badb64"] == "invalid base64" and errs["ok"] is None
    out = {r["student_id"]: r for r in score_events(dec, MODEL).collect()}
    assert out["ok"]["predicted_exam_score"] == 66.0 and out["ok"]["error"] is None
    assert json.loads(out["ok"]["response"]) == {"prediction": {"student_id": "ok", "predicted_exam_score": 66.0}}
    assert out["unknown"]["error"] == "Invalid value 'Robot' for field 'gender'. Allowed: ['Male', 'Female', 'Other']"
    assert out["absent"]["error"] == "Missing required features: ['age']"
    assert out["nofeatures"]["error"].startswith("Missing required features: ['age', 'gender', ")
    assert out["flat"]["error"] == out["nofeatures"]["error"]
    assert out["badnum"]["error"] == "could not convert value to float: 'lots'"
    assert json.loads(out["unknown"]["response"])["prediction"].keys() == {"student_id", "error"}


def test_stream_equals_batch_and_dead_letters(spark, tmp_out):
    c = cases()
    rows = [json.dumps({"message": {"data": v, "message_id": k}}) for k, v in c.items()]
    spark.createDataFrame([(r,) for r in rows], "value string").repartition(3).write.text(f"{tmp_out}/in")
    q = start_scoring_stream(spark, f"{tmp_out}/in", f"{tmp_out}/out", f"{tmp_out}/dead", f"{tmp_out}/ckpt", MODEL,
                             max_files_per_trigger=1)
    q.awaitTermination()
    streamed = spark.read.parquet(f"{tmp_out}/out").drop("epoch")
    batch = score_events(decode_messages(spark.read.schema(ENVELOPE_SCHEMA).json(f"{tmp_out}/in")
                                         .select(F.col("message.data").alias("data"))), MODEL)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.select(*streamed.columns).collect()))
    dead = spark.read.parquet(f"{tmp_out}/dead").select("decode_error").collect()
    assert sorted(r[0] for r in dead) == ["invalid JSON", "invalid base64"]
