"""Stateless per-event scoring on a stream of base64 JSON messages.

decode (base64 -> UTF-8 -> JSON, undecodable -> dead letter) -> strict
category encoding (first unknown level in map order is the error, naming the
original value and the allowed list) -> missing-feature check -> numeric
casts -> predict -> clip to 0..100 -> round 2 -> response JSON. Every
failure after decoding becomes an ``error`` response; the query never dies
on bad data.

The projections are plain column expressions, so the same function serves a
batch DataFrame and a streaming one. Sinks write through ``foreachBatch``
keyed by the micro-batch id, so a replayed micro-batch overwrites itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import clip_score, round_python
from ..functions.text import clean_level, fill, map_literal, python_list
from ..operators.models.linear import LinearModel
from ..schema import (CATEGORY_MAPS, EVENT_SCHEMA, FEATURE_COLUMNS, MSG_EVENT_BAD_NUMBER, MSG_EVENT_MISSING_FEATURES,
                      MSG_EVENT_UNKNOWN_LEVEL)

ENVELOPE_SCHEMA = T.StructType([T.StructField("message", T.StructType([
    T.StructField("data", T.StringType()), T.StructField("message_id", T.StringType())]))])


def decode_messages(df: DataFrame, data_col: str = "data") -> DataFrame:
    """Adds ``event`` (student_id, features, _corrupt_record) and ``decode_error``."""
    raw = F.try_to_binary(F.col(data_col), F.lit("base64"))
    text = F.try_validate_utf8(raw.cast("string"))
    out = df.withColumn("__text", text).withColumn(
        "event", F.from_json("__text", EVENT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    err = (F.when(F.col(data_col).isNull(), F.lit("missing data"))
           .when(raw.isNull(), F.lit("invalid base64"))
           .when(F.col("__text").isNull(), F.lit("invalid UTF-8"))
           .when(F.col("event._corrupt_record").isNotNull() | F.col("event").isNull(), F.lit("invalid JSON")))
    return out.withColumn("decode_error", err).drop("__text")


def _py_list(items: Column) -> Column:
    """Render an array of names like a Python list: ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                    F.lit("]"))


def encode_event_features(features: Column, maps: dict | None = None) -> tuple[dict, Column, Column]:
    """(encoded feature columns, category error, missing-features error)."""
    maps = maps or CATEGORY_MAPS
    feats = F.coalesce(features, F.create_map().cast("map<string,string>"))
    encoded, cat_errors = {}, []
    for c in FEATURE_COLUMNS:
        v = F.try_element_at(feats, F.lit(c))
        present = F.map_contains_key(feats, F.lit(c))
        if c in maps:
            code = F.try_element_at(map_literal(maps[c]), clean_level(v))
            cat_errors.append(F.when(present & code.isNull(), fill(
                MSG_EVENT_UNKNOWN_LEVEL, value=F.coalesce(v, F.lit("None")), field=c, allowed=python_list(maps[c]))))
            encoded[c] = code.cast("int")
        else:
            encoded[c] = v.try_cast("double")
    cat_error = F.coalesce(*cat_errors)
    missing = F.filter(F.array(*[F.lit(c) for c in FEATURE_COLUMNS]), lambda name: ~F.map_contains_key(feats, name))
    missing_error = F.when(F.size(missing) > 0, fill(MSG_EVENT_MISSING_FEATURES, names=_py_list(missing)))
    bad_numbers = F.array_compact(F.array(*[
        F.when(F.map_contains_key(feats, F.lit(c)) & encoded[c].isNull(),
               fill(MSG_EVENT_BAD_NUMBER, value=F.coalesce(F.try_element_at(feats, F.lit(c)), F.lit("None"))))
        for c in FEATURE_COLUMNS if c not in maps]))
    number_error = F.try_element_at(bad_numbers, F.lit(1))
    return encoded, cat_error, F.coalesce(missing_error, number_error)


def score_events(decoded: DataFrame, model, maps: dict | None = None, places: int = 2) -> DataFrame:
    """(student_id, predicted_exam_score, error, response) for decoded events."""
    encoded, cat_error, missing_error = encode_event_features(F.col("event.features"), maps)
    base = decoded.where(F.col("decode_error").isNull()).select(
        F.col("event.student_id").alias("student_id"),
        *[e.alias(c) for c, e in encoded.items()],
        F.coalesce(cat_error, missing_error).alias("error"))
    if isinstance(model, LinearModel):
        scored = base.withColumn("__raw", model.prediction_column())
    else:  # any model whose transform is a projection (MLlib pipelines)
        ok = base.where(F.col("error").isNull())
        bad = base.where(F.col("error").isNotNull()).withColumn("__raw", F.lit(None).cast("double"))
        scored = model.transform(ok, output="__raw").unionByName(bad, allowMissingColumns=True)
    out = scored.select(
        "student_id",
        F.when(F.col("error").isNull(), round_python(clip_score(F.col("__raw")), places)).alias("predicted_exam_score"),
        "error")
    return out.withColumn("response", F.to_json(F.struct(F.struct("student_id", "predicted_exam_score", "error")
                                                         .alias("prediction"))))


def dead_letters(decoded: DataFrame, data_col: str = "data") -> DataFrame:
    return decoded.where(F.col("decode_error").isNotNull()).select(F.col(data_col), "decode_error")


def encode_message(df: DataFrame, key: str = "student_id", features: list[str] | None = None) -> DataFrame:
    """Producer side: rows -> base64 of ``{"student_id", "features": {...}}`` (null fields omitted)."""
    features = features or FEATURE_COLUMNS
    payload = F.to_json(F.struct(F.col(key).alias("student_id"), F.struct(*features).alias("features")))
    return df.select(F.base64(F.encode(payload, "UTF-8")).alias("data"))


def start_message_stream(messages: DataFrame, sink, checkpoint: str, model, available_now: bool = True,
                         interval: str = "10 seconds"):
    """Score any stream of messages (a streaming DataFrame with a base64 ``data`` column).

    ``sink(responses, dead, epoch)`` gets each micro-batch's scored rows, its dead
    letters and its number; a repeated number is the same micro-batch again, so a
    sink that writes by it delivers once.
    """
    def each(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        sink(score_events(batch, model), dead_letters(batch), epoch)
        batch.unpersist()

    w = decode_messages(messages).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def parquet_sink(responses_dir: str, dead_dir: str):
    """Sink that keeps responses and dead letters as Parquet, a partition per micro-batch."""
    def write(responses: DataFrame, dead: DataFrame, epoch: int) -> None:
        for df, path in ((responses, responses_dir), (dead, dead_dir)):
            df.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path)

    return write


def kafka_sink(bootstrap_servers: str, topic: str):
    """Sink that sends the response JSON to a topic (needs the Kafka connector on the cluster)."""
    def write(responses: DataFrame, dead: DataFrame, epoch: int) -> None:
        (responses.select(F.col("student_id").cast("string").alias("key"), F.col("response").alias("value"))
         .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())

    return write


def start_scoring_stream(spark: SparkSession, source_dir: str, sink_dir: str, dead_dir: str, checkpoint: str,
                         model, available_now: bool = True, max_files_per_trigger: int | None = None):
    """File-source stream of envelope JSON lines -> scored responses (Parquet)
    and dead letters, written per micro-batch keyed by its id."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    messages = reader.json(source_dir).select(F.col("message.data").alias("data"))
    return start_message_stream(messages, parquet_sink(sink_dir, dead_dir), checkpoint, model, available_now)


def kafka_messages(spark: SparkSession, bootstrap_servers: str, topic: str,
                   starting_offsets: str = "latest") -> DataFrame:
    """Message source for ``start_message_stream`` on a cluster with the Kafka
    connector on its classpath: the record value is the base64 payload.
    (Not exercised in tests here: no connector jar and no broker.)"""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load()
            .select(F.col("value").cast("string").alias("data")))
