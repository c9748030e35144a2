"""The monitoring cycle as one job: reference set -> new scored batch under a
fresh short id -> pick the most recent batch -> metrics row -> append.

Every step goes through storage (Parquet reference, CSV batch folders,
partitioned metrics table), like the three separate scripts it replaces, so
the steps can also run on different schedules or from a stream.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round_half_even, shift_clip
from ..operators.monitor import monitoring_row, reference_profile
from ..operators.prepare import Preparer
from ..operators.sampling import bootstrap_sample
from ..operators.score import predict
from ..schema import DRIFT_SCENARIO, KEY_COLUMN, MONITOR_FEATURES, MONITOR_SAMPLE_SIZE, TARGET_COLUMN
from ..sources.files import append_metrics, latest_batch, read_metrics, write_batch, write_reference_set


def new_batch_id() -> str:
    """Short random id, drawn once on the driver."""
    return str(uuid.uuid4())[:8]


def utc_now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)


def scored_frame(raw: DataFrame, model, preparer: Preparer, key: str = KEY_COLUMN) -> DataFrame:
    """Raw numeric features, target and the 2-place prediction (unclipped).

    Numeric features pass through preparation unchanged, so the encoded frame
    already carries the raw values the reference set keeps. ``key`` must be
    unique per row for models that join back on it (a bootstrap batch uses
    ``draw_id``).
    """
    enc = preparer.transform(raw, keep=[key])
    scored = predict(model, enc, output="__p")
    return scored.select(*MONITOR_FEATURES, TARGET_COLUMN, round_half_even(F.col("__p"), 2).alias("prediction"))


def prepare_reference(raw: DataFrame, model, preparer: Preparer, path: str) -> DataFrame:
    write_reference_set(scored_frame(raw, model, preparer), path)
    return raw.sparkSession.read.parquet(path)


def generate_batch(raw: DataFrame, model, preparer: Preparer, root: str, n: int = MONITOR_SAMPLE_SIZE,
                   seed: int | None = None, drift: bool = True, batch_id: str | None = None) -> str:
    """n rows with replacement (unseeded by default), optional what-if shift, scored and written."""
    b = bootstrap_sample(raw, n, seed)
    if drift:
        b = b.select(*[shift_clip(c, *DRIFT_SCENARIO[c]).alias(c) if c in DRIFT_SCENARIO else F.col(c)
                       for c in b.columns])
    batch_id = batch_id or new_batch_id()
    write_batch(scored_frame(b, model, preparer, key="draw_id"), root, batch_id)
    return batch_id


def calculate_metrics(spark: SparkSession, reference_path: str, batches_root: str, metrics_path: str,
                      method: str = "pvalue", now: datetime.datetime | None = None) -> str:
    """Evaluate the most recently written batch and append its metrics row."""
    batch_id, current = latest_batch(spark, batches_root)
    ref = reference_profile(spark.read.parquet(reference_path))
    append_metrics(monitoring_row(ref, current, batch_id, timestamp=now or utc_now(), method=method), metrics_path)
    return batch_id


def run_monitoring(spark: SparkSession, raw: DataFrame, model, preparer: Preparer, root: str,
                   seed: int | None = None, method: str = "pvalue") -> DataFrame:
    """One full cycle under ``root``; returns the metrics table."""
    prepare_reference(raw, model, preparer, f"{root}/reference")
    generate_batch(raw, model, preparer, f"{root}/current_batches", seed=seed)
    calculate_metrics(spark, f"{root}/reference", f"{root}/current_batches", f"{root}/metrics", method)
    return read_metrics(spark, f"{root}/metrics")
