"""Helpers for the operators: scratch tables, bounded batches, sizing."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_workers_can_import
from ..session import scratch_table as scratch

__all__ = ["WORD", "blocks_for", "prepared", "scratch", "text_crc"]

WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of an Arrow batch where the session sets no bound: long texts must not meet in one batch by the thousand.
BATCH_BYTES = 8 << 20


def prepared(df: DataFrame) -> DataFrame:
    """``df`` in a session whose workers can run the operators' Python parts within bounded batches."""
    spark = df.sparkSession
    ensure_workers_can_import(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1))) >= 2**31 - 1:
        spark.conf.set(key, str(BATCH_BYTES))
    return df


def blocks_for(rows: int, per_block: int) -> int:
    """How many blocks hold ``rows`` at about ``per_block`` each; grows with the rows, no cap."""
    return max(1, math.ceil(rows / per_block))


def text_crc(col: str = "doc_id"):
    """crc32 of a column's text form, as the splits of the contracts use it."""
    return F.crc32(F.col(col).cast("string").cast("binary"))
