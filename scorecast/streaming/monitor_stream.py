"""Monitor each new scored batch file exactly once.

A file-source stream over the batch folder feeds ``foreachBatch``; each
micro-batch is split by the batch id taken from the file path (one
micro-batch may carry several files), every batch is compared with the
static reference set, and its metrics row replaces the ``batch_id``
partition of the metrics table, so a replay after failure is idempotent.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.monitor import monitoring_row, reference_profile
from ..schema import SCORED_SCHEMA
from ..sources.files import append_metrics, batch_folder_from_path, batch_id_from_path, read_batch


def monitor_micro_batch(batch: DataFrame, reference: DataFrame, metrics_path: str, method: str = "pvalue",
                        clock=None) -> list[str]:
    """One metrics row for every batch that has a file in this trigger.

    A batch may have several files, also in several triggers: its folder is read
    as a whole each time, and the append replaces the batch's own row.
    """
    found = batch.select(batch_id_from_path(F.col("file_path")).alias("batch_id"),
                         batch_folder_from_path(F.col("file_path")).alias("folder")).distinct()
    ids = []
    for bid, folder in sorted(tuple(r) for r in found.collect()):  # at most the files of one trigger
        ids.append(bid)
        current = read_batch(batch.sparkSession, folder)
        ts = (clock or (lambda: datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)))()
        append_metrics(monitoring_row(reference, current, bid, timestamp=ts, method=method), metrics_path)
    return ids


def start_monitor_stream(spark: SparkSession, batches_dir: str, reference: DataFrame, metrics_path: str,
                         checkpoint: str, method: str = "pvalue", available_now: bool = True,
                         max_files_per_trigger: int = 1000, clock=None):
    """Monitor every batch that arrives below ``batches_dir``; a trigger takes up to ``max_files_per_trigger`` files
    and measures each batch among them once."""
    # the reference set is static: its value counts are computed once, not in every micro-batch
    reference = reference_profile(reference)
    stream = (spark.readStream.schema(SCORED_SCHEMA).option("header", True)
              .option("maxFilesPerTrigger", max_files_per_trigger).option("recursiveFileLookup", True)
              .csv(batches_dir).select("*", F.col("_metadata.file_path").alias("file_path")))

    def sink(batch: DataFrame, epoch: int) -> None:
        monitor_micro_batch(batch, reference, metrics_path, method, clock)

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
