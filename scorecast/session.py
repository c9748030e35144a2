"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Broadcast only what is known small; larger sides sort-merge / shuffle-hash.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "scorecast",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins; a private folder is created
    only when the session has none (local tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that the driver "
                               "and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="scorecast-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "scorecast", f"{name}-{uuid.uuid4().hex[:12]}")


_WRITTEN: list[tuple[SparkSession, str]] = []


def scratch_table(df: DataFrame, name: str, by: str | None = None, options: dict | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared scratch folder and read it back; ``by`` has a folder per value, ``options`` go to the writer.

    Cuts the lineage with files every executor can reach (a lost executor loses
    nothing), stays column-prunable and gives the planner a known size. The files
    go with ``purge_scratch()`` or when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**(options or {})).parquet(path, partitionBy=by)
    _WRITTEN.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path).select(*df.columns) if by else spark.read.parquet(path)
    out._scratch_path = path
    return out


def discard_scratch(df: DataFrame) -> None:
    """Delete the scratch table that ``df`` was read from; nothing may read it any more."""
    path = getattr(df, "_scratch_path", None)
    for entry in [e for e in _WRITTEN if e[1] == path]:
        _WRITTEN.remove(entry)
        _delete(*entry)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing holds any more: it does so once the JVM has collected them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def purge_scratch() -> None:
    """Delete the scratch tables written so far; results that still read them must be done."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            _delete(spark, path)
        except Exception:  # the session has ended: the shared folder's owner clears it
            return


atexit.register(purge_scratch)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` materialised in the shared folder (survives executor loss)."""
    return scratch_table(df, "cut")


_SHIPPED: set = set()


def ensure_workers_can_import(spark: SparkSession) -> None:
    """Make ``scorecast`` importable by the Python workers of this context.

    Clusters normally get the package via ``--py-files``; when a quick probe
    shows the workers cannot import it (e.g. the driver put the repo on
    ``sys.path`` by hand), the package is zipped once and added with
    ``addPyFile``, which Spark distributes to every executor.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return

    def probe(_):
        import importlib.util

        return [importlib.util.find_spec("scorecast") is not None]

    ok = all(sc.parallelize([0], 1).mapPartitions(probe).collect())
    if not ok:
        import zipfile

        pkg = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="scorecast-pyfiles-"), "scorecast.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
            for root, _, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
        sc.addPyFile(target)
    _SHIPPED.add(key)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
