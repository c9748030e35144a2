"""File sources and sinks: raw CSV with NA tokens, code maps, scored batches,
latest-batch pick, metrics append.
"""

from __future__ import annotations


from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CATEGORY_MAPS, METRICS_SCHEMA, MSG_NO_BATCHES, NA_TOKENS, RAW_SCHEMA, SCORED_SCHEMA


def normalize_na(df: DataFrame, columns: list[str] | None = None, tokens: list[str] | None = None) -> DataFrame:
    """Map every NA token (pandas defaults) in text columns to null."""
    tokens = NA_TOKENS if tokens is None else tokens
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(*[F.when(~F.col(c).isin(tokens), F.col(c)).alias(c) if c in columns else F.col(c)
                       for c in df.columns])


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA,
                   tokens: list[str] | None = None) -> DataFrame:
    """Header CSV read as text, NA tokens -> null, then ``try_cast`` to the
    declared types (an unparsable number becomes null, never a failed job)."""
    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = (spark.read.schema(text_schema).option("header", True).option("mode", "PERMISSIVE")
           .option("nullValue", "\u0000").option("emptyValue", "").csv(path))
    raw = normalize_na(raw, tokens=tokens)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if not isinstance(f.dataType, T.StringType)
                        else F.col(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", na: str = "") -> None:
    (df.write.mode(mode).option("header", True).option("nullValue", na).option("emptyValue", '""')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


# ---------------------------------------------------------------------------
# Code maps
# ---------------------------------------------------------------------------


def category_maps_frame(spark: SparkSession, maps: dict | None = None) -> DataFrame:
    maps = maps or CATEGORY_MAPS
    rows = [(c, lvl, int(code), i) for c, m in maps.items() for i, (lvl, code) in enumerate(m.items())]
    return spark.createDataFrame(rows, "column string, level string, code int, position int")


def write_category_maps(spark: SparkSession, path: str, maps: dict | None = None) -> None:
    """Long form (column, level, code, position) as JSON lines."""
    category_maps_frame(spark, maps).coalesce(1).write.mode("overwrite").json(path)


def read_category_maps(spark: SparkSession, path: str) -> DataFrame:
    """Reads either the long JSON-lines form or one nested ``{column: {level: code}}`` document."""
    long_schema = "column string, level string, code int, position int"
    probe = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    nested = probe.where(~F.col("v").contains('"column"'))
    if nested.limit(1).count() == 0:
        return spark.read.schema(long_schema).json(path)
    m = nested.select(F.from_json("v", "map<string, map<string, int>>").alias("m"))
    outer = m.select(F.posexplode("m").alias("i", "column", "levels"))
    return outer.select("column", F.posexplode("levels").alias("position", "level", "code")).select(
        "column", "level", "code", F.col("position").cast("int"))


def maps_to_dict(map_df: DataFrame) -> dict:
    """Collect a (small, bounded) code-map table into the nested dictionary."""
    out: dict = {}
    for r in map_df.orderBy("column", "position").collect():
        out.setdefault(r["column"], {})[r["level"]] = int(r["code"])
    # keep the canonical column order when known
    ordered = {c: out[c] for c in CATEGORY_MAPS if c in out}
    ordered.update({c: m for c, m in out.items() if c not in ordered})
    return ordered


# ---------------------------------------------------------------------------
# Scored tables, batches, metrics
# ---------------------------------------------------------------------------


def write_predictions(df: DataFrame, root: str, run_id: str, fmt: str = "parquet") -> str:
    """One output per run: ``root/run_id=<id>/``; re-running a run replaces it."""
    out = df.withColumn("run_id", F.lit(run_id))
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
    if fmt == "csv":
        w.option("header", True).csv(root)
    else:
        w.parquet(root)
    return f"{root}/run_id={run_id}"


def write_reference_set(df: DataFrame, path: str) -> None:
    df.select(*[f.name for f in SCORED_SCHEMA.fields]).write.mode("overwrite").parquet(path)


def write_batch(df: DataFrame, root: str, batch_id: str) -> str:
    """Scored batch as ``root/<batch_id>.csv/``: a CSV folder named by the id, with a file per task."""
    path = f"{root.rstrip('/')}/{batch_id}.csv"
    write_csv(df.select(*[f.name for f in SCORED_SCHEMA.fields]), path)
    return path


def read_batch(spark: SparkSession, path: str, schema: T.StructType = SCORED_SCHEMA) -> DataFrame:
    """All rows of one batch: every file of its folder."""
    return spark.read.schema(schema).option("header", True).csv(path)


def batch_id_from_path(col) -> "F.Column":
    """``.../<id>.csv/part-...`` or ``.../<id>.csv`` -> ``<id>``."""
    return F.regexp_extract(col, r"([^/]+)\.csv(/[^/]*)?$", 1)


def latest_by(df: DataFrame, order_col: str) -> DataFrame:
    """Rows whose ``order_col`` equals its maximum (a scalar subquery)."""
    top = df.select(F.max(order_col)).scalar()
    return df.where(F.col(order_col) == top)


def batch_folder_from_path(col) -> "F.Column":
    """``.../<id>.csv/part-...`` or ``.../<id>.csv`` -> ``.../<id>.csv``."""
    return F.regexp_extract(col, r"^(.*?\.csv)(/[^/]*)?$", 1)


def latest_batch(spark: SparkSession, root: str) -> tuple[str, DataFrame]:
    """(batch_id, rows) of the most recently written batch; raises when there is none.

    The batch is chosen first, from file names and times alone (contents are not
    read); then all its files are read. Of batches with the same time the greatest
    id counts as newest.
    """
    try:
        names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "modificationTime")
    except AnalysisException as missing:
        raise FileNotFoundError(MSG_NO_BATCHES.format(root=root)) from missing
    batches = names.select(batch_folder_from_path(F.col("path")).alias("folder"), "modificationTime").where("folder <> ''")
    newest = batches.groupBy("folder").agg(F.max("modificationTime").alias("time")).orderBy(
        F.desc("time"), batch_id_from_path(F.col("folder")).desc()).first()
    if newest is None:
        raise FileNotFoundError(MSG_NO_BATCHES.format(root=root))
    folder = newest["folder"]
    return folder.rsplit("/", 1)[-1][: -len(".csv")], read_batch(spark, folder)


def append_metrics(row: DataFrame, path: str) -> None:
    """Append one row per batch; a replayed batch replaces its own partition."""
    cols = [f.name for f in METRICS_SCHEMA.fields]
    (row.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    # the schema keeps ids text: "00123456" or "1234e567" would be read as numbers
    return spark.read.schema(METRICS_SCHEMA).parquet(path).select(*[f.name for f in METRICS_SCHEMA.fields])
