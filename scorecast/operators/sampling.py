"""Keyed hash splits, fold assignment, dense row index and exact-size bootstrap.

Every random choice is a hash of a stable key and a seed, so results do not
depend on partitioning, task retries or the number of executors.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import CV_FOLDS, KEY_COLUMN, MSG_INDEX_RANGE, SPLIT_SEED, TEST_PERCENT
from ..session import cut_lineage
from .running import below, constant_array

def hash_unit(key, salt: str, hex_digits: int = 8) -> Column:
    """Unsigned integer from the first ``hex_digits`` of md5(key || salt)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.concat(k.cast("string"), F.lit(salt))), 1, hex_digits), 16, 10).cast("bigint")


def split_column(key: str = KEY_COLUMN, seed: int = SPLIT_SEED, test_percent: int = TEST_PERCENT) -> Column:
    """True for the test side: ``md5(key:seed) mod 100 < test_percent``."""
    return (hash_unit(key, f":{seed}") % F.lit(100)) < F.lit(test_percent)


def train_test_split(df: DataFrame, key: str = KEY_COLUMN, seed: int = SPLIT_SEED,
                     test_percent: int = TEST_PERCENT) -> tuple[DataFrame, DataFrame]:
    flag = split_column(key, seed, test_percent)
    return df.where(~flag), df.where(flag)


def fold_column(key: str = KEY_COLUMN, seed: int = SPLIT_SEED, folds: int = CV_FOLDS) -> Column:
    """Shuffled k-fold id in ``0..folds-1`` from a second salt of the key hash."""
    return (hash_unit(key, f":fold:{seed}") % F.lit(folds)).cast("int")


def with_split_and_fold(df: DataFrame, key: str = KEY_COLUMN, seed: int = SPLIT_SEED,
                        test_percent: int = TEST_PERCENT, folds: int = CV_FOLDS) -> DataFrame:
    """Adds ``is_test`` and ``fold`` (null on test rows)."""
    is_test = split_column(key, seed, test_percent)
    return df.withColumn("is_test", is_test).withColumn(
        "fold", F.when(~F.col("is_test"), fold_column(key, seed, folds))
    )


def with_row_index(df: DataFrame, order_by: list[str] | str = KEY_COLUMN, name: str = "row_id",
                   partitions: int | None = None) -> DataFrame:
    """Dense 0-based position of each row in the order of ``order_by``.

    Range-partition by the key, number rows inside each partition, freeze the
    numbering with a reliable checkpoint, then add each partition's offset
    from a one-row-per-partition table (broadcast; its size is the partition
    count). No global single-task window.
    """
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    # A deterministic tie-break (hash of the whole row) lets the range
    # partitioner split a key value shared by many rows across partitions.
    base = df.withColumn("__tb", F.xxhash64(*[F.col(c) for c in df.columns]))
    keys = [*order_by, "__tb"]
    # without a number the partitions follow the session's setting and AQE's sizes
    tagged = (
        (base.repartitionByRange(partitions, *keys) if partitions else base.repartitionByRange(*keys))
        .sortWithinPartitions(*keys)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id())
        .drop("__tb")
    )
    tagged = cut_lineage(tagged)
    per_part = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__m0"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    out = tagged.join(offsets.select("__pid", "__off", "__m0"), "__pid")
    out = out.withColumn(name, (F.col("__off") + F.col("__mid") - F.col("__m0")).cast("bigint"))
    return out.drop("__pid", "__mid", "__off", "__m0")


#: Ranges of the key between sampled edges; a lookup sorts and writes only the ranges that hold wanted positions.
RANGES = 4096
RANGE_BITS = 13


def key_ranges(df: DataFrame, key: str, population: int) -> DataFrame:
    """One row ``edges``: every fourth of about 4 * RANGES sampled keys, ascending. They only set how even the ranges are."""
    sampled = df.select(F.col(key).alias("k")).where(F.rand(SPLIT_SEED) < F.lit(min(1.0, 4.0 * RANGES / max(population, 1))))
    # the sample's size does not grow with the table
    keys = sampled.agg(F.sort_array(F.collect_set("k")).alias("keys"))
    return cut_lineage(keys.select(F.filter("keys", lambda k, i: i % 4 == 3).alias("edges")))


def rows_at(df: DataFrame, wanted: DataFrame, key: str, population: int) -> DataFrame:
    """``df``'s columns and those of ``wanted``: the rows at the positions ``wanted.row_id`` in the order of ``key``.

    A sample of the key cuts it into ranges, one pass over the key column counts
    their rows, and only the ranges that hold a wanted position are read whole, sorted and numbered.
    """
    ranged = "__range"

    key_edges = constant_array(key_ranges(df, key, population))

    def located(rows: DataFrame) -> DataFrame:
        return rows.withColumn(ranged, below(F.col(key), key_edges, RANGE_BITS))

    counts = cut_lineage(located(df.select(key)).groupBy(ranged).agg(F.count(F.lit(1)).alias("__n")))
    # at most 2^RANGE_BITS rows from here on to ``hit``
    before = Window.orderBy(ranged).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    starts = cut_lineage(starts)
    upto = constant_array(starts.agg(F.sort_array(F.collect_list("__start")).alias("edges")))
    first = F.get(upto, below(F.col("row_id") + 1, upto, RANGE_BITS) - 1)
    hit = starts.join(wanted.select(first.alias("__start")).distinct(), "__start")
    hit = cut_lineage(hit.withColumn("__skipped", F.col("__start") - F.coalesce(F.sum("__n").over(before), F.lit(0))))
    near = located(df).join(F.broadcast(hit.select(ranged, "__skipped")), ranged)
    numbered = with_row_index(near, [ranged, key]).withColumn("row_id", F.col("row_id") + F.col("__skipped"))
    return numbered.join(wanted, "row_id").select(*df.columns, *wanted.columns)


def row_lookup(df: DataFrame, index: int, order_by: str = KEY_COLUMN) -> DataFrame:
    """The row at 0-based position ``index`` in key order; bounds are checked."""
    n = df.count()
    if index < 0 or index >= n:
        raise IndexError(MSG_INDEX_RANGE.format(last=n - 1))
    wanted = df.sparkSession.range(1).select(F.lit(index).cast("bigint").alias("row_id"))
    return rows_at(df, wanted, order_by, n)


def draw_positions(spark, n: int, population: int, seed: int) -> DataFrame:
    """``n`` draws (with replacement) of positions in ``0..population-1``."""
    return spark.range(n).select(
        F.col("id").alias("draw_id"),
        (hash_unit(F.col("id"), f":draw:{seed}", hex_digits=15) % F.lit(population)).alias("row_id"),
    )


def bootstrap_sample(df: DataFrame, n: int, seed: int | None = SPLIT_SEED, key: str = KEY_COLUMN) -> DataFrame:
    """Exactly ``n`` rows drawn uniformly with replacement (``draw_id`` 0..n-1).

    Positions are those of the rows in key order (rows that share a key are told
    apart by a hash of the whole row), so a repeated key neither multiplies nor
    hides rows. Only the key ranges that hold a drawn position are sorted (``rows_at``). ``seed=None`` draws a fresh seed once on the driver.
    """
    if seed is None:
        seed = random.SystemRandom().randrange(1 << 30)
    population = df.count()
    if population == 0:
        raise ValueError("cannot sample from an empty table")
    draws = draw_positions(df.sparkSession, n, population, seed)
    return rows_at(df, draws, key, population).select("draw_id", *df.columns)
