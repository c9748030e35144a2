"""Distributed running sums / exact quantiles / dense row index vs numpy,
with one group holding most of the rows (skew)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecast.operators.running import below, exact_quantiles, running_sums
from scorecast.operators.sampling import bootstrap_sample, with_row_index
from scorecast.session import cut_lineage


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    g = np.where(rng.random(20000) < 0.6, "hot", rng.choice(["a", "b", "c"], 20000))
    v = np.round(rng.normal(50, 10, 20000), 1)
    rows = [(str(a), float(b)) for a, b in zip(g, v)]
    return spark.createDataFrame(rows, "g string, v double").repartition(7), g, v


def test_running_sums_match_cumsum(spark, skewed):
    df, g, v = skewed
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    out = running_sums(counts, ["g"], ["v"], ["n"], partitions=16).toPandas()
    for grp, part in out.groupby("g"):
        part = part.sort_values("v")
        vals = np.sort(v[g == grp])
        expect = np.searchsorted(vals, part["v"].to_numpy(), side="right")
        np.testing.assert_array_equal(part["cum_n"].to_numpy(), expect)


def test_exact_quantiles_match_numpy(spark, skewed):
    df, g, v = skewed
    q = exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75, 0.9], partitions=12).toPandas()
    for _, r in q.iterrows():
        assert r["q"] == pytest.approx(np.quantile(v[g == r["g"]], r["p"]), abs=1e-9)


def test_row_index_dense_in_key_order(spark):
    df = spark.range(5000).select(F.format_string("k%05d", (F.col("id") * 7919) % 5000).alias("k"))
    out = with_row_index(df, "k", partitions=9).toPandas().sort_values("row_id")
    assert out["row_id"].tolist() == list(range(5000))
    assert out["k"].tolist() == sorted(out["k"].tolist())


def test_bootstrap_exact_size_and_stable(spark):
    df = spark.range(1000).select(F.format_string("s%d", "id").alias("student_id"), F.col("id").alias("x"))
    a = bootstrap_sample(df, 137, seed=3).orderBy("draw_id").collect()
    b = bootstrap_sample(df.repartition(5), 137, seed=3).orderBy("draw_id").collect()
    assert len(a) == 137
    assert [r["student_id"] for r in a] == [r["student_id"] for r in b]
    assert len({r["student_id"] for r in a}) < 137  # with replacement: some repeats expected


def test_row_index_splits_a_hot_key(spark):
    # one order-key value holds half the rows: numbering stays dense and the
    # range partitioning (key, row hash) spreads that value over partitions
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(
        F.format_string("k%05d", "id")).alias("k"), F.col("id"))
    pdf = with_row_index(df, "k", partitions=8).toPandas().sort_values("row_id")
    assert pdf["row_id"].tolist() == list(range(4000))
    ranged = (df.withColumn("__tb", F.xxhash64("k", "id")).repartitionByRange(8, "k", "__tb")
              .where(F.col("k") == "hot").select(F.spark_partition_id().alias("p")).distinct().count())
    assert ranged > 1


def test_row_lookup_bounds(spark):
    from scorecast.operators.sampling import row_lookup

    df = spark.range(10).select(F.format_string("s%02d", "id").alias("student_id"))
    assert row_lookup(df, 2).first()["student_id"] == "s02"
    with pytest.raises(IndexError, match="sample_index must be between 0 and 9"):
        row_lookup(df, 10)
    with pytest.raises(IndexError):
        row_lookup(df, -1)


def test_assert_no_nulls_after_imputation(spark):
    from scorecast.operators.prepare import Preparer, impute
    from scorecast.operators.profile import assert_no_nulls

    df = spark.createDataFrame([("a", "x"), ("b", None), ("c", "x")], "student_id string, parental_education_level string")
    with pytest.raises(AssertionError):
        assert_no_nulls(df)
    assert_no_nulls(impute(df, Preparer().fit(df).fills))


def test_below_counts_smaller_edges(spark):
    edges = [1.0, 1.0, 2.5, 7.0]
    df = spark.createDataFrame([(v,) for v in (None, 0.0, 1.0, 1.5, 2.5, 6.9, 7.0, 7.1, 1e9)], "v double")
    got = df.select(below(F.col("v"), F.array(*map(F.lit, edges)), 4)).toPandas().iloc[:, 0].tolist()
    assert got == [0, 0, 0, 2, 2, 3, 3, 4, 4]
    assert df.select(below(F.col("v"), F.array().cast("array<double>"), 4).alias("b")).distinct().collect() == [(0,)]


def test_positions_sort_only_the_ranges_that_are_hit(spark, monkeypatch):
    from scorecast.operators import sampling

    n = 60_000
    # a third of the rows share one key; some keys are null
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("k5")).when(F.col("id") % 1000 == 1, F.lit(None))
                               .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), "id")
    keys = sorted((r["k"] is not None, r["k"] or "") for r in df.collect())
    written = []
    monkeypatch.setattr(sampling, "cut_lineage", lambda x: written.append(cut_lineage(x)) or written[-1])
    wanted = [0, 1, 55, 20_100, 59_000, 59_999]
    rows = sampling.rows_at(df, spark.createDataFrame([(w,) for w in wanted + [1]], "row_id long"), "k", n).collect()
    assert sorted(r["row_id"] for r in rows) == sorted(wanted + [1])
    assert all((r["k"] is not None, r["k"] or "") == keys[r["row_id"]] for r in rows)
    assert len({r["id"] for r in rows}) == len(wanted)
    # edges, counts, hit ranges and the numbered rows of six ranges of about n / 4096
    assert written[-1].count() < 0.02 * n and all(x.count() < 5_000 for x in written)
    # a position in the hot key costs that key's rows, and no others
    written.clear()
    hot = sampling.rows_at(df, spark.createDataFrame([(45_000,)], "row_id long"), "k", n).collect()
    assert [(r["k"] is not None, r["k"] or "") for r in hot] == [keys[45_000]]
