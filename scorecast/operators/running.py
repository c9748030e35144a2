"""Distributed running sums and exact quantiles without a single-task window.

A window ``partitionBy(g).orderBy(v)`` puts every row of a group into one
task; with few groups (8 features) and many distinct values that is the
bottleneck. Instead: range-partition by (group, order), freeze the partition
id with a reliable checkpoint, run the window inside each (partition, group),
and add the totals of all earlier partitions from a small offsets table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

def constant_array(edges: DataFrame) -> Column:
    """The array column ``edges`` of a one-row table as a constant, so that rows do not carry it along.

    For arrays of bounded size. It passes the driver as JSON; what a bracket's
    edges lose on the way (a timestamp's last digits, say) moves the bracket, not a result.
    """
    kind = edges.schema["edges"].dataType.simpleString()
    text = edges.select(F.to_json(F.struct("edges"))).first()[0]
    return F.from_json(F.lit(text), f"edges {kind}")["edges"]


def below(value: Column, edges: Column, bits: int) -> Column:
    """How many of the ascending ``edges`` (an array of at most 2^bits - 1) are smaller than ``value``; 0 for null."""
    steps = F.array(*[F.lit(1 << b) for b in range(bits - 1, -1, -1)])
    # past the end get() is null, and the step is not taken
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(edges, at + step - 1) < value, at + step).otherwise(at))


def running_sums(df: DataFrame, group_cols: list[str], order_cols: list[str], sum_cols: list[str],
                 prefix: str = "cum_", partitions: int | None = None) -> DataFrame:
    """Add ``cum_<c>``: inclusive running sum of ``c`` within the group, in order.

    Rows that tie on (group, order) are summed in an arbitrary but fixed
    order, so callers pass distinct keys (e.g. value counts).
    """
    keys = [*group_cols, *order_cols]
    # without a number the partitions follow the session's setting and AQE's sizes
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged = ranged.withColumn("__pid", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    w_local = (Window.partitionBy("__pid", *group_cols).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(c).over(w_local).alias(f"__loc_{c}") for c in sum_cols])
    totals = ranged.groupBy("__pid", *group_cols).agg(*[F.sum(c).alias(f"__tot_{c}") for c in sum_cols])
    w_off = Window.partitionBy(*group_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__pid", *group_cols,
        *[F.coalesce(F.sum(f"__tot_{c}").over(w_off), F.lit(0)).alias(f"__off_{c}") for c in sum_cols],
    )
    joined = local.join(offsets, ["__pid", *group_cols])
    keep = [c for c in df.columns]
    return joined.select(
        *keep, *[(F.col(f"__off_{c}") + F.col(f"__loc_{c}")).alias(f"{prefix}{c}") for c in sum_cols]
    )


def value_counts(df: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    """(group..., value, n): non-null values counted with map-side combine."""
    return (df.where(F.col(value_col).isNotNull())
            .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("n")))


# Accuracy of the sketch that brackets exact quantiles; a bracket holds about 5 / SKETCH of the rows.
SKETCH = 10_000


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str, probs: list[float],
                    partitions: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles per group (numpy/pandas 'linear').

    Returns (group..., p, q). Two passes and no full sort: a sketch brackets
    every quantile, then one aggregate counts the rows between brackets and the
    distinct values inside them, and only the latter are put in order. Should a
    bracket miss its ranks (the sketch's error bound says it does not), all
    values are ordered instead.
    """
    rows = df.where(F.col(value_col).isNotNull()).select(*group_cols, F.col(value_col).cast("double").alias("__v"))
    edges = [e for p in probs for e in (max(0.0, p - 2.5 / SKETCH), min(1.0, p + 2.5 / SKETCH))]
    sketch = cut_lineage(rows.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("__N"), F.percentile_approx("__v", edges, SKETCH).alias("__e")))
    lows, highs = [F.col("__e")[2 * i] for i in range(len(probs))], [F.col("__e")[2 * i + 1] for i in range(len(probs))]

    inside = F.lit(False)
    zone = F.lit(0)
    for lo, hi in zip(lows, highs):
        inside = inside | F.col("__v").between(lo, hi)
        zone = zone + (F.col("__v") > lo).cast("int") + (F.col("__v") > hi).cast("int")
    # rows of one zone outside all brackets lie on the same side of every edge: one of them stands for all
    counted = cut_lineage(
        rows.join(sketch, group_cols).select(*group_cols, "__v", zone.alias("__zone"), F.when(inside, F.col("__v")).alias("__in"))
        .groupBy(*group_cols, "__zone", "__in").agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("__v")))
    brackets = F.array(*[F.struct(F.lit(float(p)).alias("p"), lo.alias("lo"), hi.alias("hi")) for p, lo, hi in zip(probs, lows, highs)])
    targets = sketch.select(*group_cols, "__N", F.explode(brackets).alias("b")).select(*group_cols, "__N", "b.*")
    targets = targets.withColumn("__h", (F.col("__N") - 1).cast("double") * F.col("p"))
    targets = targets.withColumn("__lo", F.floor("__h")).withColumn("__hi", F.ceil("__h"))
    each = counted.join(targets, group_cols)
    spans = each.groupBy(*group_cols, "p", "__h", "__lo", "__hi").agg(
        F.sum(F.when(F.col("__v") < F.col("lo"), F.col("n")).otherwise(0)).alias("__below"),
        F.sum(F.when(F.col("__v").between(F.col("lo"), F.col("hi")), F.col("n")).otherwise(0)).alias("__within"))
    spans = cut_lineage(spans)
    missed = (F.col("__below") > F.col("__lo")) | (F.col("__below") + F.col("__within") <= F.col("__hi"))
    if spans.where(missed).head(1):
        return _ordered_quantiles(df, group_cols, value_col, probs, partitions)
    near = each.where(F.col("__v").between(F.col("lo"), F.col("hi"))).select(*group_cols, "p", F.col("__v").alias("v"), "n")
    cum = running_sums(near, [*group_cols, "p"], ["v"], ["n"], partitions=partitions)
    cum = cum.join(spans, [*group_cols, "p"]).withColumn("cum_n", F.col("cum_n") + F.col("__below"))
    return _interpolated(cum.withColumn("__before", F.col("cum_n") - F.col("n")), group_cols, "v")


def _ordered_quantiles(df: DataFrame, group_cols: list[str], value_col: str, probs: list[float],
                       partitions: int | None = None) -> DataFrame:
    """The same from running sums over all distinct values."""
    counts = cut_lineage(value_counts(df, group_cols, value_col))
    cum = running_sums(counts, group_cols, [value_col], ["n"], partitions=partitions)
    cum = cum.withColumn("__before", F.col("cum_n") - F.col("n"))
    totals = counts.groupBy(*group_cols).agg(F.sum("n").alias("__N"))
    targets = totals.select(
        *group_cols, F.col("__N"), F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p")
    ).withColumn("__h", (F.col("__N") - 1).cast("double") * F.col("p"))
    targets = targets.withColumn("__lo", F.floor("__h")).withColumn("__hi", F.ceil("__h"))
    return _interpolated(cum.join(targets, group_cols), group_cols, value_col)


def _interpolated(cum: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    """(group..., p, q) from values with their running counts and the wanted positions."""
    hits = cum.where(
        ((F.col("__before") <= F.col("__lo")) & (F.col("__lo") < F.col("cum_n")))
        | ((F.col("__before") <= F.col("__hi")) & (F.col("__hi") < F.col("cum_n")))
    )
    v = F.col(value_col).cast("double")
    agg = hits.groupBy(*group_cols, "p", "__h", "__lo").agg(
        F.max(F.when((F.col("__before") <= F.col("__lo")) & (F.col("__lo") < F.col("cum_n")), v)).alias("__vlo"),
        F.max(F.when((F.col("__before") <= F.col("__hi")) & (F.col("__hi") < F.col("cum_n")), v)).alias("__vhi"),
    )
    # numpy's 'linear' lerp: a + (b-a)t below t = 0.5, b - (b-a)(1-t) from there
    t = F.col("__h") - F.col("__lo")
    diff = F.col("__vhi") - F.col("__vlo")
    q = F.when(t >= 0.5, F.col("__vhi") - diff * (F.lit(1.0) - t)).otherwise(F.col("__vlo") + diff * t)
    return agg.select(*group_cols, "p", q.alias("q"))


def approx_quantiles(df: DataFrame, group_cols: list[str], value_col: str, probs: list[float],
                     accuracy: int = 10000) -> DataFrame:
    """Bounded-memory alternative: rank error at most N / accuracy."""
    g = df.where(F.col(value_col).isNotNull()).groupBy(*group_cols).agg(
        F.percentile_approx(F.col(value_col).cast("double"), [float(p) for p in probs], accuracy).alias("__qs")
    )
    return g.select(*group_cols, F.posexplode("__qs").alias("__i", "q")).select(
        *group_cols, F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("__i") + 1).alias("p"), "q"
    )


def quantiles(df: DataFrame, group_cols: list[str], value_col: str, probs: list[float], exact: bool = True,
              partitions: int | None = None) -> DataFrame:
    if exact:
        return exact_quantiles(df, group_cols, value_col, probs, partitions=partitions)
    return approx_quantiles(df, group_cols, value_col, probs)
