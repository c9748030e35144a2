"""Profiling statistics: data quality, distributions, group effects, correlations.

Each statistic scans the table once for all columns (wide aggregates, or a
long form whose rows are pre-combined map-side) instead of one pass per
column. Quantiles are exact by default through ``running.exact_quantiles``;
``exact=False`` switches to bounded-memory ``percentile_approx``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_level
from ..schema import (HIST_BINS_FEATURE, KDE_GRID_POINTS, LEVEL_ORDER, TARGET_COLUMN, TUKEY_K)
from ..session import cut_lineage
from .running import quantiles


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def unpivot_numeric(df: DataFrame, columns: list[str], ids: list[str] | None = None,
                    name: str = "feature", value: str = "value") -> DataFrame:
    """Long form (ids..., feature, value DOUBLE) of the given numeric columns."""
    casted = df.select(*(ids or []), *[F.col(c).cast("double").alias(c) for c in columns])
    return casted.unpivot(ids or [], columns, name, value)


# ---------------------------------------------------------------------------
# A1 missing values, A6 duplicates, A24 shape
# ---------------------------------------------------------------------------


def missing_report(df: DataFrame) -> DataFrame:
    """(column_name, missing, percent) for columns with nulls, most missing first."""
    from ..functions.numeric import round_half_even

    cols = df.columns
    row = df.agg(F.expr("count(1) AS __n"), *[F.expr(f"count_if({_q(c)} IS NULL) AS m{i}") for i, c in enumerate(cols)])
    long = row.selectExpr("__n", "explode(array(" + ", ".join(
        f"named_struct('column_name', '{c}', 'missing', m{i}, 'pos', {i})" for i, c in enumerate(cols)) + ")) AS s"
    ).select("__n", "s.*")
    return (long.where(F.col("missing") > 0)
            .select("column_name", F.col("missing").cast("bigint").alias("missing"),
                    round_half_even(F.col("missing") / F.col("__n") * F.lit(100.0), 2).alias("percent"), "pos")
            .orderBy(F.col("missing").desc(), "pos").drop("pos"))


def assert_no_nulls(df: DataFrame) -> None:
    total = df.agg(sum(F.sum(F.col(c).isNull().cast("long")) for c in df.columns).alias("t")).first()["t"]
    if total:
        raise AssertionError(f"{total} missing values remain")


def duplicate_counts(df: DataFrame, key: str = "student_id") -> DataFrame:
    """Full-row duplicates and duplicate keys (rows beyond the first of each).

    Full rows are grouped first; those groups are then rolled up by key, so
    one plan answers both. ``groupBy`` treats nulls as equal, as pandas does.
    """
    full = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("c"))
    by_key = full.groupBy(key).agg(F.sum("c").alias("kc"), F.sum(F.col("c") - 1).alias("fd"))
    return by_key.agg(
        F.coalesce(F.sum("fd"), F.lit(0)).cast("bigint").alias("full_row_duplicates"),
        F.coalesce(F.sum(F.col("kc") - 1), F.lit(0)).cast("bigint").alias("duplicate_keys"),
    )


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, n_rows, n_columns)."""
    n = df.count()
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), n, len(df.columns)) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, n_rows bigint, n_columns int")


# ---------------------------------------------------------------------------
# A3 describe, A4/A5 Tukey fences, A22/A23 skew and target summary
# ---------------------------------------------------------------------------


def describe(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """count, mean, std (n-1), min, 25/50/75 %, max per column (long form)."""
    long = unpivot_numeric(df, columns)
    basic = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    q = quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75], exact=exact)
    qw = q.groupBy("feature").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q25"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("q50"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q75"),
    )
    return basic.join(qw, "feature", "left")


def tukey_outliers(df: DataFrame, columns: list[str], k: float = TUKEY_K, exact: bool = True) -> DataFrame:
    """Q1, Q3, fences and the count/percent of values outside them, per column.

    Pass 1 finds the quartiles; pass 2 counts for all columns at once against
    the fences (a one-row-per-column table, broadcast).
    """
    long = unpivot_numeric(df, columns)
    q = quantiles(long, ["feature"], "value", [0.25, 0.75], exact=exact)
    fences = q.groupBy("feature").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("Q1"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("Q3"),
    ).withColumn("iqr", F.col("Q3") - F.col("Q1"))
    fences = fences.withColumn("lower_fence", F.col("Q1") - F.lit(k) * F.col("iqr")).withColumn(
        "upper_fence", F.col("Q3") + F.lit(k) * F.col("iqr"))
    joined = long.join(F.broadcast(fences), "feature")
    out = ((F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))).cast("long")
    counts = joined.groupBy("feature", "Q1", "Q3", "lower_fence", "upper_fence").agg(
        F.sum(out).alias("n_outliers"), F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("pct", F.col("n_outliers") / F.col("n_rows") * F.lit(100.0))


def outlier_total(tukey: DataFrame) -> DataFrame:
    """Total outlying cells and their share of all numeric cells."""
    return tukey.agg(
        F.sum("n_outliers").cast("bigint").alias("total_outliers"),
        F.sum("n_rows").cast("bigint").alias("numeric_cells"),
        (F.sum("n_outliers") / F.sum("n_rows") * F.lit(100.0)).alias("pct_cells"),
    )


def adjusted_skew(col: str):
    """Bias-adjusted sample skewness G1 = g1 * sqrt(n(n-1)) / (n-2)."""
    n = F.count(col).cast("double")
    return F.when(n > 2, F.skewness(col) * F.sqrt(n * (n - 1)) / (n - 2))


def skew_table(df: DataFrame, columns: list[str]) -> DataFrame:
    long = unpivot_numeric(df, columns)
    return long.groupBy("feature").agg(adjusted_skew("value").alias("skew"), F.count("value").alias("n"))


def target_summary(df: DataFrame, target: str = TARGET_COLUMN, exact: bool = True) -> DataFrame:
    """mean, median, std, min, max and adjusted skew of the target (one row)."""
    base = df.agg(F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"), F.min(target).alias("min"),
                  F.max(target).alias("max"), adjusted_skew(target).alias("skew")).withColumn("feature", F.lit(target))
    long = df.select(F.lit(target).alias("feature"), F.col(target).cast("double").alias("value"))
    med = quantiles(long, ["feature"], "value", [0.5], exact=exact).select("feature", F.col("q").alias("median"))
    return base.join(med, "feature", "left")


# ---------------------------------------------------------------------------
# A7 group means, A8 ANOVA, A9 level counts, A12 box statistics
# ---------------------------------------------------------------------------


def unpivot_levels(df: DataFrame, columns: list[str], y: str = TARGET_COLUMN, clean: bool = False) -> DataFrame:
    """Long form (feature, level, y) of categorical columns."""
    items = [F.struct(F.lit(c).alias("feature"), (clean_level(c) if clean else F.col(c)).alias("level"))
             for c in columns]
    return df.select(F.explode(F.array(*items)).alias("s"), F.col(y).cast("double").alias("y")).select(
        "s.feature", "s.level", "y")


def group_means(df: DataFrame, columns: list[str], y: str = TARGET_COLUMN) -> DataFrame:
    long = unpivot_levels(df, columns, y).where(F.col("level").isNotNull())
    return long.groupBy("feature", "level").agg(F.avg("y").alias("mean_score"), F.count("y").alias("n"))


def anova_stats(df: DataFrame, columns: list[str], y: str = TARGET_COLUMN) -> DataFrame:
    """One-way ANOVA F per categorical column from per-level sufficient stats.

    y is centred on its global mean first, so SSB/SSW are differences of
    moderate numbers. Returns (feature, k, n, ssb, ssw, df_between, df_within, F).
    """
    m = df.agg(F.avg(y)).first()[0] or 0.0
    long = unpivot_levels(df, columns, y).where(F.col("level").isNotNull() & F.col("y").isNotNull())
    long = long.withColumn("yc", F.col("y") - F.lit(float(m)))
    g = long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("ng"), F.sum("yc").alias("sg"),
                                             F.sum(F.col("yc") * F.col("yc")).alias("qg"))
    t = g.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.sum("ng").alias("n"), F.sum("sg").alias("s"), F.sum("qg").alias("q"),
        F.sum(F.col("sg") * F.col("sg") / F.col("ng")).alias("sum_sg2_ng"),
    )
    ssb = F.col("sum_sg2_ng") - F.col("s") * F.col("s") / F.col("n")
    ssw = F.col("q") - F.col("sum_sg2_ng")
    t = t.select("feature", F.col("k").cast("bigint").alias("k"), F.col("n").cast("bigint").alias("n"),
                 ssb.alias("ssb"), ssw.alias("ssw"))
    dfb = (F.col("k") - 1).cast("double")
    dfw = (F.col("n") - F.col("k")).cast("double")
    f = F.when((dfb > 0) & (dfw > 0) & (F.col("ssw") > 0), (F.col("ssb") / dfb) / (F.col("ssw") / dfw))
    return t.withColumn("df_between", dfb).withColumn("df_within", dfw).withColumn("F", f)


def level_counts(df: DataFrame, columns: list[str], order: dict[str, list[str]] | None = None) -> DataFrame:
    """Counts of cleaned levels. Ordinal columns list their stated levels in
    order (absent ones count 0); nominal ones list observed levels by count.
    Returns (feature, level, n, position)."""
    order = LEVEL_ORDER if order is None else order
    spark = df.sparkSession
    long = unpivot_levels(df, columns, y=columns[0], clean=True).where(F.col("level").isNotNull())
    counts = long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
    ordered_rows = [(c, lvl, i) for c in columns if c in order for i, lvl in enumerate(order[c])]
    if ordered_rows:
        levels = spark.createDataFrame(ordered_rows, "feature string, level string, position int")
        ordinal = levels.join(counts, ["feature", "level"], "left").select(
            "feature", "level", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "position")
    else:
        ordinal = None
    from .running import running_sums

    # rank by (count desc, level) with distributed running counts: a feature
    # with millions of distinct levels never sorts in a single task
    nominal_cols = [c for c in columns if c not in order]
    ranked = running_sums(
        counts.where(F.col("feature").isin(nominal_cols)).withColumn("__neg", -F.col("n")).withColumn("__one", F.lit(1)),
        ["feature"], ["__neg", "level"], ["__one"])
    nominal = ranked.select("feature", "level", F.col("n").cast("bigint").alias("n"),
                            (F.col("cum___one") - 1).cast("int").alias("position"))
    return nominal if ordinal is None else ordinal.unionByName(nominal)


def box_stats(df: DataFrame, columns: list[str], y: str = TARGET_COLUMN, k: float = TUKEY_K,
              exact: bool = True) -> DataFrame:
    """Per (feature, level): quartiles, whiskers at the last datum inside the
    fences, and the number of points beyond them."""
    long = unpivot_levels(df, columns, y).where(F.col("level").isNotNull() & F.col("y").isNotNull())
    q = quantiles(long, ["feature", "level"], "y", [0.25, 0.5, 0.75], exact=exact)
    qs = q.groupBy("feature", "level").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"),
    )
    qs = qs.withColumn("lo_fence", F.col("q1") - F.lit(k) * (F.col("q3") - F.col("q1"))).withColumn(
        "hi_fence", F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1")))
    # one row per (feature, level), computed once; Spark broadcasts it when it is small
    joined = long.join(cut_lineage(qs), ["feature", "level"])
    inside = (F.col("y") >= F.col("lo_fence")) & (F.col("y") <= F.col("hi_fence"))
    return joined.groupBy("feature", "level", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("y"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("y"))).alias("whisker_hi"),
        F.sum((~inside).cast("long")).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"),
    )


# ---------------------------------------------------------------------------
# A10 histogram, A11 KDE
# ---------------------------------------------------------------------------


def histogram(df: DataFrame, columns: list[str], bins: int | dict[str, int] = HIST_BINS_FEATURE) -> DataFrame:
    """Equal-width bins from min to max (last bin closed); empty bins kept.

    Returns (feature, bin, lo, hi, n).
    """
    long = unpivot_numeric(df, columns).where(F.col("value").isNotNull())
    spark = df.sparkSession
    bin_rows = [(c, int(bins[c] if isinstance(bins, dict) else bins)) for c in columns]
    nb = spark.createDataFrame(bin_rows, "feature string, bins int")
    rng = long.groupBy("feature").agg(F.min("value").alias("vmin"), F.max("value").alias("vmax")).join(
        F.broadcast(nb), "feature")
    span = F.col("vmax") - F.col("vmin")
    idx = F.when(span > 0, F.least(F.floor((F.col("value") - F.col("vmin")) * F.col("bins") / span),
                                   F.col("bins") - 1)).otherwise(F.lit(0)).cast("int")
    counts = long.join(F.broadcast(rng), "feature").select("feature", idx.alias("bin")).groupBy(
        "feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select("feature", "vmin", "vmax", "bins",
                      F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    width = (F.col("vmax") - F.col("vmin")) / F.col("bins")
    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature", F.col("bin").cast("int").alias("bin"),
        (F.col("vmin") + F.col("bin") * width).alias("lo"),
        (F.col("vmin") + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


KDE_REACH = 9.0
KDE_CELL = 0.25  # of a bandwidth
KDE_MOMENTS = 12


def _hermite(order: int) -> list[list[int]]:
    """Coefficients (lowest power first) of the probabilists' Hermite polynomials He_0 .. He_{order - 1}."""
    out = [[1], [0, 1]]
    while len(out) < order:
        n = len(out) - 1
        shifted, earlier = [0, *out[-1]], [*out[-2], 0, 0]
        out.append([a - n * b for a, b in zip(shifted, earlier)])
    return out[:order]


def kde_curve(df: DataFrame, columns: list[str], points: int = KDE_GRID_POINTS) -> DataFrame:
    """Gaussian KDE (Scott bandwidth std * n^-1/5) on ``points`` grid points
    from min to max. Returns (feature, i, x, density).

    A fast Gauss transform: values fall into cells of ``KDE_CELL`` bandwidths and a
    cell keeps the sums of the first ``KDE_MOMENTS`` powers of s, the distance from its
    centre in bandwidths, all in the partial aggregate. At distance t from the centre
    the cell adds exp(-t^2/2) * sum_k He_k(t) * sum(s^k) / k!, to grid points within ``KDE_REACH``
    bandwidths. What is cut off is at most 1.09 * |s|^k / sqrt(k!) per value from k = 12 on, |s| <= 1/8:
    below 1e-15 of a kernel's peak. Cells number range / bandwidth * 4, which grows
    as n^1/5 and not with the distinct values.
    """
    long = unpivot_numeric(df, columns).where(F.col("value").isNotNull())
    stats = long.groupBy("feature").agg(
        F.min("value").alias("vmin"), F.max("value").alias("vmax"), F.count(F.lit(1)).alias("N"),
        F.stddev_samp("value").alias("sd"))
    step = (F.col("vmax") - F.col("vmin")) / F.lit(float(points - 1))
    # one row per feature; without spread there is no curve
    stats = cut_lineage(stats.withColumn("bw", F.col("sd") * F.pow(F.col("N").cast("double"), F.lit(-0.2))).withColumn("step", step).where("bw > 0 AND step > 0"))
    width = F.col("bw") * F.lit(KDE_CELL)
    placed = long.join(F.broadcast(stats), "feature").withColumn("cell", F.floor((F.col("value") - F.col("vmin")) / width))
    s = placed.select("feature", "cell", ((F.col("value") - F.col("vmin")) / F.col("bw") - (F.col("cell") + 0.5) * F.lit(KDE_CELL)).alias("s"))
    powers = [F.expr("double(count(1)) AS m0")] + [F.expr(f"sum({' * '.join(['s'] * k)}) AS m{k}") for k in range(1, KDE_MOMENTS)]
    cells = s.groupBy("feature", "cell").agg(*powers)
    near = cells.join(F.broadcast(stats), "feature").withColumn("centre", F.col("vmin") + (F.col("cell") + 0.5) * width)
    # beyond REACH bandwidths a kernel is below the rounding error of a double: cells add to near points only
    reach = F.lit(KDE_REACH + KDE_CELL) * F.col("bw")
    first = F.greatest(F.lit(0), F.ceil((F.col("centre") - reach - F.col("vmin")) / F.col("step")))
    last = F.least(F.lit(points - 1), F.floor((F.col("centre") + reach - F.col("vmin")) / F.col("step")))
    near = near.withColumns({"first": first, "last": last}).where("first <= last")
    t = (F.col("vmin") + F.col("i") * F.col("step") - F.col("centre")) / F.col("bw")
    at = near.withColumn("i", F.explode(F.sequence(F.col("first").cast("int"), F.col("last").cast("int")))).withColumn("t", t)
    terms = []
    for k, coefficients in enumerate(_hermite(KDE_MOMENTS)):
        horner = repr(float(coefficients[-1])) + "D"
        for c in reversed(coefficients[:-1]):
            horner = f"({horner} * t + {float(c)!r}D)"
        terms.append(f"{horner} * (m{k} / {float(math.factorial(k))!r}D)")
    dens = at.groupBy("feature", "i").agg(F.expr(f"sum(exp(-0.5D * t * t) * ({' + '.join(terms)})) AS s"))
    norm = F.col("N") * F.col("bw") * F.lit(math.sqrt(2.0 * math.pi))
    grid = stats.select("feature", "vmin", "step", "bw", "N", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    return grid.join(dens, ["feature", "i"], "left").select(
        "feature", F.col("i").cast("int").alias("i"), (F.col("vmin") + F.col("i") * F.col("step")).alias("x"),
        (F.coalesce("s", F.lit(0.0)) / norm).alias("density"))


# ---------------------------------------------------------------------------
# A18-A21 correlations and fits
# ---------------------------------------------------------------------------


def _stack_rows(row: DataFrame, fields: list[str]) -> DataFrame:
    """One-row wide aggregate -> long rows via ``explode(array(named_struct...))``."""
    return row.selectExpr(f"explode(array({', '.join(fields)})) AS s").select("s.*")


def pearson_target(df: DataFrame, columns: list[str], y: str = TARGET_COLUMN) -> DataFrame:
    """(feature, r, n) with pairwise-complete rows, one wide aggregate."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.expr(f"corr({_q(c)}, {_q(y)}) AS r{i}"),
                 F.expr(f"count_if({_q(c)} IS NOT NULL AND {_q(y)} IS NOT NULL) AS n{i}")]
    return _stack_rows(df.agg(*aggs), [f"named_struct('feature', '{c}', 'r', r{i}, 'n', n{i})"
                                       for i, c in enumerate(columns)])


def linear_fit(df: DataFrame, columns: list[str], y: str = TARGET_COLUMN) -> DataFrame:
    """Least-squares line y = slope * x + intercept per feature."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.expr(f"regr_slope({_q(y)}, {_q(c)}) AS s{i}"), F.expr(f"regr_intercept({_q(y)}, {_q(c)}) AS b{i}")]
    return _stack_rows(df.agg(*aggs), [f"named_struct('feature', '{c}', 'slope', s{i}, 'intercept', b{i})"
                                       for i, c in enumerate(columns)])


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Strict lower triangle (feature_a, feature_b, r).

    Long form: each row is inlined into one (pair, x, y) row per pair and a
    single ``corr`` is aggregated per pair (pairwise-complete, map-side
    partial). One small aggregate stays inside whole-stage codegen, where 55
    correlations side by side in one row would not.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    items = ", ".join(f"named_struct('feature_a', '{a}', 'feature_b', '{b}', 'x', CAST({_q(a)} AS DOUBLE), "
                      f"'y', CAST({_q(b)} AS DOUBLE))" for a, b in pairs)
    long = df.selectExpr(f"inline(array({items}))")
    return long.groupBy("feature_a", "feature_b").agg(F.corr("x", "y").alias("r"))


def corr_ranked(df: DataFrame, columns: list[str], y: str = TARGET_COLUMN, guide: float = 0.1) -> DataFrame:
    """Feature-target correlations ranked by |r| (rank 1 = strongest)."""
    from pyspark.sql import Window

    from ..functions.numeric import round_half_even

    pt = pearson_target(df, columns, y)
    r3 = round_half_even(F.col("r"), 3)
    w = Window.orderBy(F.abs(F.col("r")).desc(), "feature")  # one row per feature
    return pt.select(
        "feature", r3.alias("r"), F.abs(r3).alias("abs_r"),
        F.when(F.col("r") < 0, F.lit("negative")).otherwise(F.lit("positive")).alias("sign"),
        (F.abs(F.col("r")) >= F.lit(guide)).alias("above_guide"),
        F.row_number().over(w).cast("int").alias("rank"),
    )
