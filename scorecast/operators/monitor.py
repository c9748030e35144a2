"""Batch monitoring: two-sample KS drift per feature, quality and prediction
distribution, composed into one metrics row per batch.

KS orders few values. Quantile sketches of both sides cut every feature's range
into brackets; the rows per bracket (counted in Arrow batches, one row per task and bracket) give both empirical CDFs exactly at the
brackets' ends, so the largest gap there is a lower bound of D, and inside a bracket
the gap cannot pass what the CDFs at its two ends allow. Only brackets whose
upper bound exceeds the best lower bound have their values counted and put in
order (``running.running_sums``); D is exact. If D is itself as small as one
bracket's share (equal distributions), most brackets stay undecided and most values
are ordered, still distributed.
"""

from __future__ import annotations

import datetime
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import ks_p_udf
from ..schema import DRIFT_P_THRESHOLD, MONITOR_FEATURES, PREDICTION_COLUMN, TARGET_COLUMN
from .metrics import prediction_stat_columns, regression_metric_columns
from ..session import cut_lineage
from .running import running_sums


def _long(df: DataFrame, features: list[str]) -> DataFrame:
    items = [F.struct(F.lit(i).alias("pos"), F.lit(c).alias("feature"), F.col(c).alias("value")) for i, c in enumerate(features)]
    return df.select(F.explode(F.array(*items)).alias("s")).select("s.*")


#: Quantiles sketched per side; both sides' edges are one bracket list of a feature (16 KB at most).
EDGES = 1024


@dataclass
class ReferenceProfile:
    """One side's KS inputs: its features' columns (a scratch table) and per feature the totals and the edges of its quantile sketch."""

    narrow: DataFrame     # one double column per feature
    totals: DataFrame     # pos, feature, n_ref, null_ref, edges
    features: list

    def brackets(self, edges: dict[str, np.ndarray]) -> DataFrame:
        """(feature, bracket, n, lo, hi): one row per task and bracket that has values."""
        features = self.features

        def counted(batches):
            sizes = {c: len(edges[c]) + 1 for c in features}
            n = {c: np.zeros(s, dtype=np.int64) for c, s in sizes.items()}
            lo, hi = ({c: np.full(s, at) for c, s in sizes.items()} for at in (np.inf, -np.inf))
            for pdf in batches:
                for c in features:
                    v = _values(pdf[c])
                    at = np.searchsorted(edges[c], v)
                    n[c] += np.bincount(at, minlength=sizes[c])
                    np.minimum.at(lo[c], at, v)
                    np.maximum.at(hi[c], at, v)
            for c in features:
                at = np.flatnonzero(n[c])
                yield pd.DataFrame({"feature": c, "bracket": at, "n": n[c][at], "lo": lo[c][at], "hi": hi[c][at]})

        return self.narrow.mapInPandas(counted, "feature string, bracket long, n long, lo double, hi double")

    def values(self, edges: dict[str, np.ndarray], wanted: dict[str, np.ndarray]) -> DataFrame:
        """(feature, bracket, value, n): the values of the ``wanted`` brackets, counted per batch."""

        def counted(batches):
            chosen = {c: np.isin(np.arange(len(edges[c]) + 1), w) for c, w in wanted.items()}
            for pdf in batches:
                for c in wanted:
                    v = _values(pdf[c])
                    v, n = np.unique(v[chosen[c][np.searchsorted(edges[c], v)]], return_counts=True)
                    yield pd.DataFrame({"feature": c, "bracket": np.searchsorted(edges[c], v), "value": v, "n": n})

        return self.narrow.select(*wanted).mapInPandas(counted, "feature string, bracket long, value double, n long")


def _values(column: pd.Series) -> np.ndarray:
    v = column.to_numpy(dtype=np.float64)
    return v[~np.isnan(v)]


def side_columns(df: DataFrame, features: list[str]) -> DataFrame:
    """The columns of one side that the test reads."""
    # NaN is a missing value, as in pandas
    return df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in features])


def reference_profile(reference: DataFrame, features: list[str] | None = None) -> ReferenceProfile:
    features = list(features or MONITOR_FEATURES)
    narrow = cut_lineage(side_columns(reference, features))
    known = F.count("value")
    probs = ", ".join(f"{i / (EDGES - 1)!r}D" for i in range(EDGES))
    totals = _long(narrow, features).groupBy("pos", "feature").agg(
        known.alias("n_ref"), (F.count(F.lit(1)) - known).alias("null_ref"),
        F.expr(f"percentile_approx(value, array({probs}), {4 * EDGES}) AS edges"))
    return ReferenceProfile(narrow, cut_lineage(totals), features)


def _sides(ref: DataFrame, cur: DataFrame, keys: list[str], *more) -> DataFrame:
    """Both sides' counts ``n`` as ``nr`` and ``nc``, added up by ``keys``."""
    none = F.lit(0).cast("long")
    both = ref.withColumns({"nr": F.col("n"), "nc": none}).unionByName(cur.withColumns({"nr": none, "nc": F.col("n")}))
    return both.groupBy(*keys).agg(F.sum("nr").alias("nr"), F.sum("nc").alias("nc"), *more)


@dataclass
class KsBrackets:
    """The brackets of two sides. ``bounds``: (feature, bracket, nr, nc, before_r, before_c, gap, undecided), where ``gap``
    is exact at the bracket's end and ``undecided`` says that a larger one than all of these may lie inside."""

    ref: ReferenceProfile
    cur: ReferenceProfile
    totals: DataFrame     # pos, feature, n_ref, n_cur, null_ref, null_cur
    edges: dict
    bounds: DataFrame

    def undecided_values(self) -> DataFrame:
        """(feature, bracket, value, nr, nc): the counted values of the undecided brackets, all that has to be ordered."""
        wanted: dict[str, list] = {}
        # at most 2 * EDGES + 1 numbers per feature
        for feature, bracket in self.bounds.where("undecided").select("feature", "bracket").collect():
            wanted.setdefault(feature, []).append(bracket)
        wanted = {c: np.array(b) for c, b in wanted.items()}
        return _sides(self.ref.values(self.edges, wanted), self.cur.values(self.edges, wanted), ["feature", "bracket", "value"])


def ks_brackets(reference, current: DataFrame, features: list[str] | None = None) -> KsBrackets:
    features = list(features or (reference.features if isinstance(reference, ReferenceProfile) else MONITOR_FEATURES))
    ref = reference if isinstance(reference, ReferenceProfile) else reference_profile(reference, features)
    cur = reference_profile(current, features)
    ref_edges, cur_edges = ({r["feature"]: r["edges"] or [] for r in side.totals.collect()} for side in (ref, cur))  # one row per feature
    edges = {c: np.unique(np.array([*ref_edges.get(c, []), *cur_edges.get(c, [])], dtype=np.float64)) for c in features}
    cur_tot = cur.totals.select("feature", F.col("pos").alias("cur_pos"), F.col("n_ref").alias("n_cur"), F.col("null_ref").alias("null_cur"))
    totals = ref.totals.join(cur_tot, "feature", "full").select(
        F.coalesce("pos", "cur_pos").alias("pos"), "feature",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_ref", "n_cur", "null_ref", "null_cur")])
    counted = _sides(ref.brackets(edges), cur.brackets(edges), ["feature", "bracket"], (F.min("lo") < F.max("hi")).alias("several"))

    # at most 2 * EDGES + 1 rows per feature
    upto = Window.partitionBy("feature").orderBy("bracket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counted.withColumns({"cr": F.sum("nr").over(upto), "cc": F.sum("nc").over(upto)}).join(
        F.broadcast(totals.select("feature", "n_ref", "n_cur")), "feature")
    before_r, before_c = F.col("cr") - F.col("nr"), F.col("cc") - F.col("nc")

    def gap(r, c):
        # an all-null side has no distribution: its gap is null, so D and p are null and nothing is flagged
        return F.try_divide(r, F.col("n_ref")) - F.try_divide(c, F.col("n_cur"))

    bounds = summed.select(
        "feature", "bracket", "nr", "nc", "several", before_r.alias("before_r"), before_c.alias("before_c"),
        F.abs(gap(F.col("cr"), F.col("cc"))).alias("gap"),
        F.greatest(gap(F.col("cr"), before_c), -gap(before_r, F.col("cc"))).alias("most"))
    bounds = bounds.withColumn("undecided", F.col("several") & (F.col("most") > F.max("gap").over(Window.partitionBy("feature"))))
    return KsBrackets(ref, cur, totals, edges, cut_lineage(bounds.drop("several", "most")))


def ks_statistics(reference, current: DataFrame, features: list[str] | None = None,
                  partitions: int | None = None) -> DataFrame:
    """(pos, feature, d, n_ref, n_cur, null_ref, null_cur) per feature.

    ``reference`` is a DataFrame of reference rows or a ``ReferenceProfile``.
    """
    found = ks_brackets(reference, current, features)
    bounds, totals = found.bounds, found.totals
    gaps = bounds.select("feature", "gap")
    if bounds.where("undecided").head(1):
        cum = running_sums(cut_lineage(found.undecided_values()), ["feature", "bracket"], ["value"], ["nr", "nc"], partitions=partitions)
        # at most 2 * EDGES + 1 rows per feature, and one
        cum = cum.join(F.broadcast(bounds.where("undecided").select("feature", "bracket", "before_r", "before_c")), ["feature", "bracket"]).join(
            F.broadcast(totals.select("feature", "n_ref", "n_cur")), "feature")
        inside = F.abs(F.try_divide(F.col("before_r") + F.col("cum_nr"), "n_ref") - F.try_divide(F.col("before_c") + F.col("cum_nc"), "n_cur"))
        gaps = gaps.unionByName(cum.select("feature", inside.alias("gap")))
    d = gaps.groupBy("feature").agg(F.max("gap").alias("d"))
    return totals.join(d, "feature", "left").select("pos", "feature", "d", "n_ref", "n_cur", "null_ref", "null_cur")


def ks_critical_d(alpha: float = DRIFT_P_THRESHOLD):
    """Asymptotic critical value c(alpha) * sqrt((n+m)/(n m)) as a column."""
    c = math.sqrt(-math.log(alpha / 2.0) / 2.0)
    n, m = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    return F.lit(c) * F.sqrt(F.try_divide(n + m, n * m))


def ks_drift(reference: DataFrame, current: DataFrame, features: list[str] | None = None,
             method: str = "pvalue", alpha: float = DRIFT_P_THRESHOLD) -> DataFrame:
    """KS per feature with the drift decision.

    ``method="pvalue"``: the public ``ks_2samp`` rule (``functions.stats.ks_p_value``),
    drift when p < alpha (strict). ``method="critical"``: drift when D exceeds the
    asymptotic critical value. Features with missing values get no p and
    are not flagged (a warning says why).
    """
    ks = ks_statistics(reference, current, features)
    has_nulls = (F.col("null_ref") + F.col("null_cur")) > 0
    if method == "pvalue":
        p = F.when(~has_nulls, ks_p_udf(F.col("d"), F.col("n_ref"), F.col("n_cur")))
        ks = ks.withColumn("p_value", p).withColumn("drifted", F.coalesce(F.col("p_value") < F.lit(alpha), F.lit(False)))
    elif method == "critical":
        ks = ks.withColumn("d_critical", ks_critical_d(alpha)).withColumn(
            "drifted", F.coalesce(~has_nulls & (F.col("d") > F.col("d_critical")), F.lit(False)))
    else:
        raise ValueError(method)
    return ks.withColumn("warning", F.when(has_nulls, F.lit("missing values: test skipped")))


def drift_summary(ks: DataFrame, n_features: int | None = None) -> DataFrame:
    """One row: count, share and the ordered comma list (null when none)."""
    n_features = n_features or len(MONITOR_FEATURES)
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("drifted"), F.struct("pos", "feature")))),
                                     lambda x: x["feature"]), ", ")
    return ks.agg(
        F.sum(F.col("drifted").cast("int")).cast("int").alias("num_drifted_features"),
        (F.sum(F.col("drifted").cast("int")) / F.lit(float(n_features))).alias("share_drifted_features"),
        F.nullif(names, F.lit("")).alias("drifted_feature_names"),
    )


def batch_quality(current: DataFrame, y: str = TARGET_COLUMN, p: str = PREDICTION_COLUMN) -> DataFrame:
    """batch_size, RMSE/MAE/R2 and prediction mean/std/min/max in one pass."""
    return current.agg(F.count(F.lit(1)).cast("int").alias("batch_size"),
                       *regression_metric_columns(y, p), *prediction_stat_columns(p))


def monitoring_row(reference: DataFrame, current: DataFrame, batch_id: str,
                   timestamp: datetime.datetime | None = None, features: list[str] | None = None,
                   method: str = "pvalue") -> DataFrame:
    """The 13-column metrics row for one batch (timestamp naive UTC)."""
    features = features or MONITOR_FEATURES
    ts = timestamp or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    drift = drift_summary(ks_drift(reference, current, features, method=method), len(features))
    quality = batch_quality(current)
    row = drift.withColumn("__k", F.lit(1)).join(F.broadcast(quality.withColumn("__k", F.lit(1))), "__k")
    return row.select(
        F.lit(ts).cast("timestamp_ntz").alias("timestamp"), F.lit(batch_id).alias("batch_id"), "batch_size",
        "num_drifted_features", "share_drifted_features", "drifted_feature_names",
        "rmse", "mae", "r2", "pred_mean", "pred_std", "pred_min", "pred_max",
    )
