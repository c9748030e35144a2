"""Linear models as coefficient tables, fitted from one distributed Gram pass.

The heavy work is a single ``groupBy(fold).agg(...)`` of sufficient
statistics (n, sums, cross-products) over all training rows, centred on the
global means for numeric safety. Everything after that - standardisation,
ridge and lasso solutions for every penalty and fold, validation SSE - runs
on the (p+1)x(p+1) matrices, whose size does not grow with the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...schema import FEATURE_COLUMNS, TARGET_COLUMN


@dataclass
class LinearModel:
    """prediction = intercept + sum(coef_j * x_j) in original units."""

    features: list[str]
    coef: list[float]
    intercept: float
    name: str = "linear"
    params: dict = field(default_factory=dict)
    # Standardisation learned at fit time (for reporting scaled coefficients).
    mean: list[float] | None = None
    scale: list[float] | None = None

    def prediction_column(self) -> Column:
        expr = F.lit(float(self.intercept))
        for c, b in zip(self.features, self.coef):
            expr = expr + F.lit(float(b)) * F.col(c)
        return expr

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, self.prediction_column())

    def predict_numpy(self, X: np.ndarray) -> np.ndarray:
        return self.intercept + X @ np.asarray(self.coef)

    def coef_scaled(self) -> list[float] | None:
        if self.scale is None:
            return None
        return [b * s for b, s in zip(self.coef, self.scale)]

    def to_dict(self) -> dict:
        return {"kind": "linear", "name": self.name, "features": self.features, "coef": list(map(float, self.coef)),
                "intercept": float(self.intercept), "params": self.params,
                "mean": self.mean, "scale": self.scale}

    @staticmethod
    def from_dict(d: dict) -> "LinearModel":
        return LinearModel(features=d["features"], coef=d["coef"], intercept=d["intercept"], name=d.get("name", "linear"),
                           params=d.get("params", {}), mean=d.get("mean"), scale=d.get("scale"))


# ---------------------------------------------------------------------------
# Sufficient statistics
# ---------------------------------------------------------------------------


@dataclass
class GramStats:
    """Per-group sums of centred features/target: n, Sx, Sy, Sxx, Sxy, Syy."""

    features: list[str]
    center_x: np.ndarray
    center_y: float
    groups: dict  # key -> dict(n, sx, sy, sxx, sxy, syy)

    def total(self, exclude=None) -> dict:
        keys = [k for k in self.groups if exclude is None or k != exclude]
        acc = None
        for k in keys:
            g = self.groups[k]
            if acc is None:
                acc = {kk: (np.array(v, dtype=float) if isinstance(v, np.ndarray) else float(v)) for kk, v in g.items()}
            else:
                for kk in acc:
                    acc[kk] = acc[kk] + g[kk]
        return acc


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def gram_columns(features: list[str], target: str, center_x: list[float], center_y: float) -> list[Column]:
    """Aggregate expressions for the centred Gram sums (upper triangle).

    Built as SQL text: one JVM call per aggregate instead of one per operator.
    """
    xs = [f"(CAST({_q(c)} AS DOUBLE) - {float(m)!r}D)" for c, m in zip(features, center_x)]
    y = f"(CAST({_q(target)} AS DOUBLE) - {float(center_y)!r}D)"
    exprs = ["count(1) AS n", f"sum({y}) AS sy", f"sum({y} * {y}) AS syy"]
    for i, xi in enumerate(xs):
        exprs.append(f"sum({xi}) AS sx_{i}")
        exprs.append(f"sum({xi} * {y}) AS sxy_{i}")
        for j in range(i, len(xs)):
            exprs.append(f"sum({xi} * {xs[j]}) AS sxx_{i}_{j}")
    return [F.expr(e) for e in exprs]


def gram_frame(df: DataFrame, columns: list[str], group_col: str | None = None, exact: bool = False) -> DataFrame:
    """Long form (group, i, j, feature_a, feature_b, n, sum) of uncentred
    cross-product sums over complete rows, i <= j, one aggregate pass.

    ``exact=True`` sums each double product as DECIMAL(38,10): the total is
    then independent of summation order, i.e. identical for any partitioning,
    retry or engine (at the cost of decimal arithmetic).
    """
    complete = df.where(" AND ".join(f"{_q(c)} IS NOT NULL" for c in columns))
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]

    def prod(i, j):
        e = f"CAST({_q(columns[i])} AS DOUBLE) * CAST({_q(columns[j])} AS DOUBLE)"
        return f"CAST({e} AS DECIMAL(38, 10))" if exact else e

    aggs = [F.expr("count(1) AS n")] + [F.expr(f"sum({prod(i, j)}) AS s_{i}_{j}") for i, j in pairs]
    wide = complete.groupBy(*([group_col] if group_col else [])).agg(*aggs)
    items = ", ".join(f"named_struct('i', {i}, 'j', {j}, 'feature_a', '{columns[i]}', 'feature_b', '{columns[j]}', "
                      f"'sum', s_{i}_{j})" for i, j in pairs)
    return wide.selectExpr(*([group_col] if group_col else []), "CAST(n AS BIGINT) AS n",
                           f"explode(array({items})) AS s").select(
        *([group_col] if group_col else []), "s.i", "s.j", "s.feature_a", "s.feature_b", "n", "s.sum")


def feature_means(df: DataFrame, features: list[str], target: str) -> tuple[np.ndarray, float]:
    row = df.agg(*[F.expr(f"avg({_q(c)}) AS m{i}") for i, c in enumerate(features)],
                 F.expr(f"avg({_q(target)}) AS my")).first()
    mx = np.array([row[f"m{i}"] or 0.0 for i in range(len(features))], dtype=float)
    return mx, float(row["my"] or 0.0)


def gram_stats(df: DataFrame, features: list[str] | None = None, target: str = TARGET_COLUMN,
               group_col: str | None = None) -> GramStats:
    """Two cheap passes: global means, then centred sums per group.

    Rows with any null feature or target are excluded (they are error rows
    upstream). The group column (e.g. ``fold``) gives one small row per
    group; partial aggregation happens map-side, so the shuffle carries
    ``#partitions x #groups`` rows regardless of data size.
    """
    features = features or FEATURE_COLUMNS
    complete = df.where(" AND ".join(f"{_q(c)} IS NOT NULL" for c in [target, *features]))
    mx, my = feature_means(complete, features, target)
    cols = gram_columns(features, target, list(mx), my)
    if group_col:
        rows = complete.groupBy(group_col).agg(*cols).collect()
    else:
        rows = complete.agg(*cols).collect()
    p = len(features)
    groups = {}
    for r in rows:
        if r["n"] == 0:
            continue
        sxx = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                sxx[i, j] = sxx[j, i] = r[f"sxx_{i}_{j}"]
        groups[r[group_col] if group_col else None] = {
            "n": float(r["n"]),
            "sx": np.array([r[f"sx_{i}"] for i in range(p)], dtype=float),
            "sy": float(r["sy"]),
            "sxx": sxx,
            "sxy": np.array([r[f"sxy_{i}"] for i in range(p)], dtype=float),
            "syy": float(r["syy"]),
        }
    return GramStats(features=list(features), center_x=mx, center_y=my, groups=groups)


def _standardised_system(s: dict):
    """Centred cross-products about the group's own mean, and the scaler."""
    n = s["n"]
    mu = s["sx"] / n  # offset of group mean from the global centre
    muy = s["sy"] / n
    cxx = s["sxx"] - n * np.outer(mu, mu)
    cxy = s["sxy"] - n * mu * muy
    var = np.clip(np.diag(cxx) / n, 0.0, None)
    scale = np.sqrt(var)
    scale = np.where(scale > 0, scale, 1.0)  # constant column -> scale 1 (contributes 0)
    zz = cxx / np.outer(scale, scale)
    zy = cxy / scale
    return n, mu, muy, zz, zy, scale


def _to_original(w: np.ndarray, mu: np.ndarray, muy: float, scale: np.ndarray, stats: GramStats):
    beta = w / scale
    mean_x = stats.center_x + mu
    mean_y = stats.center_y + muy
    intercept = mean_y - float(mean_x @ beta)
    return beta, intercept, mean_x


def ridge_from_stats(s: dict, alpha: float, stats: GramStats) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Ridge on standardised features with an unpenalised intercept."""
    n, mu, muy, zz, zy, scale = _standardised_system(s)
    p = len(zy)
    w = np.linalg.solve(zz + alpha * np.eye(p), zy)
    beta, intercept, mean_x = _to_original(w, mu, muy, scale, stats)
    return beta, intercept, mean_x, scale


def lasso_from_stats(s: dict, alpha: float, stats: GramStats, max_iter: int = 10000,
                     tol: float = 1e-12) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Coordinate descent for (1/2n)||y - Zw||^2 + alpha*||w||_1 on the Gram form."""
    n, mu, muy, zz, zy, scale = _standardised_system(s)
    p = len(zy)
    w = np.zeros(p)
    diag = np.diag(zz).copy()
    thresh = alpha * n
    for _ in range(max_iter):
        max_delta = 0.0
        for j in range(p):
            if diag[j] <= 0:
                continue
            rho = zy[j] - zz[j] @ w + diag[j] * w[j]
            new = np.sign(rho) * max(abs(rho) - thresh, 0.0) / diag[j]
            delta = abs(new - w[j])
            if delta > max_delta:
                max_delta = delta
            w[j] = new
        if max_delta <= tol * max(1.0, np.max(np.abs(w))):
            break
    beta, intercept, mean_x = _to_original(w, mu, muy, scale, stats)
    return beta, intercept, mean_x, scale


def sse_from_stats(s: dict, beta: np.ndarray, intercept: float, stats: GramStats) -> float:
    """Sum of squared errors of a linear model over the rows summarised in ``s``.

    With residual r = (y' - x'beta) - c, where x', y' are centred on the
    global means and c = intercept + centre_x.beta - centre_y.
    """
    c = intercept + float(stats.center_x @ beta) - stats.center_y
    q = s["syy"] - 2.0 * float(beta @ s["sxy"]) + float(beta @ s["sxx"] @ beta)
    lin = s["sy"] - float(beta @ s["sx"])
    return max(q - 2.0 * c * lin + s["n"] * c * c, 0.0)


def fit_ridge(df: DataFrame, alpha: float, features: list[str] | None = None, target: str = TARGET_COLUMN) -> LinearModel:
    stats = gram_stats(df, features, target)
    beta, b0, mean_x, scale = ridge_from_stats(stats.total(), alpha, stats)
    return LinearModel(stats.features, list(beta), float(b0), name="RidgeRegression", params={"alpha": alpha},
                       mean=list(mean_x), scale=list(scale))


def fit_lasso(df: DataFrame, alpha: float, features: list[str] | None = None, target: str = TARGET_COLUMN,
              max_iter: int = 10000) -> LinearModel:
    stats = gram_stats(df, features, target)
    beta, b0, mean_x, scale = lasso_from_stats(stats.total(), alpha, stats, max_iter=max_iter)
    return LinearModel(stats.features, list(beta), float(b0), name="Lasso", params={"alpha": alpha},
                       mean=list(mean_x), scale=list(scale))


def standardize(df: DataFrame, columns: list[str], suffix: str = "") -> DataFrame:
    """(x - mean) / population std, constant column -> 0; stats from one agg, applied as literals."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    out = df
    for c in columns:
        m = row[f"m_{c}"]
        s = row[f"s_{c}"]
        s = s if s and s > 0 else 1.0
        out = out.withColumn(c + suffix, (F.col(c) - F.lit(float(m if m is not None else 0.0))) / F.lit(float(s)))
    return out
