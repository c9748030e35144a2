"""Gram-route ridge/lasso against direct numpy solutions on the same rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecast.operators.models.linear import gram_stats, lasso_from_stats, ridge_from_stats, sse_from_stats
from scorecast.operators.models.search import linear_cv
from scorecast.plans.train import prepare_split
from scorecast.schema import FEATURE_COLUMNS, TARGET_COLUMN
from scorecast.sources.standin import habits

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def train_rows(spark):
    _, data = prepare_split(habits(spark, SF_SMALL))
    tr = data.where("__complete").where(~F.col("is_test"))
    pdf = tr.select("fold", *FEATURE_COLUMNS, TARGET_COLUMN).toPandas()
    return tr, pdf


def _std(X):
    m = X.mean(0)
    s = X.std(0)
    s = np.where(s > 0, s, 1.0)
    return m, s


def _ridge_np(X, y, alpha):
    m, s = _std(X)
    Z = (X - m) / s
    yc = y - y.mean()
    w = np.linalg.solve(Z.T @ Z + alpha * np.eye(X.shape[1]), Z.T @ yc)
    beta = w / s
    return beta, y.mean() - m @ beta


def _lasso_np(X, y, alpha, iters=20000):
    m, s = _std(X)
    Z = (X - m) / s
    yc = y - y.mean()
    n, p = Z.shape
    w = np.zeros(p)
    r = yc.copy()
    for _ in range(iters):
        old = w.copy()
        for j in range(p):
            r += Z[:, j] * w[j]
            rho = Z[:, j] @ r
            w[j] = np.sign(rho) * max(abs(rho) - alpha * n, 0) / (Z[:, j] @ Z[:, j])
            r -= Z[:, j] * w[j]
        if np.max(np.abs(w - old)) < 1e-13:
            break
    beta = w / s
    return beta, y.mean() - m @ beta


@pytest.mark.parametrize("alpha", [0.1, 10.0])
def test_ridge_matches_closed_form(spark, train_rows, alpha):
    tr, pdf = train_rows
    stats = gram_stats(tr, FEATURE_COLUMNS, TARGET_COLUMN)
    beta, b0, _, _ = ridge_from_stats(stats.total(), alpha, stats)
    eb, eb0 = _ridge_np(pdf[FEATURE_COLUMNS].to_numpy(float), pdf[TARGET_COLUMN].to_numpy(float), alpha)
    np.testing.assert_allclose(beta, eb, rtol=1e-8, atol=1e-9)
    assert b0 == pytest.approx(eb0, rel=1e-9)


@pytest.mark.parametrize("alpha", [0.01, 0.1])
def test_lasso_matches_coordinate_descent(spark, train_rows, alpha):
    tr, pdf = train_rows
    stats = gram_stats(tr, FEATURE_COLUMNS, TARGET_COLUMN)
    beta, b0, _, _ = lasso_from_stats(stats.total(), alpha, stats)
    eb, eb0 = _lasso_np(pdf[FEATURE_COLUMNS].to_numpy(float), pdf[TARGET_COLUMN].to_numpy(float), alpha)
    np.testing.assert_allclose(beta, eb, rtol=1e-6, atol=1e-7)
    assert b0 == pytest.approx(eb0, rel=1e-7)


def test_fold_cv_equals_direct_refits(spark, train_rows):
    tr, pdf = train_rows
    stats = gram_stats(tr, FEATURE_COLUMNS, TARGET_COLUMN, group_col="fold")
    res = linear_cv(stats, "ridge", [1.0])[0]
    X = pdf[FEATURE_COLUMNS].to_numpy(float)
    y = pdf[TARGET_COLUMN].to_numpy(float)
    folds = pdf["fold"].to_numpy()
    rmses = []
    for f in range(5):
        beta, b0 = _ridge_np(X[folds != f], y[folds != f], 1.0)
        e = y[folds == f] - (b0 + X[folds == f] @ beta)
        rmses.append(np.sqrt(np.mean(e ** 2)))
        assert sse_from_stats(stats.groups[f], beta, b0, stats) == pytest.approx(np.sum(e ** 2), rel=1e-9)
    np.testing.assert_allclose(res.fold_rmse, rmses, rtol=1e-8)
    assert res.cv_rmse == pytest.approx(np.mean(rmses), rel=1e-8)


def test_feature_weights_by_model_kind(spark, train_rows):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    from scorecast.operators.models.linear import LinearModel
    from scorecast.operators.models.weights import feature_weights
    from scorecast.plans.train import EnsembleModel, TreeModel

    tr, _ = train_rows
    lm = LinearModel(FEATURE_COLUMNS, [float(i) for i in range(14)], 0.0, scale=[2.0] * 14)
    w = feature_weights(spark, lm).collect()
    assert w[0]["feature"] == FEATURE_COLUMNS[-1] and w[0]["coef_scaled"] == 26.0
    pm = Pipeline(stages=[VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features"),
                          RandomForestRegressor(labelCol=TARGET_COLUMN, numTrees=5, maxDepth=3, seed=1)]).fit(tr)
    imp = feature_weights(spark, TreeModel(pm, "RandomForest", {})).collect()
    assert len(imp) == 14 and abs(sum(r["importance"] for r in imp) - 1.0) < 1e-9
    assert imp[0]["feature"] == "study_hours_per_day"
    with pytest.raises(TypeError):
        feature_weights(spark, EnsembleModel([lm]))
