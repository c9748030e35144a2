"""KS by brackets and the density by cell moments against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecast.operators import monitor
from scorecast.operators.profile import KDE_MOMENTS, _hermite, kde_curve
from scorecast.plans.q_monitor import LINEITEM_KS, lineitem_sides

from conftest import SF_MID


def plain_ks(a, b):
    a, b = np.sort(a), np.sort(b)
    at = np.concatenate([a, b])
    return np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)).max()


def test_bracketed_ks_is_exact(spark):
    rng = np.random.default_rng(3)
    columns = {
        "same": (rng.normal(size=40_000), rng.normal(size=40_000)),
        "apart": (rng.normal(size=40_000), 50 + rng.normal(size=40_000)),
        "hot": (np.where(rng.random(40_000) < 0.4, 1.0, rng.normal(size=40_000)), rng.normal(size=40_000)),
        "few": (rng.integers(0, 5, 40_000).astype(float), rng.integers(0, 6, 40_000).astype(float)),
    }
    names = list(columns)
    sides = [spark.createDataFrame([tuple(map(float, r)) for r in zip(*(columns[c][i] for c in names))], ", ".join(f"{c} double" for c in names)) for i in (0, 1)]
    got = {r["feature"]: r["d"] for r in monitor.ks_statistics(*sides, names).collect()}
    for c in names:
        assert got[c] == pytest.approx(plain_ks(*columns[c]), abs=1e-15)
    # a profile of the reference, one-row batches, other features only on one side
    profile = monitor.reference_profile(sides[0], names)
    one = spark.createDataFrame([(0.0, 0.0, 0.0, 2.0)], ", ".join(f"{c} double" for c in names))
    got = {r["feature"]: r["d"] for r in monitor.ks_statistics(profile, one, names).collect()}
    for c, v in zip(names, (0.0, 0.0, 0.0, 2.0)):
        assert got[c] == pytest.approx(plain_ks(columns[c][0], np.array([v])), abs=1e-15)
    empty = {r["feature"]: r for r in monitor.ks_statistics(profile, one.limit(0), names).collect()}
    assert set(empty) == set(names) and all(r["d"] is None and r["n_cur"] == 0 for r in empty.values())


def test_few_values_are_ordered(spark):
    sides = lineitem_sides(spark, SF_MID)
    found = monitor.ks_brackets(*sides, LINEITEM_KS)
    ordered = found.undecided_values().count()
    both = sides[0].select(*LINEITEM_KS).unionByName(sides[1].select(*LINEITEM_KS))
    distinct = sum(both.agg(*[F.count_distinct(c) for c in LINEITEM_KS]).first())
    assert ordered < 0.02 * distinct


def test_density_equals_the_plain_sum(spark):
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(size=3_000), rng.normal(30, 0.01, 200), [55.0]])
    df = spark.createDataFrame([(float(x), 1.0) for x in v] + [(None, 1.0)], "a double, flat double")
    rows = sorted((r["i"], r["x"], r["density"]) for r in kde_curve(df, ["a", "flat"], 200).collect())
    x = np.linspace(v.min(), v.max(), 200)
    h = v.std(ddof=1) * len(v) ** -0.2
    want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert [r[0] for r in rows] == list(range(200))
    assert np.allclose([r[1] for r in rows], x, atol=1e-12)
    # the stated bound, and rounding
    assert np.abs(np.array([r[2] for r in rows]) - want).max() < 1e-14 / h


def test_hermite_polynomials():
    t = np.linspace(-3, 3, 7)
    for k, c in enumerate(_hermite(KDE_MOMENTS)):
        assert np.allclose(np.polynomial.polynomial.polyval(t, c), np.polynomial.hermite_e.hermeval(t, [0] * k + [1]))


def test_density_shuffles_cells_not_values(spark):
    df = spark.range(20_000).select((F.col("id") / 7.0).alias("a"))
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        kde_curve(df, ["a"]).explain("formatted")
    grouped = [line for line in out.getvalue().splitlines() if "hashpartitioning" in line]
    assert grouped and not any("value#" in line for line in grouped)
