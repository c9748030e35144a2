"""Tiled cross products against numpy and the narrow form."""

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from conftest import SF_MID

from scorecast.operators.gram import corr_wide, cross_products, gram_tiles
from scorecast.operators.profile import corr_matrix

BASE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def wide(spark, columns):
    df = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    return df.selectExpr(*[f"CAST({BASE[k % 5]} AS DOUBLE) * (1 + pmod(l_orderkey * {k + 3}, {k % 17 + 2})) + 1000000 AS c{k}" for k in range(columns)])


def test_five_hundred_columns(spark):
    """More columns than tiles hold side by side; equal to numpy and, for some of them, to the narrow form."""
    names = [f"c{k}" for k in range(500)]
    df = wide(spark, 500)
    got = corr_wide(df, names).toPandas()
    assert len(got) == 500 * 499 // 2
    raw = pq.read_table(f"{SF_MID}/lineitem.parquet").to_pandas()
    x = np.stack([raw[BASE[k % 5]].to_numpy(float) * (1 + raw["l_orderkey"].to_numpy() * (k + 3) % (k % 17 + 2)) + 1e6 for k in range(500)], axis=1)
    with np.errstate(invalid="ignore"):
        want = np.corrcoef(x, rowvar=False)
    a, b = (got[c].str[1:].astype(int).to_numpy() for c in ("feature_a", "feature_b"))
    assert (a > b).all() and np.allclose(got["r"], want[a, b], atol=1e-9)
    narrow = {(r["feature_a"], r["feature_b"]): r["r"] for r in corr_matrix(df, names[:12]).collect()}
    mine = {(p, q): r for p, q, r in got.itertuples(index=False) if (p, q) in narrow}
    assert len(mine) == 66 and all(abs(mine[k] - narrow[k]) < 1e-9 for k in narrow)


@pytest.mark.parametrize("tile,held", [(2, 1), (3, 100), (64, 4096)])
def test_tiles_add_up_whatever_is_held(spark, tile, held):
    r = np.random.default_rng(1)
    x = r.normal(5e5, 1, (400, 7))
    x[:, 3] = 4.0  # constant
    x[r.integers(0, 400, 30), r.integers(0, 7, 30)] = np.nan
    names = list("abcdefg")
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).astype(object).where(~np.isnan(x), None), ", ".join(f"{c} double" for c in names)).repartition(5)
    whole = x[~np.isnan(x).any(axis=1)]
    d = whole - whole.mean(axis=0)
    tiles = gram_tiles(df, names, tile, held).collect()
    side = -(-7 // tile)
    assert len(tiles) == side * (side + 1) // 2 and {t["n"] for t in tiles} == {len(whole)}
    for t in tiles:
        a, b = slice(t["i"] * tile, (t["i"] + 1) * tile), slice(t["j"] * tile, (t["j"] + 1) * tile)
        assert np.allclose(np.frombuffer(t["products"]).reshape(d[:, a].shape[1], -1), d[:, a].T @ d[:, b], atol=1e-6)
    found = corr_wide(df, names, tile)
    assert found.where("r IS NULL").count() == 6  # the pairs of the constant


def test_no_rows(spark):
    assert cross_products(spark.createDataFrame([], "a double, b double"), ["a", "b"]).count() == 0
