"""Cross products of many columns, tile by tile.

For p columns the narrow forms build p (p + 1) / 2 aggregate expressions or as many rows per
input row. Here a task multiplies its Arrow batches as matrices: a tile is the block of
``TILE`` by ``TILE`` columns, held with the number of rows, both sides' means and the
centred cross products, which merge exactly as means and variances do (one pass, no
centre known before). A task holds ``HELD`` tiles at most and sends what is beyond that batch by
batch; Spark adds the tiles up by their key, so nothing of p x p size meets in one task.

Rows with a null or NaN in any of the columns are left out, as a Gram matrix needs whole rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 64
HELD = 4096  # tiles: 128 MB
_SCHEMA = "i int, j int, n long, mean_i binary, mean_j binary, products binary"


def merged(a: tuple | None, b: tuple) -> tuple:
    """Two sets of rows' ``(n, mean_i, mean_j, products)`` as one."""
    if a is None:
        return b
    n = a[0] + b[0]
    di, dj = b[1] - a[1], b[2] - a[2]
    return n, a[1] + di * (b[0] / n), a[2] + dj * (b[0] / n), a[3] + b[3] + np.outer(di, dj) * (a[0] * b[0] / n)


def gram_tiles(df: DataFrame, columns: list[str], tile: int = TILE, held: int = HELD) -> DataFrame:
    """``i, j, n, mean_i, mean_j, products`` for every tile ``i >= j``; arrays are doubles as bytes, row-major."""
    starts = range(0, len(columns), tile)
    keys = [(i, j) for i in range(len(starts)) for j in range(i + 1)]

    def row(key, part):
        return (*key, part[0], part[1].tobytes(), part[2].tobytes(), part[3].tobytes())

    def multiplied(batches):
        sums: dict = {}
        names = _SCHEMA.replace(",", "").split()[::2]
        for pdf in batches:
            x = pdf.to_numpy(float)
            x = x[~np.isnan(x).any(axis=1)]
            if not len(x):
                continue
            mean = x.mean(axis=0)
            x = x - mean
            out = []
            for key in keys:
                a, b = (slice(k * tile, (k + 1) * tile) for k in key)
                part = (len(x), mean[a], mean[b], x[:, a].T @ x[:, b])
                if key in sums or len(sums) < held:
                    sums[key] = merged(sums.get(key), part)
                else:
                    out.append(row(key, part))
            if out:
                yield pd.DataFrame(out, columns=names)
        out = [row(k, s) for k, s in sums.items()]
        for a in range(0, len(out), 64):
            yield pd.DataFrame(out[a : a + 64], columns=names)

    def added(pdf):
        total = None
        for r in pdf.itertuples():
            mi, mj = np.frombuffer(r.mean_i), np.frombuffer(r.mean_j)
            total = merged(total, (r.n, mi, mj, np.frombuffer(r.products).reshape(len(mi), len(mj))))
        return pd.DataFrame([row((pdf["i"].iloc[0], pdf["j"].iloc[0]), total)], columns=_SCHEMA.replace(",", "").split()[::2])

    doubles = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    return doubles.mapInPandas(multiplied, _SCHEMA).groupBy("i", "j").applyInPandas(added, _SCHEMA)


def cross_products(df: DataFrame, columns: list[str], tile: int = TILE) -> DataFrame:
    """``a, b, n, s`` with ``a >= b``: positions of two columns, whole rows, and the centred sum of products."""

    def flat(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                rows, cols = len(r.mean_i) // 8, len(r.mean_j) // 8
                a, b = np.meshgrid(np.arange(rows) + r.i * tile, np.arange(cols) + r.j * tile, indexing="ij")
                keep = a >= b
                yield pd.DataFrame({"a": a[keep], "b": b[keep], "n": r.n, "s": np.frombuffer(r.products).reshape(rows, cols)[keep]})

    return gram_tiles(df, columns, tile).mapInPandas(flat, "a int, b int, n long, s double")


def corr_wide(df: DataFrame, columns: list[str], tile: int = TILE) -> DataFrame:
    """Strict lower triangle ``feature_a, feature_b, r``; null where a column is constant."""
    sums = cross_products(df, columns, tile)
    spread = sums.where("a = b").select(F.col("a").alias("k"), F.col("s").alias("v"))  # one row per column
    pairs = sums.where("a > b").join(F.broadcast(spread.withColumnsRenamed({"k": "a", "v": "va"})), "a").join(
        F.broadcast(spread.withColumnsRenamed({"k": "b", "v": "vb"})), "b")
    names = F.array(*[F.lit(c) for c in columns])
    r = F.when((F.col("va") > 0) & (F.col("vb") > 0), F.col("s") / F.sqrt(F.col("va") * F.col("vb")))
    return pairs.select(F.element_at(names, F.col("a") + 1).alias("feature_a"), F.element_at(names, F.col("b") + 1).alias("feature_b"), r.alias("r"))
