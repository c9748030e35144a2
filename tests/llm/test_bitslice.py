"""Bit-sliced search against a plain scan."""

import math
import random

import numpy as np
import pytest
from conftest import SF_SMALL

from scorecast.llm import bitslice as B

SCHEMA = "vec_id long, embedding array<float>, label int, score int, block string"


def scan(rows, k=10):
    """All integer inner products, by the contract's order."""
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


def search(df, k=10):
    return sorted(tuple(r) for r in B.top_k(df, df["vec_id"] % 100 == 0, k).collect())


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert search(df) == scan(rows)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(B, "ROWS", 60)
    monkeypatch.setattr(B, "QUERIES", 2)
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    assert search(df, 7) == scan([(r["vec_id"], r["embedding"]) for r in df.collect()], 7)


def test_edges(spark):
    r = random.Random(3)
    vectors = [[r.choice([-2.0, -0.5, 0.0, 0.25, 0.25, 1.0]) for _ in range(4)] for _ in range(60)]  # many ties
    rows = [(i, v) for i, v in zip(range(0, 600, 10), vectors)]
    rows += [(601, None), (602, [1.0, None, 1.0, 1.0]), (603, [float("nan")] * 4), (604, [float("inf"), 0.0, 0.0, 0.0]), (700, [1.0, 2.0]), (701, [3.0, 1.0]),
             (None, [1.0] * 4), (800, []), (900, [1e6, -1e6, 1e6, 0.0]), (901, [1e6, -1e6, 1e6, 0.0]), (1000, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)
    assert search(df) == scan([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    assert search(df.limit(0)) == []


@pytest.mark.parametrize("seed", range(4))
def test_sums_and_selection(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(20, 400))
    values = r.integers(-3000, 3000, (n, 7)) * r.integers(0, 2, (1, 7))
    index = B.SlicedBlock(np.arange(n), values)
    q = r.integers(-500, 500, 7)
    ids, scores = index.top(0, q, 5)
    want = sorted((-int(s), i) for i, s in enumerate(values @ q) if i != 0)[:5]
    assert list(zip((-scores).tolist(), ids.tolist())) == want
    low, top = values.min(axis=0), (values - values.min(axis=0)) >> index.shift
    most = (1 << index.width) - 1
    exact = sum(abs(int(w)) * (np.where(w > 0, top[:, d], most[d] - top[:, d]) << int(index.shift[d])) for d, w in enumerate(q) if w)
    bits = index.quantised_sum(q)
    got = sum(np.unpackbits(b.view(np.uint8), bitorder="little")[:n].astype(np.int64) << i for i, b in enumerate(bits))
    assert (got == exact).all() and (low == values.min(axis=0)).all()
