r"""Exact top-k inner products over a bit-sliced index.

Components are floor(scale * x). Rows are dealt into blocks of about ``ROWS``;
a block's index holds, per component, its minimum, its width in bits, and the
``KEPT`` most significant bits of (value - minimum) as bitmaps over the rows.

For a query, every kept slice counts with the weight |q_d| * 2^b, so it is added
once for each binary digit of |q_d| (complemented where q_d < 0, which makes all
weights positive). Adders work on whole bitmaps: three bitmaps of one binary place
become a sum bitmap and a carry bitmap of the next, until one bitmap a place is
left - the bits of the quantised score of all rows at once. Walking these from
the most significant downward finds the k-th largest quantised score; the dropped
bits can add at most E = sum |q_d| (2^shift_d - 1), so only rows from that score
minus E on can be among the k best. These boundary rows are scored exactly.

Blocks meet blocks of queries in pairs, one task's memory is one pair, and the k
best of each pair are merged per query. Work is rows x queries, which the task
asks for; data moves once per block pair.

Defined cases: null vectors and those with null or non-finite components take no
part; vectors meet those of the same length only; a query's own id is no
candidate, also where it repeats; equal rows with different ids tie by the
smaller id; scores are exact while they fit a long; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import prepared, scratch

ROWS = 1 << 14
QUERIES = 1 << 8
KEPT = 5


def _bitmaps(bits: np.ndarray) -> np.ndarray:
    """Boolean rows (slices x rows) as 64-bit words, padded with zeros."""
    pad = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1, bitorder="little").view(np.uint64)


class SlicedBlock:
    """Index of one block: exact values, and bitmaps of their leading bits."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        low = values.min(axis=0)
        above = values - low
        width = np.array([int(x).bit_length() for x in above.max(axis=0)])
        self.shift = np.maximum(0, width - KEPT)
        self.width = np.minimum(width, KEPT)
        top = above >> self.shift
        self.first = np.concatenate(([0], np.cumsum(self.width)))
        bits = np.zeros((self.first[-1], len(ids)), dtype=bool)
        for d, n in enumerate(self.width):
            for b in range(n):
                bits[self.first[d] + b] = (top[:, d] >> b) & 1
        self.all = _bitmaps(np.ones((1, len(ids)), dtype=bool))[0]
        self.slices = _bitmaps(bits)
        self.inverse = ~self.slices & self.all

    def quantised_sum(self, q: np.ndarray) -> list[np.ndarray]:
        """Bitmaps of the quantised score's bits, least significant first."""
        places: dict[int, list[np.ndarray]] = {}
        index: dict[tuple[int, bool], list[int]] = {}
        for d in np.flatnonzero(q):
            weight = abs(int(q[d]))
            for b in range(self.width[d]):
                base = b + int(self.shift[d])
                for p in range(weight.bit_length()):
                    if weight >> p & 1:
                        index.setdefault((base + p, q[d] < 0), []).append(self.first[d] + b)
        for (place, negative), rows in index.items():
            places.setdefault(place, []).append((self.inverse if negative else self.slices)[rows])
        out, place = [], 0
        while places:
            have = places.pop(place, [])
            m = np.concatenate(have) if have else np.zeros((0, len(self.all)), dtype=np.uint64)
            carries = []
            while len(m) > 1:
                if len(m) == 2:
                    carries.append(m[:1] & m[1:])
                    m = m[:1] ^ m[1:]
                    break
                n = len(m) // 3 * 3
                a, b, c = m[0:n:3], m[1:n:3], m[2:n:3]
                half = a ^ b
                carries.append((a & b) | (c & half))
                m = np.concatenate((half ^ c, m[n:]))
            if carries:
                places.setdefault(place + 1, []).extend(carries)
            out.append(m[0] if len(m) else np.zeros_like(self.all))
            place += 1
        return out

    def top(self, query: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows for a query."""
        rows = np.arange(len(self.ids))
        own = self.ids == query
        live = self.all & ~_bitmaps(own[None, :])[0]
        if len(rows) - own.sum() > k:
            bits = self.quantised_sum(q)
            equal, above, least = live, np.zeros_like(live), 0
            for place in range(len(bits) - 1, -1, -1):
                more = above | (equal & bits[place])
                if np.bitwise_count(more).sum() >= k:  # the k-th largest has this bit
                    equal = equal & bits[place]
                    least |= 1 << place
                else:
                    above = more
                    equal = equal & ~bits[place]
            least -= int((np.abs(q) * ((1 << self.shift) - 1)).sum())
            kept = self._at_least(bits, least) & live if least > 0 else live
        else:
            kept = live
        rows = np.flatnonzero(np.unpackbits(kept.view(np.uint8), bitorder="little")[: len(self.ids)])
        v = self.values[rows]
        safe = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, len(q)) < 2**53
        score = (v.astype(np.float64) @ q.astype(np.float64)).astype(np.int64) if safe else v @ q
        best = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows][best], score[best]

    def _at_least(self, bits: list[np.ndarray], least: int) -> np.ndarray:
        if least >> len(bits):
            return np.zeros_like(self.all)
        above, equal = np.zeros_like(self.all), self.all
        for place in range(len(bits) - 1, -1, -1):
            if least >> place & 1:
                equal = equal & bits[place]
            else:
                above = above | (equal & bits[place])
                equal = equal & ~bits[place]
        return above | equal


def _packed(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id", kind="stable")
    return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "block": pdf["block"].iloc[:1].to_numpy(),
                         "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                         "v": [np.stack(pdf["v"].to_list()).astype(np.int64).tobytes()]})


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score`` from ``vec_id, embedding``; ``is_query`` picks the query rows."""
    usable = F.expr("embedding IS NOT NULL AND vec_id IS NOT NULL AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))")
    rows = prepared(vectors).where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), is_query.alias("query"), F.size("embedding").alias("dim"),
        F.expr(f"transform(embedding, x -> cast(floor({scale} * cast(x AS double)) AS bigint))").alias("v")).where("dim > 0")
    rows = scratch(rows, "sliced-rows")
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("query").cast("long")).alias("m"))
    # written first: the planner sees one row per dimension and broadcasts it, where an aggregate's guessed size would deal vectors by dimension
    sizes = scratch(sizes.select("dim", F.ceil(F.col("n") / ROWS).alias("blocks"), F.greatest(F.lit(1), F.ceil(F.col("m") / QUERIES)).alias("parts")),
                    "sliced-sizes")

    def packed(df: DataFrame, count: str) -> DataFrame:
        dealt = df.join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col(count)))
        return dealt.select("dim", "block", "vec_id", "v").groupBy("dim", "block").applyInPandas(_packed, "dim int, block long, ids binary, v binary")

    blocks = scratch(packed(rows, "blocks"), "sliced-blocks").join(sizes.select("dim", "parts"), "dim")
    asked = scratch(packed(rows.where("query"), "parts"), "sliced-queries").join(sizes.select("dim", "blocks"), "dim")
    blocks = blocks.select("dim", "block", "ids", "v", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"))
    asked = asked.select("dim", F.col("block").alias("part"), F.col("ids").alias("q_ids"), F.col("v").alias("q_v"),
                         F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"))

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.iloc[0]
        values = [np.frombuffer(x[c], dtype=np.int64).reshape(-1, int(x["dim"])) for c in ("v", "q_v")]
        index = SlicedBlock(np.frombuffer(x["ids"], dtype=np.int64), values[0])
        out = []
        for query, q in zip(np.frombuffer(x["q_ids"], dtype=np.int64), values[1]):
            ids, scores = index.top(int(query), q, k)
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids, "score": scores}))
        return pd.concat(out)

    found = blocks.join(asked, ["dim", "block", "part"]).groupBy("dim", "block", "part").applyInPandas(pair, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
