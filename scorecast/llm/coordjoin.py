"""MinHash near-dedup by a signature-coordinate inverted join.

Documents are sets of 5-word shingles (ASCII lower case); two are linked when
the Jaccard similarity of their full sets reaches the threshold.

1. *Sketch.* One pass gives each document its set size, a 128-bit set hash and
   ``M`` MinHash coordinates. Equal sets collapse to the smallest ``doc_id``
   before anything else, so exact copies never meet each other.
2. *Prefix.* A linked pair agrees on at least ``t`` of ``M`` coordinates (``t``
   is the binomial quantile at the threshold for a miss rate of 1e-6), hence on
   at least one of any ``M - t + 1``. Only those prefix coordinates are posted,
   under ``(coordinate, value)``; values held by one document are dropped.
3. *Count.* A run (one posting list) counts the collisions of its documents
   over the whole signatures in numpy. A pair belongs to the run of its first
   common prefix coordinate and is skipped in the others. Only documents with a
   partner of ``t`` collisions or more go on - documents, not pairs.
4. *Confirm.* The same runs, now with full shingle sets, confirm links exactly,
   best-connected document first. Pairs that are already connected in the run
   are skipped and only connecting links leave it, so a group of n near copies
   sends n - 1 rows at most.
5. Links become components by neighbour minima with pointer jumping, over
   scratch tables.

A run of more than ``RUN`` documents is cut into blocks by a hash, and each pair
of blocks is a run of its own: memory stays bounded and no pair is lost. The
work of one posting list stays quadratic in its documents over ``RUN``.

Defined cases: null or empty texts have an empty set and no link; fewer than
five words make one shingle of the whole sequence; rows that share a ``doc_id``
count as one vertex; a null ``doc_id`` is linked with nothing, its component is
null and the row is kept; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import prepared, scratch
from .textops import U64, batch_word_hashes, gram_hashes, mix

M = 64
RUN = 1024
VALUES = 1 << 18
SHINGLE = 5
MISS = 1e-6
FREQUENT = 1024
_RNG = np.random.Generator(np.random.PCG64(97))
_A = (_RNG.integers(0, 1 << 62, M, dtype=np.int64).astype(U64) << U64(1)) | U64(1)
_B = _RNG.integers(0, 1 << 62, M, dtype=np.int64).astype(U64)
NO_ID = -(1 << 63)  # stands for a null doc_id inside the tasks
SKETCH = "doc_id long, n_shingles long, k1 long, k2 long, sig binary"


def match_threshold(similarity: float, m: int = M, miss: float = MISS) -> int:
    """Largest t with P(Binomial(m, similarity) < t) <= miss."""
    below, t = 0.0, 0
    while t < m:
        below += math.comb(m, t) * similarity**t * (1 - similarity) ** (m - t)
        if below > miss:
            return t
        t += 1
    return m


def shingle_set(h: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a word-hash sequence."""
    if not len(h):
        return h
    return np.unique(gram_hashes(h, k) if len(h) >= k else gram_hashes(h, len(h)) ^ U64(len(h)))


def _signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.empty((len(first), M), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for c in range(M):
            out[:, c] = np.minimum.reduceat(values * _A[c] + _B[c], first) >> U64(32)
    return out


def _set_key(values: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(values).sum(dtype=U64).view(np.int64)) if len(values) else 0


def _sketches(batches):
    for pdf in batches:
        ids = pdf["doc_id"].to_numpy()
        for a, b, h, at in batch_word_hashes(pdf["text"].tolist(), lower=True):
            sets = [shingle_set(h[at[i] : at[i + 1]]) for i in range(b - a)]
            n = np.array([len(s) for s in sets])
            has = np.flatnonzero(n)
            sig, k = [b""] * (b - a), np.zeros((b - a, 2), dtype=np.int64)
            if len(has):
                values = np.concatenate([sets[i] for i in has])
                first = np.concatenate(([0], np.cumsum(n[has])[:-1]))
                with np.errstate(over="ignore"):
                    k[has, 0] = np.add.reduceat(mix(values), first).view(np.int64)
                    k[has, 1] = np.add.reduceat(mix(values ^ U64(0x5DEECE66D)), first).view(np.int64)
                for i, s in zip(has, _signatures(values, first)):
                    sig[i] = s.tobytes()
            yield pd.DataFrame({"doc_id": ids[a:b], "n_shingles": n, "k1": k[:, 0], "k2": k[:, 1], "sig": sig})


def _shingle_rows(batches):
    for pdf in batches:
        ids = pdf["doc_id"].to_numpy()
        for a, b, h, at in batch_word_hashes(pdf["text"].tolist(), lower=True):
            sets = [shingle_set(h[at[i] : at[i + 1]]) for i in range(b - a)]
            yield pd.DataFrame({"doc_id": ids[a:b], "k1": [_set_key(x) for x in sets], "shingles": [x.tobytes() for x in sets]})


def _runs(batches):
    """Rows of one ``(key, lo, hi)`` together; the input is ordered by them."""
    rest = None
    for pdf in batches:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        k = pdf[["key", "lo", "hi"]].to_numpy()
        cut = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]).any(axis=1)))) if len(k) else np.zeros(0, int)
        for a, b in zip(cut[:-1], cut[1:]):
            yield pdf.iloc[a:b]
        rest = pdf.iloc[cut[-1] :] if len(cut) else None
    if rest is not None and len(rest):
        yield rest


def _partners(run: pd.DataFrame, sig: np.ndarray, similarity: float, t: int):
    """Yield ``(i, js)``: rows js > i of the run whose signatures match row i's in t places or more."""
    c = int(run["key"].iloc[0]) >> 32
    n, block, doc = run["n_shingles"].to_numpy(), run["block"].to_numpy(), run["doc_id"].to_numpy()
    cross = run["lo"].iloc[0] != run["hi"].iloc[0]
    for i in range(len(run) - 1):
        js = np.arange(i + 1, len(run))
        ok = np.minimum(n[js], n[i]) >= similarity * np.maximum(n[js], n[i]) - 1e-9
        if cross:
            ok &= block[js] != block[i]
        js = js[ok & (doc[js] != doc[i])]
        if not len(js):
            continue
        same = sig[js] == sig[i]
        js = js[(same.sum(axis=1) >= t) & ~same[:, :c].any(axis=1)]
        if len(js):
            yield i, js


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint32).reshape(len(column), M)


def near_links(docs: DataFrame, sketch: DataFrame, similarity: float) -> DataFrame:
    """Connecting links ``(a, b)`` with ``a < b`` between set representatives."""
    t = match_threshold(similarity)
    prefix = M - t + 1
    reps = sketch.where((F.col("doc_id") != NO_ID) & (F.col("n_shingles") > 0)).groupBy("k1", "k2", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"), F.min("sig").alias("sig"))
    reps = scratch(reps.select("doc_id", "k1", "n_shingles", "sig"), "near-reps")

    # a key is the coordinate's number in the high half and its four bytes in the low half
    keys = F.array(*[F.lit(c << 32).cast("long") + F.conv(F.hex(F.substring("sig", 4 * c + 1, 4)), 16, 10).cast("long") for c in range(prefix)])
    posted = reps.select("doc_id", "k1", F.explode(keys).alias("key"))
    posted = posted.withColumn("run", F.count(F.lit(1)).over(W.partitionBy("key"))).where("run > 1")
    blocks = F.ceil(F.col("run") / RUN).cast("int")
    posted = posted.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks.cast("long")).cast("int")).select(
        "doc_id", "k1", "key", "block", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    posted = posted.select("doc_id", "k1", "key", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "doc_id")

    def counted(batches):
        for run in _runs(batches):
            sig = _matrix(run["sig"])
            has = np.zeros(len(run), dtype=bool)
            for i, js in _partners(run, sig, similarity, t):
                has[i] = True
                has[js] = True
            if has.any():
                yield run[has]

    def confirmed(batches):
        for run in _runs(batches):
            run = run.reset_index(drop=True)
            sig = _matrix(run["sig"])
            sets = [np.frombuffer(x, dtype=U64) for x in run["shingles"]]
            pairs = [np.stack([np.full(len(js), i), js]).astype(np.int32) for i, js in _partners(run, sig, similarity, t)]
            if not pairs:
                continue
            pairs = np.concatenate(pairs, axis=1)
            one, other = np.concatenate((pairs, pairs[::-1]), axis=1)
            order = np.argsort(one, kind="stable")
            one, other = one[order], other[order]
            first = np.searchsorted(one, np.arange(len(sets) + 1))
            group = np.arange(len(sets))
            out = []
            doc = run["doc_id"].to_numpy()
            for i in np.lexsort((doc, -np.diff(first))):
                js = other[first[i] : first[i + 1]]
                at = 0
                while at < len(js):  # as many partners at once as hold about VALUES shingles
                    more, size = [], 0
                    while at < len(js) and size < VALUES:
                        if group[js[at]] != group[i]:
                            more.append(js[at])
                            size += len(sets[js[at]])
                        at += 1
                    if not more:
                        continue
                    sizes = np.array([len(sets[j]) for j in more])
                    values = np.concatenate([sets[j] for j in more])
                    place = np.minimum(np.searchsorted(sets[i], values), len(sets[i]) - 1)
                    common = np.add.reduceat((sets[i][place] == values).astype(np.int64), np.concatenate(([0], np.cumsum(sizes)[:-1])))
                    union = sizes + len(sets[i]) - common
                    # compare as integers where the threshold is a whole per cent
                    percent = round(similarity * 100)
                    ok = 100 * common >= percent * union if abs(similarity * 100 - percent) < 1e-9 else common >= similarity * union
                    for j in np.array(more)[ok]:
                        if group[j] != group[i]:
                            group[group == group[j]] = group[i]
                            out.append((min(doc[i], doc[j]), max(doc[i], doc[j])))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    row = "doc_id long, k1 long, key long, block int, lo int, hi int, n_shingles long, sig binary"
    columns = [x.split()[0] for x in row.split(", ")]
    some = scratch(dealt(posted.join(reps, ["doc_id", "k1"])).select(*columns).mapInPandas(counted, row), "near-candidates")
    wanted = some.select("doc_id").distinct()
    # merged at every size: the candidates grow with the documents, so a broadcast would only hold for small inputs
    sets = docs.join(wanted.hint("merge"), "doc_id", "left_semi").mapInPandas(_shingle_rows, "doc_id long, k1 long, shingles binary")
    sets = sets.dropDuplicates(["doc_id", "k1"])
    return dealt(some.join(sets, ["doc_id", "k1"])).select(*columns, "shingles").mapInPandas(confirmed, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(doc_id, component_id)`` of the vertices of the links; the id is the smallest vertex."""
    links = scratch(links, "links")  # read in both directions
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    label = edges.select(F.col("u").alias("doc_id")).distinct().withColumn("component_id", F.col("doc_id"))
    while True:
        least = edges.join(label, edges.u == label.doc_id).groupBy("v").agg(F.min("component_id").alias("m"))
        step = label.join(least, label.doc_id == least.v).select(
            "doc_id", F.col("component_id").alias("was"), F.least("component_id", "m").alias("m"))
        jump = step.select(F.col("doc_id").alias("m"), F.col("m").alias("component_id"))
        new = scratch(step.join(jump, "m").select("doc_id", "was", "component_id"), "labels")
        if not new.where("was <> component_id").head(1):
            return new.select("doc_id", "component_id")
        label = new.select("doc_id", "component_id")


def _representatives(sketch: DataFrame, named: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, rep``: the smallest id with the same set, for every row of ``sketch``.

    Sets that more than one in ``FREQUENT`` rows hold are fewer than ``FREQUENT`` and are broadcast; no key of the
    other join is hot. Rows without a set or an id, and sets that occur once, are their own.
    """
    key = ["k1", "k2", "n_shingles"]
    kind = named.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    kind = scratch(kind, "near-kinds")
    often = F.col("rows") > max(1, named.count()) / FREQUENT
    hot = F.broadcast(kind.where(often).drop("rows"))
    of_set = (F.col("doc_id") != NO_ID) & (F.col("n_shingles") > 0)
    rows = sketch.select("doc_id", *key)
    common = rows.where(of_set).join(hot, key)
    others = rows.where(of_set).join(hot, key, "left_anti").join(kind.where(~often).drop("rows"), key, "left")
    out = common.unionByName(others).unionByName(rows.where(~of_set).withColumn("rep", F.col("doc_id")))
    return out.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))


def near_duplicates(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per input row."""
    docs = prepared(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = scratch(docs.mapInPandas(_sketches, SKETCH), "near-sketch")
    named = sketch.where(F.col("doc_id") != NO_ID)
    rep = _representatives(sketch, named)
    # ids with several rows: their rows' representatives are one vertex
    several = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id")
    same = rep.join(several, "doc_id", "left_semi").where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    label = components(near_links(docs, sketch, similarity).unionByName(same.distinct()))
    out = rep.join(label.withColumnsRenamed({"doc_id": "rep", "component_id": "c"}), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("c", "rep").alias("component_id"))
    out = out.withColumns({c: F.when(F.col("doc_id") != NO_ID, F.col(c)) for c in ("doc_id", "component_id")})
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def brute_force(rows: list[tuple[int, str | None]], percent: int, k: int = SHINGLE) -> dict:
    """Reference of the tests: ``doc_id -> (n_shingles, component_id, kept)`` from all pairs."""
    from .textops import words_of

    sets = {}
    for d, text in rows:
        w = words_of(text, lower=True)
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}
