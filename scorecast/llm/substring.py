"""Substring dedup with difference-cover anchors.

A window is ``window`` consecutive words. A window repeats when its word
sequence also starts in a document with a smaller ``doc_id``; every word that a
repeating window covers is removed.

Method. ``COVERS[v]`` is a difference cover modulo ``v``: for any two alignments
i and j there is a shift s < v with (i + s) mod v and (j + s) mod v both in the
cover. So if only the runs of ``window - v + 1`` words that start at cover
positions are hashed, any two equal windows share an aligned anchor hash.

1. *Anchors.* Each task hashes the anchors of its documents (3 of 7 positions
   for the default period) and pre-aggregates them to one entry per hash and
   batch; entries are dealt by hash and those that occur in two documents come
   back to their documents.
2. *Extension.* A document extends its shared anchors to the windows around
   them and hashes only those windows in full (64 bits); a second round finds
   which of them start in an earlier document.
3. Every document marks the words of its repeating windows and drops them.

A hot passage costs one entry per batch in a round, because a batch sends the
smallest document of each hash only and resolves its own documents itself.
Bucket counts grow with the input's bytes; no list of documents is gathered.
Flags travel packed by blocks of documents, texts compressed, once per round.

Defined cases: null text has no words; fewer words than ``window`` repeat
nothing; rows with null ``doc_id`` are neither earlier nor later than others and
keep all words; rows that share a ``doc_id`` are judged by that id, so equal
rows do not remove each other; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import blocks_for, prepared
from .textops import batch_word_hashes, gram_hashes, word_hashes, words_of

#: Perfect or small difference covers modulo the key.
COVERS = {1: (0,), 2: (0, 1), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9)}

ENTRIES_PER_BUCKET = 2_000_000
ENTRIES_PER_BATCH = 1_000_000
BYTES_PER_WORD = 6
NO_ID = -(1 << 63)  # stands for a null doc_id inside the tasks
DOCS_PER_BLOCK = 4096
SENT = "bucket int, block int, hashes binary, docs binary, counts binary"
FLAGS = "block int, hashes binary, docs binary, counts binary"


def _starts(n: int, period: int) -> np.ndarray:
    at = np.arange(max(0, n))
    return at[np.isin(at % period, COVERS[period])]


def _grouped(h: np.ndarray, doc: np.ndarray):
    """Sort by hash; per hash the smallest document, and per entry its group's."""
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    size = np.diff(np.append(first, len(h)))
    return h, doc, first, np.repeat(doc[first], size)


def _shared(h, doc, first, least):
    """Entries whose hash occurs in two documents."""
    most = np.maximum.reduceat(doc, first)
    return np.repeat(most, np.diff(np.append(first, len(h)))) != least


def _later(h, doc, first, least):
    """Entries whose hash occurs in a smaller document."""
    return doc != least


def _prime(n: int) -> int:
    """The least prime from n on: ids with a common step still spread over that many blocks."""
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _flag_rows(h: np.ndarray, doc: np.ndarray, blocks: int):
    """One row per block of documents, with its documents, how many hashes each has, and these."""
    block = doc % blocks
    order = np.lexsort((doc, block))
    h, doc, block = h[order], doc[order], block[order]
    cut = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    for i, a in enumerate(cut):
        b = cut[i + 1] if i + 1 < len(cut) else len(doc)
        ids, counts = np.unique(doc[a:b], return_counts=True)
        yield int(block[a]), h[a:b].tobytes(), ids.astype(np.int64).tobytes(), counts.astype(np.int32).tobytes()


def _send(hs: list, ds: list, buckets: int, blocks: int, flagged, kind=np.uint64) -> pd.DataFrame:
    """A batch's rows: its own flags (with ``counts``) and one entry per hash, dealt by hash.

    Anchors travel as the low 32 bits of their hash (a chance match only costs an
    extension), windows as all 64.
    """
    h, doc = np.concatenate(hs), np.concatenate(ds)
    rows = []
    if len(h):
        keep = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))  # repeats within a run of one document
        h, doc = h[keep], doc[keep]
        h, doc, first, least = _grouped(h, doc)
        mark = flagged(h, doc, first, least)
        rows += [(row[0] % buckets, *row) for row in _flag_rows(h[mark].astype(kind), doc[mark], blocks)] if mark.any() else []
        h, doc = h[first], doc[first]
        bucket = (h >> np.uint64(40)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        h, doc, bucket = h[order], doc[order], bucket[order]
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        for i, a in enumerate(cut):
            b = cut[i + 1] if i + 1 < len(cut) else len(h)
            ids, index = np.unique(doc[a:b], return_inverse=True)
            small = np.uint16 if len(ids) < 1 << 16 else np.uint32
            rows.append((int(bucket[a]), None, h[a:b].astype(kind).tobytes(), ids.astype(np.int64).tobytes() + index.astype(small).tobytes(), None))
    out = pd.DataFrame(rows, columns=["bucket", "block", "hashes", "docs", "counts"])
    return out.astype({"block": "Int32"})


def _unpacked(hashes: bytes, docs: bytes, kind) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(hashes, dtype=kind)
    n = len(h)
    for size, index in ((2, np.uint16), (4, np.uint32)):
        k, rest = divmod(len(docs) - size * n, 8)
        if rest == 0 and 0 < k <= n and (k < 1 << 16) == (size == 2):
            return h, np.frombuffer(docs[: 8 * k], dtype=np.int64)[np.frombuffer(docs[8 * k :], dtype=index)]
    raise ValueError("damaged block")


def _resolved(sent: DataFrame, flagged, blocks: int, kind=np.uint64) -> DataFrame:
    """Deal the entries by bucket and return every flag, packed by blocks of documents."""

    def bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["counts"].notna()
        rows = list(pdf[own][["block", "hashes", "docs", "counts"]].itertuples(index=False, name=None))
        parts = [_unpacked(x, d, kind) for x, d in zip(pdf["hashes"][~own], pdf["docs"][~own])]
        if parts:
            h, doc, first, least = _grouped(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            mark = flagged(h, doc, first, least)
            if mark.any():
                rows += list(_flag_rows(h[mark], doc[mark], blocks))
        return pd.DataFrame(rows, columns=["block", "hashes", "docs", "counts"]).astype({"block": "int32"})

    return sent.groupBy("bucket").applyInPandas(bucket, FLAGS)


def _with_texts(texts: DataFrame, flags: DataFrame, blocks: int) -> DataFrame:
    """Blocks of documents: first their flags, then their texts."""
    # rows without an id need no company: spread them
    block = F.pmod(F.when(F.col("doc_id") == NO_ID, F.xxhash64("packed")).otherwise(F.col("doc_id")), F.lit(blocks)).cast("int")
    none = F.lit(None).cast("binary")
    both = texts.select(block.alias("block"), "doc_id", "packed", none.alias("hashes"), none.alias("docs"), none.alias("counts")).unionByName(
        flags.select("block", F.lit(NO_ID).alias("doc_id"), none.alias("packed"), "hashes", "docs", "counts"))
    return both.repartition("block").sortWithinPartitions("block", F.col("packed").isNotNull())


def _documents(batches, kind=np.uint64):
    """Yield ``(doc_id, text bytes, flagged hashes)`` from rows ordered by ``_with_texts``."""
    unzip = zstandard.ZstdDecompressor()
    none = np.zeros(0, dtype=kind)
    now, flags = None, {}
    for pdf in batches:
        for block, doc, packed, hashes, docs, counts in pdf.itertuples(index=False, name=None):
            if block != now:
                now, flags = block, {}
            if packed is None:
                ends = np.cumsum(np.frombuffer(counts, dtype=np.int32))
                for d, part in zip(np.frombuffer(docs, dtype=np.int64).tolist(), np.split(np.frombuffer(hashes, dtype=kind), ends[:-1])):
                    flags.setdefault(d, []).append(part)
            else:
                parts = flags.get(doc)
                yield doc, unzip.decompress(packed), np.unique(np.concatenate(parts)) if parts else none


def _packed_texts(docs: DataFrame) -> DataFrame:
    def pack(batches):
        zip_ = zstandard.ZstdCompressor(level=1)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "packed": [zip_.compress((t or "").encode("utf-8", "surrogatepass")) for t in pdf["text"]]})

    return docs.mapInPandas(pack, "doc_id long, packed binary")


def remove_repeats(docs: DataFrame, window: int = 13, period: int = 7) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the kept words joined by one blank) per input row."""
    if period not in COVERS or period > window:
        raise ValueError(f"period must be one of {sorted(COVERS)} and at most the window")
    anchor = window - period + 1
    docs = prepared(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    total, rows = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    words, blocks = total // BYTES_PER_WORD, _prime(blocks_for(rows, DOCS_PER_BLOCK))
    buckets = blocks_for(words * len(COVERS[period]) // period, ENTRIES_PER_BUCKET)
    buckets2 = blocks_for(words, ENTRIES_PER_BUCKET)

    def anchors(batches):
        hs, ds, size = [], [], 0
        for pdf in batches:
            pdf = pdf[pdf["doc_id"] != NO_ID]
            ids = pdf["doc_id"].to_numpy(dtype=np.int64)
            for a, b, h, at in batch_word_hashes(pdf["text"].tolist()):
                for i in range(a, b):
                    g = gram_hashes(h[at[i - a] : at[i - a + 1]], anchor)
                    g = g[_starts(len(g), period)]
                    hs.append(g)
                    ds.append(np.full(len(g), ids[i]))
                    size += len(g)
                if size > ENTRIES_PER_BATCH:
                    yield _send(hs, ds, buckets, blocks, _shared, np.uint32)
                    hs, ds, size = [], [], 0
        if hs:
            yield _send(hs, ds, buckets, blocks, _shared, np.uint32)

    def extended(batches):
        hs, ds, size = [], [], 0
        for doc, raw, flags in _documents(batches, np.uint32):
            if doc == NO_ID or not len(flags):
                continue
            h = word_hashes(raw)
            g = gram_hashes(h, anchor)
            at = _starts(len(g), period)
            at = at[np.isin(g[at].astype(np.uint32), flags)]
            n = len(h) - window + 1
            if n < 1 or not len(at):
                continue
            # windows that contain an anchor at p start in [p + anchor - window, p]
            step = np.zeros(len(h) + 2, dtype=np.int32)
            np.add.at(step, np.maximum(0, at + anchor - window), 1)
            np.add.at(step, at + 1, -1)
            near = np.flatnonzero(np.cumsum(step)[:n] > 0)
            if len(near):
                hs.append(gram_hashes(h, window)[near])
                ds.append(np.full(len(near), doc))
                size += len(near)
                if size > ENTRIES_PER_BATCH:
                    yield _send(hs, ds, buckets2, blocks, _later)
                    hs, ds, size = [], [], 0
        if hs:
            yield _send(hs, ds, buckets2, blocks, _later)

    def kept(batches):
        out = []
        for doc, raw, flags in _documents(batches):
            words_ = raw.split()
            gone = np.zeros(len(words_), dtype=bool)
            if len(flags) and len(words_) >= window:
                g = gram_hashes(word_hashes(raw), window)
                at = np.flatnonzero(np.isin(g, flags))
                step = np.zeros(len(words_) + 1, dtype=np.int32)
                np.add.at(step, at, 1)
                np.add.at(step, at + window, -1)
                gone = np.cumsum(step)[: len(words_)] > 0
                words_ = [w for w, x in zip(words_, gone) if not x]
            out.append((doc, len(gone), int(gone.sum()), b" ".join(words_).decode("utf-8", "surrogatepass")))
            if len(out) == 256:
                yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])

    texts = _packed_texts(docs)
    shared = _resolved(docs.mapInPandas(anchors, SENT), _shared, blocks, np.uint32)
    later = _resolved(_with_texts(texts, shared, blocks).mapInPandas(extended, SENT), _later, blocks)
    out = _with_texts(texts, later, blocks).mapInPandas(kept, "doc_id long, n_words long, n_removed long, kept string")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def repeats_digest(docs: DataFrame) -> DataFrame:
    """The contract's digest of ``remove_repeats``."""
    r = remove_repeats(docs)
    return r.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int | None, str | None]], window: int = 13) -> dict:
    """Reference of the tests: ``doc_id -> (n_words, n_removed, sha256)`` by a dictionary of all windows."""
    first: dict = {}
    split = [(d, words_of(t)) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if d is not None:
                first[key] = min(d, first.get(key, d))
    out = {}
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        keep = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(keep).hexdigest())
    return out
