"""LM scoring against plain sums, and both word paths against each other."""

import math
import zlib
from collections import Counter

import numpy as np
from conftest import SF_SMALL
from edge import edge_docs, edge_rows, empty_docs
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scorecast.llm import latticelm as L
from scorecast.llm.lattice import Pieces, reestimated, vocabulary_path
from scorecast.llm.textops import words_of


def plain(rows, rounds=L.ROUNDS):
    """``(text, training)`` rows scored by plain loops."""
    pieces = Pieces.at(vocabulary_path())
    c, ends = Counter(), 0
    for text, training in rows:
        if training:
            c.update(words_of(text, lower=True))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    p = pieces.start()
    for _ in range(rounds if c else 0):
        p = reestimated(pieces.expected_counts(list(c), np.array(list(c.values()), float), p), L.SMOOTHING)
    out = []
    for text, training in rows:
        words = words_of(text, lower=True)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        score = math.log10((ends - L.DISCOUNT) / n) if n else math.log10(0.5)
        if words:
            lp = pieces.log_probabilities(words, p[:, None])[:, 0]
            for w, x in zip(words, lp):
                whole = max(c[w] - L.DISCOUNT, 0) / n if n else 0
                rest = L.DISCOUNT * v / n if n else 0.5
                score += np.logaddexp(math.log(whole) if whole else -np.inf, math.log(rest) + x) / math.log(10)
        out.append((training, len(words) + 1, sum(c[w] > 0 for w in words) + (ends > 0), n, base, score))
    return out


def close(got, want):
    key = lambda r: (str(r[0]), r[1], r[2], round(r[4], 3), round(r[5], 2))
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9) and math.isclose(a[5], b[5], rel_tol=1e-7), (a, b)


def test_given_documents(spark):
    got = entry.queries()["op8_lattice_lm"](spark, SF_SMALL).collect()
    rows = [(r["text"], zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    close([(not r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got], plain(rows))


def test_rare_words_are_joined_exactly(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    training = F.col("doc_id") % 3 > 0
    broad = {r["doc_id"]: r for r in L.score(docs, training).collect()}
    for r in L.score(docs, training, frequent=20).collect():
        b = broad[r["doc_id"]]
        assert r["n_known"] == b["n_known"] and math.isclose(r["score"], b["score"], rel_tol=1e-9) and math.isclose(r["base_score"], b["base_score"], rel_tol=1e-9)


def test_edges(spark):
    docs = edge_docs(spark)
    training = F.col("doc_id") % 2 == 0
    got = [(r["training"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in L.score(docs, training).collect()]
    close(got, plain([(r[1], r[0] is not None and r[0] % 2 == 0) for r in edge_rows()]))
    close([(r["training"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in L.score(docs, F.lit(False)).collect()],
          plain([(r[1], False) for r in edge_rows()]))
    assert L.score(empty_docs(spark), training).count() == 0


def test_held_out_texts_beat_garbled_ones(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) > 200").select("doc_id", "text")
    garbled = docs.select((F.col("doc_id") + 10_000_000).alias("doc_id"), F.reverse("text").alias("text"))
    rows = {r["doc_id"]: r["score"] for r in L.score(docs.union(garbled), (F.col("doc_id") < 10_000_000) & (F.col("doc_id") % 3 > 0)).collect()}
    held = [d for d in rows if d < 10_000_000 and d % 3 == 0]
    assert sum(rows[d] > rows[d + 10_000_000] for d in held) > 0.98 * len(held)
