"""Substring dedup against a dictionary of all windows."""

import hashlib
import itertools

import pytest
from conftest import SF_SMALL
from edge import edge_docs, edge_rows, empty_docs, prose
from pyspark.sql import functions as F

from scorecast.llm import substring as S


def digest(df, **settings):
    out = S.remove_repeats(df, **settings).withColumn("sha", F.sha2(F.col("kept").cast("binary"), 256))
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["sha"]) for r in out.collect()}


@pytest.mark.parametrize("period", S.COVERS)
def test_covers_meet_every_shift(period):
    cover = S.COVERS[period]
    for i, j in itertools.product(range(period), repeat=2):
        assert any((i + s) % period in cover and (j + s) % period in cover for s in range(period))


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = S.brute_force([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert digest(docs) == want and sum(x[1] for x in want.values()) > 0


def passages():
    shared = prose(50, 60)
    rows = [(i, prose(i, 40 + i % 17) + " " + " ".join(shared.split()[i % 9 : 30 + i % 23]) + "\n\t" + prose(1000 + i, i % 11)) for i in range(120)]
    return rows + [(500, shared), (501, " ".join(shared.split()[:13])), (502, " ".join(shared.split()[:12])), (499, shared + " " + shared)]


@pytest.mark.parametrize("window,period", [(13, 7), (13, 13), (13, 3), (5, 1)])
def test_planted_passages(spark, monkeypatch, window, period):
    monkeypatch.setattr(S, "ENTRIES_PER_BUCKET", 500)  # many buckets, batches and blocks
    monkeypatch.setattr(S, "ENTRIES_PER_BATCH", 300)
    monkeypatch.setattr(S, "DOCS_PER_BLOCK", 10)
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert digest(docs, window=window, period=period) == S.brute_force(rows, window)


def test_edges(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    out = S.remove_repeats(edge_docs(spark)).collect()
    assert len(out) == len(rows)
    want = S.brute_force([x for x in rows if x[0] is not None])
    for r in out:
        if r["doc_id"] is None:  # neither earlier nor later than others
            assert r["n_removed"] == 0
        elif r["doc_id"] != 11:
            assert (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) == want[r["doc_id"]]
        else:  # rows of one id are judged by the id and do not remove each other
            assert r["n_removed"] == 0
    assert S.remove_repeats(empty_docs(spark)).count() == 0


def test_wrong_settings(spark):
    with pytest.raises(ValueError, match="period"):
        S.remove_repeats(empty_docs(spark), window=5, period=7)
