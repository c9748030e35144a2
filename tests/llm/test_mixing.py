"""Mixing: targets against the stated rounds, conservation, bounds, fair coins, reruns."""

import re
from collections import defaultdict

import pytest
from conftest import SF_MID
from edge import edge_docs, edge_rows, empty_docs, prose
from pyspark.sql import functions as F

from scorecast.llm import mixing as M


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0):
    """Share by weight, stop at the cap, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def check(rows, docs):
    """``rows`` of ``mix`` against ``(doc_id, source, text)``."""
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["copies"] * r["size"] <= r["taken"]
    want = defaultdict(int)
    for _, source, text in docs:
        want[source] += words(text)
    assert dict(size) == dict(want)
    for s, x in targets(want).items():
        assert target[s] == pytest.approx(x, rel=1e-9, abs=1e-9)
        assert abs(taken[s] - x) <= 1 + len(rows) / M.UNIT


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = M.mix(docs).collect()
    check(rows, [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()])
    partial = defaultdict(int)
    for r in rows:
        partial[r["source"]] += bool(r["size"]) and r["taken"] % r["size"] != 0
    assert max(partial.values()) <= 1  # all others are whole copies
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, M.mix(docs.repartition(7)).collect()))


@pytest.mark.parametrize("node", [2, 3, 256])
def test_trees(spark, monkeypatch, node):
    monkeypatch.setattr(M, "NODE", node)
    docs = [(i, "hot" if i % 3 else f"s{i % 5}", prose(i, 1 + i * 7 % 60)) for i in range(200)]
    check(M.mix(spark.createDataFrame(docs, "doc_id long, source string, text string")).collect(), docs)


def test_coins_are_fair(spark):
    docs = spark.createDataFrame([(i, "abc"[i % 3], prose(i, 5 + i % 9)) for i in range(60)], "doc_id long, source string, text string")
    mean, rate = defaultdict(float), {}
    for seed in range(16):
        for r in M.mix(docs, seed=seed).collect():
            mean[r["doc_id"]] += r["taken"] / r["size"] / 16
            rate[r["doc_id"]] = r["target"] / r["source_size"]
    for s in "abc":
        ids = [d for d in mean if "abc"[d % 3] == s]
        assert sum(mean[d] for d in ids) / len(ids) == pytest.approx(rate[ids[0]], abs=0.08)
        assert all(abs(mean[d] - rate[d]) < 0.6 for d in ids)


def test_mixed_documents_hold_the_words(spark):
    docs = edge_docs(spark)
    rows = M.mix(docs).collect()
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r["source"]] += words(r["text"])
    want = defaultdict(int)
    for r in rows:
        want[r["source"]] += r["taken"]
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_edges(spark):
    rows = M.mix(edge_docs(spark)).collect()
    assert len(rows) == len(edge_rows())
    check(rows, [(r[0], r[3], r[1]) for r in edge_rows()])
    assert M.mix(empty_docs(spark)).count() == 0 and M.mixed_documents(empty_docs(spark)).count() == 0
    nothing = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id long, source string, text string")
    assert [r["taken"] for r in M.mix(nothing).collect()] == [0, 0]


def test_no_python_in_the_plan(spark):
    plan = M.mix(spark.read.parquet(f"{SF_MID}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert F.lit(1) is not None


def test_rows_without_an_id_are_numbered_within_equal_texts(spark):
    docs = [(None, "ab"[i % 2], prose(i, 3 + i % 20)) for i in range(150)] + [(None, "a", "one and the same")] * 40 + [(7, "b", prose(i, 9)) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    rows = M.mix(df).collect()
    assert len(rows) == len(docs) == len({(r["doc_id"], r["of"], r["row"]) for r in rows})
    assert sum(r["row"] > 1 for r in rows) == 39  # only the repeated text needs numbers
    check(rows, docs)
    taken = sum(r["taken"] for r in rows)
    assert sum(words(r["text"]) for r in M.mixed_documents(df).collect()) == taken
