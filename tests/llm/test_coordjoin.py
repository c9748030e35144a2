"""Near-duplicates against all pairs, in one run and in blocks."""

import random

import pytest
from conftest import SF_SMALL
from edge import edge_docs, edge_rows, empty_docs, prose

from scorecast.llm import coordjoin as C


def groups(df, similarity):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in C.near_duplicates(df, similarity).collect()}


@pytest.mark.parametrize("percent", [80, 85])
def test_given_documents(spark, percent):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert groups(docs, percent / 100) == C.brute_force([(r["doc_id"], r["text"]) for r in docs.collect()], percent)


def copies():
    """Chains and clouds of copies with a few changed words each, exact copies, and strangers that share a passage."""
    r = random.Random(4)
    rows, passage = [], prose(77, 25)
    for g in range(3):
        words = prose(g, 160).split()
        for i in range(40):
            w = list(words)
            for _ in range(r.randint(0, 6)):
                w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
            rows.append((" ".join(w)))
        for _ in range(15):  # a chain drifts away from its start
            words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
            words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
            rows.append(" ".join(words).upper())
    rows += [rows[3]] * 20 + [prose(500 + i, 60) + " " + passage for i in range(60)]
    ids = list(range(len(rows)))
    r.shuffle(ids)
    return list(zip(ids, rows))


@pytest.mark.parametrize("run", [C.RUN, 7])
def test_planted_copies(spark, monkeypatch, run):
    monkeypatch.setattr(C, "RUN", run)
    rows = copies()
    got = groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 0.85)
    assert got == C.brute_force(rows, 85)


def test_match_threshold_misses_less_than_it_says():
    from math import comb

    for s in (0.8, 0.85, 0.95):
        t = C.match_threshold(s)
        assert sum(comb(C.M, i) * s**i * (1 - s) ** (C.M - i) for i in range(t)) <= C.MISS
        assert t > C.M * s / 2


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r["doc_id"]: r["component_id"] for r in C.components(links).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[1001] == 1000
    assert C.components(links.limit(0)).count() == 0


def test_edges(spark):
    out = C.near_duplicates(edge_docs(spark), 0.85).collect()
    assert len(out) == len(edge_rows())
    named = {r["doc_id"]: r for r in out}
    assert [named[i]["component_id"] for i in (1, 2, 3, 12, 13)] == [1, 1, 1, 12, 12]
    assert named[12]["n_shingles"] == 1 and named[14]["n_shingles"] == 6
    for i in (5, 6, 7):  # no words: linked with nothing
        assert (named[i]["n_shingles"], named[i]["component_id"], named[i]["kept"]) == (0, i, True)
    nameless = [r for r in out if r["doc_id"] is None]
    assert len(nameless) == 2 and all(r["component_id"] is None and r["kept"] for r in nameless)
    assert sorted(r["n_shingles"] for r in nameless) == [0, named[1]["n_shingles"]]
    assert C.near_duplicates(empty_docs(spark), 0.85).count() == 0


def test_rows_of_one_id_are_one_vertex(spark):
    a, b = prose(1, 50), prose(2, 50)
    rows = [(5, a), (9, a), (9, b), (7, b)]
    out = C.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 0.85).collect()
    assert {r["component_id"] for r in out} == {5}
