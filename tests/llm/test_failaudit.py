"""The filter audit against orders applied one after the other to plain sets."""

import itertools
import re
from collections import Counter

import pytest
from conftest import SF_SMALL
from edge import edge_docs, edge_rows, empty_docs, prose
from pyspark.sql import functions as F

from scorecast.llm import failaudit

LABELS = "doc_id long, quality int, toxic int"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failures(rows):
    """The letters that each row ``(doc_id, text, source)`` fails."""
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A"} if len(ws) < 200 else set()
        fails |= {"B"} if 100 * len(set(ws)) < 50 * len(ws) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        fails |= {"E"} if doc_id is not None and first[text] < doc_id else set()
        out.append(fails)
    return out


def brute_force(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = failures(rows)
    out, shapley = {}, Counter()
    for part in {s or "" for _, _, s in rows}:
        of_part = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        for order in itertools.permutations("ABCDE"):
            alive = set(of_part)
            for step, f in enumerate(order, 1):
                gone = {k for k in alive if f in fails[k]}
                failing = {k for k in of_part if f in fails[k]}
                alive -= gone
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [len(alive), len(gone), len(failing - gone), sum(fails[k] == {f} for k in of_part),
                                                   sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone)]
    return sorted((*key, *row, shapley[key[0], key[1][key[2] - 1]]) for key, row in out.items())


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def test_given_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    want = brute_force(rows, [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()])
    assert rows_of(failaudit.audit(docs, labels)) == want


def test_edge_rows(spark):
    """Nulls, repeats, clashing columns; ids that hold several texts; several labels of one id."""
    labels = [(1, 1, 1), (2, 0, 1), (2, 1, 0), (11, 1, 0), (12, 1, 1), (13, None, None), (None, 1, 1), (99, 1, 1)]
    rows = [(r[0], r[1], r[3]) for r in edge_rows()]
    assert rows_of(failaudit.audit(edge_docs(spark), spark.createDataFrame(labels, LABELS))) == brute_force(rows, labels)


def test_one_text_in_a_third_of_all_rows(spark):
    rows = [(i, "SAME text again" if i % 3 == 0 else prose(i, 210), "b" if i % 2 else None) for i in range(300)]
    rows += [(3, "SAME text again", "b")] * 100 + [(None, "SAME text again", "a")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert rows_of(failaudit.audit(docs, spark.createDataFrame([], LABELS))) == brute_force(rows, [])


def test_filters_of_the_caller(spark):
    """Any conditions, any number of them, another part, no labels and no copies."""
    docs = spark.createDataFrame([(i, str(i), i % 2) for i in range(60)], "doc_id long, text string, half int")
    got = failaudit.audit(docs, part=F.col("half"), copies=None, filters={"x": F.col("doc_id") < 30, "y": F.col("doc_id") % 3 == 0})
    rows = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in got.collect()}
    assert len(rows) == 8 and rows["0", "xy", 1] == (15, 15, 0, 10, 25) and rows["0", "xy", 2] == (10, 5, 5, 5, 15)


def test_empty_table(spark):
    assert failaudit.audit(empty_docs(spark), spark.createDataFrame([], LABELS)).count() == 0


@pytest.mark.parametrize("text,fails", [("", "A"), ("w " * 200, "B"), ("é" * 50 + "A", "A"), ("é" * 48 + "A", "AC"), ("a|b", "AD")])
def test_conditions(spark, text, fails):
    docs = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    got = {f for f in "ABCDE" if failures([(1, text, "s")])[0] >= {f}}
    _, tables = failaudit.failing_ids(docs)
    assert got == set(fails) == {f for f, t in tables.items() if t.count()}
