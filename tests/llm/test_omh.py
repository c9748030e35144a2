"""Order MinHash against a plain Python signature, and what it is sensitive to."""

import hashlib
import re

import pytest
import xxhash
from conftest import SF_SMALL
from edge import edge_docs, edge_rows, empty_docs, prose
from pyspark.sql import functions as F

from scorecast.llm import omh


def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def _hash(parts):
    """The SQL function's 64-bit hash of several values: each is hashed with the last hash as its seed."""
    h = 42
    for kind, v in parts:
        if v is None:
            continue
        raw = v.encode() if kind == "s" else (v & ((1 << 8 * kind) - 1)).to_bytes(kind, "little")
        h = xxhash.xxh64_intdigest(raw, h & ((1 << 64) - 1))
    return _signed(h)


def signature(text: str) -> str:
    pieces = re.findall(r"[^\x20\x09-\x0D]{1,16}", text)
    low = (1 << omh.POSITION_BITS) - 1
    count, kmers = {}, []
    for i in range(len(pieces)):
        h = _hash([("s", x) for x in pieces[i : i + omh.K]]) >> omh.POSITION_BITS
        o = count.get(h, 0)
        count[h] = o + 1
        kmers.append((_hash([(8, h), (4, o)]) >> omh.POSITION_BITS, i))
    out = ""
    for j in range(omh.COORDINATES):
        drawn = []
        for salt in range(j * omh.DRAWN, (j + 1) * omh.DRAWN):
            if kmers:
                m = min((_hash([(8, k), (4, salt)]) & ~low) | i for k, i in kmers)
                drawn.append((m & low, salt, m >> omh.POSITION_BITS))
        tuple_ = [(8, _hash([(4, s), (8, h)])) for _, s, h in sorted(drawn)]
        out += f"{_hash(tuple_) & 0xFFFFFFFF:08x}" if drawn else "00000000"
    return out


def near(a, b):
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, len(a), 8)) * 8 / len(a)


def expected(rows):
    order = sorted(rows)
    out = []
    for i, (d, text) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + nxt[:cut]
        a, b, c = signature(text), signature(edited), signature(nxt)
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, near(a, b), near(a, c)))
    return out


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(tuple(r) for r in omh.fingerprints(docs).collect())
    assert got == expected(rows)
    assert sum(r[5] for r in got) > 5 * sum(r[6] for r in got)


def test_edges(spark):
    rows = [r for r in edge_rows() if r[0] is not None and r[0] != 11]
    docs = edge_docs(spark).where("doc_id IS NOT NULL AND doc_id <> 11")
    assert sorted(tuple(r) for r in omh.fingerprints(docs).collect()) == expected([(r[0], r[1] or "") for r in rows])
    whole = omh.fingerprints(edge_docs(spark)).collect()
    assert len(whole) == len(edge_rows()) and sum(r["doc_id"] is None for r in whole) == 2
    assert omh.fingerprints(empty_docs(spark)).count() == 0


def test_a_lone_document_is_its_own_next(spark):
    (r,) = omh.fingerprints(spark.createDataFrame([(7, "a b c d")], "doc_id long, text string")).collect()
    assert r["near_next"] == 1.0


def test_repeats_and_order_matter():
    a = prose(1, 200).split()
    swapped = " ".join(a[100:] + a[:100])
    text = " ".join(a)
    assert near(signature(text), signature(text)) == 1
    assert near(signature(text), signature(swapped)) < 0.8  # a set of k-mers would hardly notice
    assert signature("x x x x x") != signature("x x x x")


def test_too_many_pieces_stop_the_job(spark, monkeypatch):
    monkeypatch.setattr(omh, "POSITION_BITS", 3)
    df = spark.createDataFrame([("a b c d e f g h",), ("a b c d e f g h i",)], "t string")
    assert df.limit(1).select(F.expr(omh.occurrence_kmers("t"))).collect()
    with pytest.raises(Exception, match="more pieces"):
        df.select(F.expr(omh.occurrence_kmers("t"))).collect()
