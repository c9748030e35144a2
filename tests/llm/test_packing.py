"""Packing: exact round trip, optimal cuts, little padding, defined edge cases."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_MID
from edge import edge_docs, edge_rows, empty_docs

from scorecast.llm import packing as P


def reference_ids(text):
    tokenizer = P.ByteBpe.at(P.tokenizer_path()).exact
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def check(pieces, rows):
    ids = defaultdict(list)
    for d, text in rows:
        ids[d].append(reference_ids(text))
    seen = defaultdict(int)
    sequences = defaultdict(list)
    for p in pieces:
        options = [x for x in ids[p["doc_id"]] if len(x) == p["doc_tokens"] and zlib.crc32(x[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"]]
        assert options, p
        seen[p["doc_id"]] += p["length"]
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert dict(seen) == {d: sum(map(len, x)) for d, x in ids.items()}
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= P.LENGTH
        lengths.append(at)
    return lengths


def test_round_trip_and_padding(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    lengths = check(P.pack(docs).collect(), [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()])
    assert P.padding(lengths).sum() < 0.01 * sum(lengths)
    assert len(lengths) < 1.1 * sum(lengths) / P.LENGTH


def test_edges(spark):
    check(P.pack(edge_docs(spark).repartition(3)).collect(), [(r[0], r[1]) for r in edge_rows()])
    assert P.pack(empty_docs(spark)).count() == 0


def test_ids_column_and_order(spark):
    docs = edge_docs(spark)
    rows = P.pack(docs, order_by="doc_id", with_ids=True).where("doc_id = 12").collect()
    assert [i for r in sorted(rows, key=lambda r: r["start"]) for i in r["ids"]] == reference_ids("one two three").tolist()


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_optimal(seed):
    r = np.random.default_rng(seed)
    length = 16
    n = int(r.integers(20, 120))
    ends = np.unique(np.append(r.integers(1, n, 4), n))
    ids = r.integers(0, 10, n)
    pos, pen = P.candidates(ids, ends, np.arange(10) < 2, length)
    cuts = P.best_cuts(pos, pen, length)
    penalty = dict(zip(pos.tolist(), pen.tolist()))

    def cost(cs):
        return sum(int(P.padding([b - a], length)[0]) + P.WINDOW + penalty[b] for a, b in zip(cs[:-1], cs[1:]))

    best = {0: 0}
    for p in pos[1:].tolist():
        best[p] = min(best[q] + cost([q, p]) for q in best if p - q <= length)
    assert cuts[0] == 0 and cuts[-1] == n and (np.diff(cuts) <= length).all()
    assert cost(cuts.tolist()) == best[n]


def test_fast_ids_equal_the_tokenizers():
    bpe = P.ByteBpe.at(P.tokenizer_path())
    for text in [r[1] or "" for r in edge_rows()] + ["don't I'LL ñandú 12²½ x  y\r\n\t z <|endoftext|>", "a b c"]:
        assert bpe.encode(text).tolist() == bpe.exact.encode(text, add_special_tokens=False).ids
