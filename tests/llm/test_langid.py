"""Language ID: sums over all segmentations, held-out accuracy, defined edge cases."""

import itertools
import math

import numpy as np
from conftest import SF_MID
from edge import edge_docs, empty_docs

import __spark_entry__ as entry
from scorecast.llm import langid
from scorecast.llm.lattice import LONGEST_PIECE, MARK, Pieces, vocabulary_path


def all_segmentations(word: bytes, p: dict) -> float:
    n, total = len(word), 0.0
    for cuts in itertools.product((0, 1), repeat=n - 1):
        parts, a = [], 0
        for i, c in enumerate((*cuts, 1), 1):
            if c:
                parts.append(word[a:i])
                a = i
        total += math.prod(p.get(x, 0.0) for x in parts)
    return total


def test_forward_sums_all_segmentations():
    pieces = Pieces.at(vocabulary_path())
    p = pieces.start()
    table = dict(zip(pieces.pieces, p))
    words = [b"the", b"handed", "né".encode(), b"", b"zq", b"inter", b"a\x01b"]
    got = np.exp(pieces.log_probabilities(words, np.stack([p, p[::-1]], axis=1))[:, 0])
    for w, x in zip(words, got):
        assert math.isclose(x, all_segmentations(MARK + w, table), rel_tol=1e-9)


def plain_forward(word: bytes, table: dict, longest: int) -> tuple[float, dict]:
    """Log probability and expected uses over all segmentations, in exact fractions of the given doubles."""
    from fractions import Fraction

    n = len(word)
    a, b = [Fraction(1)] + [Fraction(0)] * n, [Fraction(0)] * n + [Fraction(1)]
    arcs = [(i, j, word[i:j]) for j in range(1, n + 1) for i in range(max(0, j - longest), j) if word[i:j] in table]
    for i, j, x in arcs:
        a[j] += a[i] * Fraction(table[x])
    uses = {}
    for i, j, x in reversed(arcs):
        b[i] += b[j] * Fraction(table[x])
    for i, j, x in arcs:
        uses[x] = uses.get(x, 0) + a[i] * Fraction(table[x]) * b[j] / a[n]
    top = a[n].numerator.bit_length() - a[n].denominator.bit_length()
    return math.log(a[n] / Fraction(2) ** top) + top * math.log(2.0), {x: float(u) for x, u in uses.items()}


def test_no_piece_is_left_out_and_no_word_is_cut(monkeypatch):
    import sentencepiece

    from scorecast.llm import lattice

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path())
    file = {sp.id_to_piece(i).replace("▁", MARK.decode()).encode() for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))}
    pieces = Pieces.at(vocabulary_path())
    assert file <= set(pieces.pieces) and pieces.longest == max(map(len, file)) == LONGEST_PIECE
    monkeypatch.setattr(lattice, "BLOCK", 50)
    p = pieces.start()
    table = dict(zip(pieces.pieces, p))
    words = [b"international", "которые".encode(), b"organizations" * 3, b"https://example.org/" + b"information/" * 12, "中文которые".encode() * 9, b"a" * 127, b"a" * 128]
    got = pieces.log_probabilities(words, np.stack([p, p[::-1]], axis=1))[:, 0]
    for w, x in zip(words, got):
        want, uses = plain_forward(MARK + w, table, pieces.longest)
        assert math.isclose(x, want, rel_tol=1e-9)
        e = pieces.expected_counts([w], np.array([2.0]), p)
        assert {pieces.pieces[i] for i in np.flatnonzero(e)} == set(uses)
        assert all(math.isclose(e[pieces.pieces.index(x)], 2 * u, rel_tol=1e-8) for x, u in uses.items())


def test_long_words_do_not_underflow():
    pieces = Pieces.at(vocabulary_path())
    p = pieces.start()[:, None]
    one, many = pieces.log_probabilities([b"q" * 100, b"q" * 50_000], p)[:, 0]
    assert np.isfinite(many) and many < one < 0


def test_expected_counts_spell_the_words():
    pieces = Pieces.at(vocabulary_path())
    words, n = [b"handed", b"x" * 90, "né".encode()], np.array([3.0, 1.0, 2.0])
    e = pieces.expected_counts(words, n, pieces.start())
    lengths = np.array([len(x) for x in pieces.pieces])
    assert math.isclose((e * lengths).sum(), sum(k * (len(w) + 1) for k, w in zip(n, words)), rel_tol=1e-9)
    assert lengths.max() <= LONGEST_PIECE


def test_held_out_accuracy(spark):
    got = entry.queries()["op2_language_id"](spark, SF_MID)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]


def test_edges(spark):
    docs = edge_docs(spark)
    model = langid.fit(docs, key=docs["doc_id"])
    assert model.languages == ["en", "fr"]
    rows = langid.predict(docs.select("doc_id", "text"), model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] in (5, 6, 7, 8):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in ("en", "fr") and 0 < r["score"] <= 1
    assert 2**60 + 1 in {r["doc_id"] for r in rows}


def test_without_labels(spark):
    model = langid.fit(empty_docs(spark))
    assert model.languages == []
    assert {r["lang_pred"] for r in langid.predict(edge_docs(spark).select("doc_id", "text"), model).collect()} == {"und"}
    assert langid.predict(empty_docs(spark).select("doc_id", "text"), model).count() == 0


def test_numerals_are_no_letters():
    assert langid.letter_words("½ ²³ 12") == []
    assert langid.letter_words("Été, 5 fois_par") == ["été", "fois", "par"]


def test_all_labelled_rows_can_be_read(spark):
    """The pipeline's model and range come from every labelled row, not from a sample."""
    from pyspark.sql import functions as F


    rows = spark.createDataFrame([(i, f"word{i} text", "en") for i in range(3000)], "doc_id long, text string, lang string")
    assert langid._sampled(rows, F.col("doc_id"), None, 13)[1].count() == 3000
    assert langid._sampled(rows, F.col("doc_id"), 100, 13)[1].count() < 1000
