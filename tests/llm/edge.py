"""Small tables with the cases every operator must bear: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["score", "row", "kept", "size", "block", "key", "word", "copies", "sequence_id", "hashes", "near"]


def prose(seed: int, n: int, words: str = "abcdefgh") -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(words) for _ in range(r.randint(2, 7))) for _ in range(n))


def edge_rows() -> list[tuple]:
    base = prose(1, 120)
    near = base.replace(base.split()[60], "zzz", 1)
    long_text = prose(2, 40_000)
    return [
        (1, base, "en", "b", 5), (2, base, "en", "b", None), (3, near, None, "a", 5), (4, prose(3, 80), "fr", None, 5),
        (5, None, "fr", "a", None), (6, "", None, "", 0), (7, " \t\n ", "en", "b", 4), (8, "...!?", "en", "b", 5),
        (9, long_text, "fr", "a", len(long_text)), (10, "x" * 100_000, "en", "b", 100_000),
        (11, prose(4, 30) + " tail", "en", "b", 1), (11, prose(4, 30) + " tail", "en", "b", 1), (11, "another text under that id", "en", "a", 1),
        (None, base, "en", "b", 1), (None, None, None, None, None),
        (2**60 + 1, "ünïcödé wörds 中文 Ω é", "fr", "\U0001f600", 3), (12, "one two three", "en", "b", 3), (13, "One TWO three", "en", "b", 3),
        (14, ("same line again and again here\n" * 50), "en", "b", 1),
    ]


def edge_docs(spark):
    """The rows with extra columns that clash with names the operators use."""
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
