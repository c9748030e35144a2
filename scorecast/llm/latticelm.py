r"""Document probability by subword lattices over the pieces of a public vocabulary.

A text is its words and one end token. A word's lattice has the pieces of a
public vocabulary as arcs (a byte-pair file, whose ranks stand for unigram scores to
start from), and one arc for the whole word if it occurs in the training documents; its probability is the sum over all paths:

    P(word) = max(c - DISCOUNT, 0) / N  +  DISCOUNT * V / N * sum over segmentations of product of p(piece)

with c, N and V the training counts of the word, of all tokens and of distinct
tokens. Piece weights p start from the vocabulary's own scores and are
re-estimated on the training documents by ``rounds`` EM steps over their distinct
words. The end token has its discounted share of the training tokens.

Nothing is capped. All words of all documents are counted by Spark, after
counting within batches. The most frequent words, ``FREQUENT`` at most, go to the
tasks as a broadcast table; every other word of a document is joined by the word
itself. Such a word cannot be hot (with all more frequent ones it would need more
than one in ``FREQUENT / 2`` of all tokens), so that join has no heavy key, and
together the two paths score every token.

Words are ``[^\x20\x09-\x0D]+`` of the text with A-Z in lower case. Defined
cases: a null or empty text has the end token only; without training rows pieces
keep the vocabulary's own weights and a text ends after each word with even odds; rows that share a ``doc_id`` are
scored each by its own text; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lattice import Pieces, in_chunks, reestimated, vocabulary_path
from .shared import prepared, scratch
from .textops import words_of

FREQUENT = 1 << 17
ROUNDS = 3
SMOOTHING = 0.05
DISCOUNT = 0.75
DISTINCT = 250_000  # words counted in a batch before they are sent


def _text(w: bytes) -> str:
    return w.decode("utf-8", "surrogatepass")


def count_words(docs: DataFrame) -> DataFrame:
    """``word, c, n``: occurrences in training documents and in all, from ``text, training`` rows."""

    def counted(batches):
        c: Counter = Counter()
        n: Counter = Counter()

        def sent():
            return pd.DataFrame([(_text(w), c.get(w, 0), k) for w, k in n.items()], columns=["word", "c", "n"])

        for pdf in batches:
            for text, training in zip(pdf["text"], pdf["training"]):
                words = words_of(text, lower=True)
                n.update(words)
                if training:
                    c.update(words)
                if len(n) >= DISTINCT:
                    yield sent()
                    c, n = Counter(), Counter()
        if n:
            yield sent()

    return docs.mapInPandas(counted, "word string, c long, n long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def fit_pieces(words: DataFrame, path: str, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Piece probabilities by EM over counted training words; each round returns one sum per piece to the driver."""
    p = Pieces.at(path).start()
    for _ in range(rounds):
        def expected(batches, p=p):
            for pdf in in_chunks(batches):
                e = Pieces.at(path).expected_counts([w.encode("utf-8", "surrogatepass") for w in pdf["word"]], pdf["c"].to_numpy(float), p)
                used = np.flatnonzero(e)
                yield pd.DataFrame({"piece": used, "e": e[used]})

        sums = words.where("c > 0").mapInPandas(expected, "piece int, e double").groupBy("piece").agg(F.sum("e").alias("e")).toPandas()
        if not len(sums):
            return p
        e = np.zeros(len(p))
        e[sums["piece"].to_numpy(int)] = sums["e"]
        p = reestimated(e, smoothing)
    return p


def _least_count(words: DataFrame, frequent: int) -> float:
    """The least count that at most ``frequent`` words reach, to an eighth of a binary order."""
    order = F.floor(8 * F.log2("n"))
    kinds = {r[0]: r[1] for r in words.groupBy(order).count().collect()}  # at most 8 * 63 rows
    total = 0
    for k in sorted(kinds, reverse=True):
        total += kinds[k]
        if total > frequent:
            return 2 ** ((k + 1) / 8)
    return 0.0


def score(docs: DataFrame, training, path: str | None = None, rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, training, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``.

    ``training`` is the condition that picks the training rows. ``score`` is the
    model's log10 probability; ``base_score`` the add-one unigram word model's.
    """
    path = path or vocabulary_path()
    spark = docs.sparkSession
    docs = prepared(docs).select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                 F.coalesce(training, F.lit(False)).alias("training"))
    words = scratch(count_words(docs), "lm-words")
    ends = docs.where("training").count()
    known = words.where("c > 0").agg(F.sum("c"), F.count(F.lit(1))).first()
    tokens = (known[0] or 0) + ends
    kinds = known[1] + (1 if ends else 0)
    p = fit_pieces(words, path, rounds)
    rest = DISCOUNT * kinds / tokens if tokens else 0.5  # what the discount leaves to the pieces
    stop = (ends - DISCOUNT) / tokens if tokens else 0.5

    def weighed(batches):
        for pdf in in_chunks(batches):
            lp = Pieces.at(path).log_probabilities([w.encode("utf-8", "surrogatepass") for w in pdf["word"]], p[:, None])[:, 0]
            whole = np.maximum(pdf["c"].to_numpy(float) - DISCOUNT, 0.0) / max(tokens, 1)
            with np.errstate(divide="ignore"):  # in the log domain: a long word's lattice is far below the smallest double
                lp = np.logaddexp(np.log(whole), np.log(rest) + lp)
            yield pd.DataFrame({"word": pdf["word"], "n": pdf["n"], "known": (pdf["c"] > 0).astype("int64"),
                                "base": np.log10((pdf["c"] + 1.0) / (tokens + kinds + 1.0)), "lp": lp / np.log(10.0)})

    weighed_words = scratch(words.mapInPandas(weighed, "word string, n long, known long, base double, lp double"), "lm-weights")
    top = weighed_words.where(F.col("n") >= _least_count(words, frequent)).toArrow()
    numbers = {w.encode("utf-8", "surrogatepass"): i for i, w in enumerate(top.column("word").to_pylist())}
    weights = np.stack([top.column(c).to_numpy().astype(float) for c in ("known", "base", "lp")], axis=1)
    table = spark.sparkContext.broadcast((numbers, weights))
    end = (1 if ends else 0, float(np.log10((ends + 1.0) / (tokens + kinds + 1.0))), float(np.log10(stop)))

    def scored(batches):
        numbers, weights = table.value
        row = TaskContext.get().partitionId() << 40
        for pdf in batches:
            rows = []
            for doc, text, is_training in zip(pdf["doc_id"], pdf["text"], pdf["training"]):
                all_words = words_of(text, lower=True)
                got = [numbers.get(w, -1) for w in all_words]
                ids = np.array(got, dtype=np.int64)
                sums = weights[ids[ids >= 0]].sum(axis=0) + end
                # a blank cannot stand in a word, so this key meets no word and spreads the rows
                rows.append((row, doc, is_training, len(got) + 1, int(sums[0]), sums[1], sums[2], f" {row}", 1))
                if (ids < 0).any():
                    rare = Counter(w for w, i in zip(all_words, got) if i < 0)
                    rows.extend((row, doc, is_training, 0, 0, 0.0, 0.0, _text(w), n) for w, n in rare.items())
                row += 1
                if len(rows) >= DISTINCT:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    schema = "row long, doc_id string, training boolean, n_tokens long, n_known long, base_score double, score double, word string, times long"
    columns = [x.split()[0] for x in schema.split(", ")]
    parts = docs.mapInPandas(scored, schema)
    rare = weighed_words.select("word", "known", "base", "lp")
    joined = parts.join(rare, "word", "left")

    def total(own: str, of_word: str):
        return F.sum(F.col(own) + F.coalesce(F.col("times") * F.col(of_word), F.lit(0)))

    out = joined.groupBy("row", "doc_id", "training").agg(
        F.sum("n_tokens").alias("n_tokens"), total("n_known", "known").alias("n_known"),
        total("base_score", "base").alias("base_score"), total("score", "lp").alias("score"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "training", "n_tokens", "n_known",
                      F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
