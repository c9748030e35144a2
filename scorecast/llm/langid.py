r"""Language ID by segmentation-marginalised unigrams over a fixed public vocabulary.

Each language has a probability for every piece of a public vocabulary. A word's
probability under a language sums over all its segmentations (``lattice``), and a
text's is the product over its words; the language with the largest one is
predicted and its share among all languages is the score.

Fit. Labelled rows are sampled by a hash of their key so that about
``per_language`` documents of each language are kept whatever the table's size
(this bounds the classifier's training rows; all words of those documents count); without
``per_language`` all labelled rows are read, as the pipeline does.
Their words are counted per language by Spark, and ``rounds`` EM steps, starting
from the vocabulary's own scores, turn them into piece probabilities; each step
is one distributed sum over the counted words.

Prediction reads texts only, whole, in one pass without a shuffle.

Words are maximal runs of letters, lower-cased. Defined cases: a null text or one
without a letter is ``und`` with score 0; with no labelled rows at all everything
is ``und``; ties go to the first language in code point order; rows are judged
one by one, so repeats and ties do not matter; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lattice import Pieces, in_chunks, reestimated, vocabulary_path
from .shared import prepared, scratch

PER_LANGUAGE = 1500
ROUNDS = 2
SMOOTHING = 0.02
LONG = 20  # words of a text that tells how texts differ
LEAST_DEVIATION = 0.02  # nats a byte
FAR = 5.0  # deviations
LEAST_BYTES = 100  # of a text's words: a shorter one has too few words to be far from the others
CHUNK = 8 << 20  # characters judged at once
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    words = _LETTERS.findall((text or "").lower())
    if words and not any(c.isalpha() for w in words[:64] for c in w) and not any(c.isalpha() for w in words for c in w):
        return []  # numerals such as vulgar fractions only
    return words


@dataclass
class LanguageModel:
    """Languages in code point order, and piece probabilities as a pieces x languages array."""

    languages: list[str]
    probabilities: np.ndarray
    path: str

    def judge(self, texts: list[str | None], usual: np.ndarray | None = None) -> tuple[list[str], list[float], list[float]]:
        """Names, scores and, with ``usual_text``'s numbers, how many deviations each text lies from its language's labelled ones."""
        number: dict[str, int] = {}
        ids, ends = [], []
        for t in texts:
            ids.extend([number.setdefault(w, len(number)) for w in letter_words(t)])
            ends.append(len(ids))
        names, scores, far = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        if not ids or not self.languages:
            return names, scores, far
        words = [w.encode("utf-8", "surrogatepass") for w in number]
        log_p = Pieces.at(self.path).log_probabilities(words, self.probabilities)
        size = np.concatenate(([0.0], np.cumsum(np.array([len(w) + 1.0 for w in words])[np.array(ids)])))
        total = np.vstack([np.zeros((1, log_p.shape[1])), np.cumsum(log_p[np.array(ids)], axis=0)])
        first = 0
        for i, end in enumerate(ends):
            if end > first:
                s = total[end] - total[first]
                best = int(np.argmax(s))
                names[i], scores[i] = self.languages[best], float(1.0 / np.exp(s - s[best]).sum())
                if usual is not None:
                    per_byte, of_word, of_text = usual[best]
                    b = size[end] - size[first]
                    if b >= LEAST_BYTES:
                        far[i] = float((s[best] - per_byte * b) / max(np.sqrt((end - first) * of_word**2 + (of_text * b) ** 2), 1e-9))
                first = end
        return names, scores, far


def fit(labelled: DataFrame, key: Column | None = None, path: str | None = None, per_language: int | None = PER_LANGUAGE,
        rounds: int = ROUNDS, seed: int = 13) -> LanguageModel:
    """Fit from ``text, lang`` rows; ``key`` is what the sampling hashes (the text by default)."""
    path = path or vocabulary_path()
    languages, kept = _sampled(labelled, key, per_language, seed)
    if not languages:
        return LanguageModel([], np.zeros((len(Pieces.at(path)), 0)), path)

    def counted(batches):
        for pdf in batches:
            count: dict[int, Counter] = {}
            for text, model in zip(pdf["text"], pdf["model"]):
                count.setdefault(model, Counter()).update(letter_words(text))
            yield pd.DataFrame([(m, w, n) for m, c in count.items() for w, n in c.items()], columns=["model", "word", "n"])

    words = kept.mapInPandas(counted, "model int, word string, n long").groupBy("model", "word").agg(F.sum("n").alias("n"))
    words = scratch(words, "langid-words")
    pieces = Pieces.at(path)
    p = np.repeat(pieces.start()[:, None], len(languages), axis=1)
    for _ in range(rounds):
        p = _em_step(words, p, path, SMOOTHING)
    return LanguageModel(languages, p, path)


def _sampled(labelled: DataFrame, key: Column | None, per_language: int | None, seed: int) -> tuple[list[str], DataFrame | None]:
    """The labels, and ``text, model`` of the rows that the fit reads."""
    rows = prepared(labelled).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
                                     F.xxhash64(F.col("text") if key is None else key, F.lit(seed)).alias("of"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    known = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    languages = sorted(known)
    if not languages:
        return [], None
    if per_language is None:
        per_language = max(known.values())
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / known[lang]))])
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
    return languages, rows.where((F.shiftrightunsigned("of", 1) / float(1 << 63)) <= share[F.col("lang")]).select("text", number[F.col("lang")].alias("model"))


def usual_text(labelled: DataFrame, model: LanguageModel, key: Column | None = None, per_language: int | None = None, seed: int = 13) -> np.ndarray:
    """Per language, from all labelled rows (from the fit's sample of ``per_language``, if given): log-probability per byte, and its deviations by word and by text (per byte).

    The deviation by text is taken over texts of ``LONG`` words or more; languages without
    two such texts take the largest of the others, or ``LEAST_DEVIATION``.
    """
    _, kept = _sampled(labelled, key, per_language, seed)
    shared = kept.sparkSession.sparkContext.broadcast(model)

    def measured(batches):
        for pdf in batches:
            out = []
            for of, part in pdf.groupby("model"):
                number: dict[str, int] = {}
                texts = [np.array([number.setdefault(w, len(number)) for w in letter_words(t)], dtype=int) for t in part["text"]]
                if not number:
                    continue
                words = [w.encode("utf-8", "surrogatepass") for w in number]
                x = Pieces.at(shared.value.path).log_probabilities(words, shared.value.probabilities[:, [of]])[:, 0]
                b = np.array([len(w) + 1.0 for w in words])
                for t in texts:
                    if len(t):
                        each = x[t].sum() / b[t].sum() if len(t) >= LONG else None
                        out.append((of, len(t), x[t].sum(), b[t].sum(), (x[t] ** 2).sum(), (x[t] * b[t]).sum(), (b[t] ** 2).sum(), each))
            yield pd.DataFrame(out, columns=["model", "n", "x", "b", "xx", "xb", "bb", "each"])

    rows = kept.mapInPandas(measured, "model int, n long, x double, b double, xx double, xb double, bb double, each double")
    sums = rows.groupBy("model").agg(*[F.sum(c).alias(c) for c in ("n", "x", "b", "xx", "xb", "bb")], F.stddev_samp("each").alias("by_text")).toPandas()
    out = np.full((len(model.languages), 3), np.nan)
    for r in sums.itertuples():
        mean = r.x / r.b
        out[r.model] = mean, np.sqrt(max(0.0, (r.xx - 2 * mean * r.xb + mean**2 * r.bb) / r.n)), np.nan if r.by_text is None else r.by_text
    known = out[~np.isnan(out[:, 2]), 2]
    out[np.isnan(out[:, 2]), 2] = known.max() if len(known) else LEAST_DEVIATION
    out[:, 2] = np.maximum(out[:, 2], LEAST_DEVIATION)
    return np.nan_to_num(out)


def _em_step(words: DataFrame, p: np.ndarray, path: str, smoothing: float) -> np.ndarray:
    """One EM step over counted words ``model, word, n``; returns at most pieces x models sums to the driver."""

    def expected(batches):
        for pdf in in_chunks(batches):
            for model, part in pdf.groupby("model"):
                e = Pieces.at(path).expected_counts([w.encode("utf-8", "surrogatepass") for w in part["word"]], part["n"].to_numpy(float), p[:, model])
                used = np.flatnonzero(e)
                yield pd.DataFrame({"model": model, "piece": used, "e": e[used]})

    sums = words.mapInPandas(expected, "model int, piece int, e double").groupBy("model", "piece").agg(F.sum("e").alias("e")).toPandas()
    out = np.zeros_like(p)
    out[sums["piece"].to_numpy(int), sums["model"].to_numpy(int)] = sums["e"]
    return np.stack([reestimated(out[:, m], smoothing) for m in range(p.shape[1])], axis=1)


def predict(docs: DataFrame, model: LanguageModel, drop_text: bool = True, usual: np.ndarray | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, and with ``usual_text``'s numbers ``far``; other columns pass through as Arrow columns, unchanged."""
    keep = [c for c in docs.columns if not (drop_text and c == "text")]
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    schema = schema if usual is None else schema.add("far", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages numbers

    def judged(batches):
        for batch in batches:
            texts, at, names, scores, far = batch.column("text").to_pylist(), 0, [], [], []
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= CHUNK):
                    size += len(texts[end] or "")
                    end += 1
                got = shared.value.judge(texts[at:end], usual)
                names += got[0]
                scores += got[1]
                far += got[2]
                at = end
            arrays = [batch.column(c) for c in keep] + [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays[: len(schema)], schema.names)

    return prepared(docs).mapInArrow(judged, schema)


def accepted(pred: Column, score: Column, far: Column, least: float = 0.3, farthest: float = FAR) -> Column:
    """What the pipeline keeps: a language was found, it holds at least ``least`` of the probability, and the text is
    not ``farthest`` deviations less probable per byte than the language's labelled texts (from ``LEAST_BYTES`` on)."""
    return (pred != UNKNOWN) & (score >= least) & (far >= -farthest)
