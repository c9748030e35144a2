"""Unigram lattices over a fixed public piece vocabulary, for many words at once.

A word is spelled as the marker ``\\x01`` and its UTF-8 bytes; a segmentation is
any sequence of vocabulary pieces that spells it. Single bytes are always
pieces, so every word has one. The forward recursion

    a[0] = 1,   a[j] = sum over pieces w that end at j of  a[j - |w|] * p(w)

sums over all segmentations. Words of one length run through it together as
numpy rows, with as many columns of piece probabilities as there are models.
Each step carries a power-of-two exponent per row, which makes it a log-space
recursion that does not underflow on long words. Words of more than ``LONGEST``
bytes run through it one by one, in blocks of ``BLOCK`` positions of which only the
last columns are kept, so their memory is bounded; no word is cut and no piece of
the vocabulary is left out, whatever its length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd

from .textops import U64

MARK = b"\x01"
LONGEST = 128
LONGEST_PIECE = 25  # bytes of the public vocabulary's longest piece: sizes batches; ``Pieces.longest`` is of the one loaded
SHORT = 24
USUAL = 12  # longer pieces are few and looked up only behind one of their endings
ENDING = 8
BLOCK = 4096

_R = U64(0x9E3779B97F4A7C15 | 1)
_T = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 62, 256, dtype=np.int64).astype(U64)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Pieces of a sentencepiece vocabulary as bytes, with a lookup by hash."""

    _kept: dict[str, Pieces] = {}

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        score: dict[bytes, float] = {}
        lowest = -float(sp.get_piece_size())
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            if sp.is_byte(i):
                score.setdefault(bytes([int(sp.id_to_piece(i)[3:5], 16)]), lowest)
                continue
            raw = sp.id_to_piece(i).replace("▁", MARK.decode()).encode()
            score[raw] = max(lowest, sp.get_score(i))
        for b in range(256):
            score.setdefault(bytes([b]), lowest)
        self.pieces = sorted(score)
        self.scores = np.array([score[p] for p in self.pieces])
        keys = np.array([self._hash(p) for p in self.pieces], dtype=U64)
        order = np.argsort(keys)
        self.keys, self.index = keys[order], order.astype(np.int32)
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(keys >> U64(44)).astype(np.int64)] = True
        self.longest = max(map(len, self.pieces))
        self.endings = np.zeros(1 << 20, dtype=bool)
        self.endings[[self._hash(p[-ENDING:]) >> 44 for p in self.pieces if len(p) > USUAL]] = True
        with np.errstate(over="ignore"):
            self.power = np.multiply.accumulate(np.concatenate(([U64(1)], np.full(self.longest, _R))))

    @classmethod
    def at(cls, path: str) -> Pieces:
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    @staticmethod
    def _hash(raw: bytes) -> int:
        h = 0
        for b in raw:
            h = (h * int(_R) + int(_T[b])) & 0xFFFFFFFFFFFFFFFF
        return h

    def __len__(self) -> int:
        return len(self.pieces)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are pieces, and their piece numbers."""
        maybe = np.flatnonzero(self.seen[(h >> U64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == h[maybe]
        return maybe[hit], self.index[at[hit]]

    def start(self) -> np.ndarray:
        """Probabilities from the vocabulary's own scores: its scores are minus ranks, taken as a Zipf law."""
        p = 1.0 / (1.0 - (self.scores - self.scores.max()))
        return p / p.sum()

    # -- lattices -----------------------------------------------------------

    def _matrices(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(rows, bytes)`` by length, of words up to ``LONGEST`` bytes."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) < LONGEST:
                by_length.setdefault(len(w) + 1, []).append(i)
        for n, rows in by_length.items():
            step = max(1, (1 << 22) // (n * LONGEST_PIECE))  # bounds the piece numbers kept at once
            for a in range(0, len(rows), step):
                raw = np.frombuffer(b"".join(MARK + words[i] for i in rows[a : a + step]), dtype=np.uint8).reshape(-1, n)
                yield np.array(rows[a : a + step]), raw

    def _arcs(self, raw: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """By end position, ``(length, rows, piece numbers)`` of the pieces that end there."""
        w, n = raw.shape
        with np.errstate(over="ignore"):
            h = np.zeros((n + 1, w), dtype=U64)
            for j in range(n):
                h[j + 1] = h[j] * _R + _T[raw[:, j]]
            out: list = [[]]
            for j in range(1, n + 1):
                arcs = [(k, *self.find(h[j] - h[j - k] * self.power[k])) for k in range(1, min(j, USUAL) + 1)]
                if j > USUAL:
                    some = np.flatnonzero(self.endings[((h[j] - h[j - ENDING] * self.power[ENDING]) >> U64(44)).astype(np.int64)])
                    for k in range(USUAL + 1, min(j, self.longest) + 1 if len(some) else 0):
                        at, ids = self.find(h[j][some] - h[j - k][some] * self.power[k])
                        arcs.append((k, some[at], ids))
                out.append([x for x in arcs if len(x[1])])
        return out

    def _ends(self, word: bytes, first: int, last: int) -> list[list[tuple[int, int]]]:
        """``(start, piece number)`` of the pieces that end at each position from ``first`` to ``last`` of one word."""
        low = max(0, first - self.longest)
        part = _T[np.frombuffer(word, dtype=np.uint8)[low:last]]
        out: list = [[] for _ in range(first, last + 1)]
        with np.errstate(over="ignore"):
            h = np.zeros(len(part) + 1, dtype=U64)
            for j, x in enumerate(part.tolist()):
                h[j + 1] = (int(h[j]) * int(_R) + x) & 0xFFFFFFFFFFFFFFFF
            for k in range(1, min(last, self.longest) + 1):
                j = np.arange(max(first, k), last + 1)
                at, ids = self.find(h[j - low] - h[j - low - k] * self.power[k])
                for end, i in zip(j[at].tolist(), ids.tolist()):
                    out[end - first].append((end - k, i))
        return out

    def _forward(self, word: bytes, first: int, last: int, p: np.ndarray, a: dict, s: dict) -> list:
        """The recursion from ``first`` to ``last`` of one word: values ``a`` and exponents of two ``s`` by position, a number per model."""
        ends = self._ends(word, first, last)
        for j, arcs in enumerate(ends, first):
            scale = np.array([s[i] for i, _ in arcs])
            top = scale.max(axis=0)
            total = np.ldexp(np.array([a[i] for i, _ in arcs]) * p[[x for _, x in arcs]], (scale - top).astype(int)).sum(axis=0)
            a[j], e = np.frexp(total)
            s[j] = top + e
        return ends

    def _windows(self, word: bytes, p: np.ndarray) -> list[tuple[int, dict, dict]]:
        """``(position, a, s)`` at the starts of the blocks of one word and at its end, each with the columns that are still needed."""
        a, s = {0: np.ones(p.shape[1])}, {0: np.zeros(p.shape[1])}
        out = [(0, dict(a), dict(s))]
        for first in range(1, len(word) + 1, BLOCK):
            last = min(len(word), first + BLOCK - 1)
            self._forward(word, first, last, p, a, s)
            for i in [i for i in a if i <= last - self.longest]:
                del a[i], s[i]
            out.append((last, dict(a), dict(s)))
        return out

    def _expected_of(self, word: bytes, count: float, p: np.ndarray, out: np.ndarray) -> None:
        """Add the expected uses of one counted word to ``out``, block by block from its end."""
        windows = self._windows(word, p[:, None])
        n = len(word)
        whole, exponent = float(windows[-1][1][n][0]), int(windows[-1][2][n][0])
        b = {n: (1.0, 0)}  # values and exponents of two
        for (before, a, s), (last, _, _) in reversed(list(zip(windows, windows[1:]))):
            ends = self._forward(word, before + 1, last, p[:, None], a, s)
            for j in range(last, before, -1):
                value, scale = b.pop(j, (0.0, 0))
                if not value:
                    continue
                for i, x in ends[j - before - 1]:
                    used = value * float(p[x])
                    out[x] += count * math.ldexp(float(a[i][0]) * used / whole, int(s[i][0]) + scale - exponent)
                    was, at = b.get(i, (0.0, scale))
                    top = max(at, scale)
                    m, e = math.frexp(math.ldexp(was, at - top) + math.ldexp(used, scale - top))
                    b[i] = (m, top + e)

    def log_probabilities(self, words: list[bytes], p: np.ndarray) -> np.ndarray:
        """Natural log of the marginal probability of each word under each column of ``p`` (pieces x models)."""
        models = p.shape[1]
        out = np.zeros((len(words), models))
        for rows, raw in self._matrices(words):
            arcs = self._arcs(raw)
            n = raw.shape[1]
            a = [np.ones((len(rows), models))]
            exponent = np.zeros((len(rows), models))
            for j in range(1, n + 1):
                total = np.zeros((len(rows), models))
                for k, at, ids in arcs[j]:
                    total[at] += a[j - k][at] * p[ids]
                a.append(total)
                if j % 16 == 0 or j == n:  # keep the window near 1
                    _, e = np.frexp(total)
                    exponent += e
                    for i in range(max(0, j - self.longest + 1), j + 1):
                        a[i] = np.ldexp(a[i], -e)
                if j >= self.longest:
                    a[j - self.longest] = None  # no later piece starts there
            with np.errstate(divide="ignore"):
                out[rows] = np.log(a[n]) + exponent * math.log(2.0)
        for i, w in enumerate(words):
            if len(w) >= LONGEST:
                n, a, s = self._windows(MARK + w, p)[-1]
                with np.errstate(divide="ignore"):
                    out[i] = np.log(a[n]) + s[n] * math.log(2.0)
        return out

    def expected_counts(self, words: list[bytes], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of the counted words, under one model ``p``."""
        out = np.zeros(len(self))
        for rows, raw in self._matrices(words):
            arcs = self._arcs(raw)
            n, w = raw.shape[1], len(rows)
            if n <= SHORT:  # products of so few probabilities stay far above the smallest double
                a = [np.ones(w)]
                for j in range(1, n + 1):
                    a.append(np.zeros(w))
                    for k, at, ids in arcs[j]:
                        a[j][at] += a[j - k][at] * p[ids]
                b = [np.zeros(w) for _ in range(n)] + [counts[rows] / a[n]]
                every, share = [], []
                for j in range(n, 0, -1):
                    for k, at, ids in arcs[j]:
                        used = b[j][at] * p[ids]
                        b[j - k][at] += used
                        every.append(ids)
                        share.append(a[j - k][at] * used)
                out += np.bincount(np.concatenate(every), np.concatenate(share), len(self))
                continue
            a, sa = np.zeros((n + 1, w)), np.zeros((n + 1, w))  # values and exponents of two
            a[0] = 1.0
            for j in range(1, n + 1):
                top = np.full(w, -np.inf)
                for k, at, _ in arcs[j]:
                    top[at] = np.maximum(top[at], sa[j - k][at])
                for k, at, ids in arcs[j]:
                    a[j][at] += np.ldexp(a[j - k][at] * p[ids], (sa[j - k][at] - top[at]).astype(int))
                a[j], e = np.frexp(a[j])
                sa[j] = top + e
            b, sb = np.zeros((n + 1, w)), np.full((n + 1, w), -np.inf)
            b[n], sb[n] = 1.0, 0.0
            for j in range(n, 0, -1):
                for k, at, ids in arcs[j]:
                    value, scale, was = b[j][at] * p[ids], sb[j][at], sb[j - k][at]
                    both = np.maximum(was, scale)
                    with np.errstate(invalid="ignore"):
                        total = (np.ldexp(b[j - k][at], np.where(np.isneginf(was), 0, was - both).astype(int))
                                 + np.ldexp(value, np.where(np.isneginf(scale), 0, scale - both).astype(int)))
                    total, e = np.frexp(total)
                    b[j - k][at], sb[j - k][at] = total, both + e
                    with np.errstate(invalid="ignore", divide="ignore"):
                        share = a[j - k][at] * value / a[n][at] * np.exp2(sa[j - k][at] + scale - sa[n][at])
                    out += np.bincount(ids, np.nan_to_num(share * counts[rows[at]]), len(self))
        for w, c in zip(words, counts):
            if len(w) >= LONGEST:
                self._expected_of(MARK + w, float(c), p, out)
        return out


def in_chunks(batches, rows: int = 100_000):
    """Batches put together until they hold ``rows``: the lattices work on many words at once."""
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def reestimated(expected: np.ndarray, smoothing: float) -> np.ndarray:
    """Probabilities from expected counts, with ``smoothing`` added to every piece."""
    p = expected + smoothing
    return p / p.sum()
