"""Small numpy helpers used inside tasks: ASCII word splitting and word hashing.

Words are maximal runs of bytes outside ``{0x20, 0x09..0x0D}`` of the UTF-8
text, which is what ``[^\\x20\\x09-\\x0D]+`` matches on code points.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
BLOCK = 1 << 20  # bytes hashed at once: bounds the temporaries, not the text

_MULT = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_NO_LETTER = np.ones(256, dtype=bool)  # ASCII letters and all bytes of other characters make terms
_NO_LETTER[0x41:0x5B] = _NO_LETTER[0x61:0x7B] = _NO_LETTER[0x80:] = False
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(0, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output."""
    with np.errstate(over="ignore"):
        x = x.astype(U64, copy=True)
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


def _powers(n: int, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """r^0..r^n and their inverses modulo 2^64, kept for the worker's life."""
    if cache.get("n", -1) < n:
        n = max(n, 4096)
        inv = pow(_MULT, -1, 1 << 64)
        with np.errstate(over="ignore"):
            up = np.full(n + 1, U64(_MULT), dtype=U64)
            down = np.full(n + 1, U64(inv), dtype=U64)
            up[0] = down[0] = U64(1)
            cache.update(n=n, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down))
    return cache["up"], cache["down"]


_CACHE: dict = {}


def _hash_block(raw: bytes, lower: bool, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    b = np.frombuffer(raw.lower() if lower else raw, dtype=np.uint8)
    inside = ~space[b]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(b), _CACHE)
    with np.errstate(over="ignore"):
        total = np.empty(len(b) + 1, dtype=U64)
        total[0] = 0
        np.cumsum(_BYTE[b] * up[: len(b)], out=total[1:])
        h = (total[end] - total[start]) * down[start] + (end - start).astype(U64)
    return mix(h), start


def word_hashes(raw: bytes, lower: bool = False, space: np.ndarray = _SPACE) -> np.ndarray:
    """One 64-bit hash per word of ``raw``; equal words give equal hashes wherever they stand."""
    if len(raw) <= BLOCK:
        return _hash_block(raw, lower, space)[0]
    parts, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + BLOCK)
        while end < len(raw) and not space[raw[end]]:  # never cut a word
            end += 1
        parts.append(_hash_block(raw[at:end], lower, space)[0])
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, dtype=U64)


def term_hashes(raw: bytes) -> np.ndarray:
    """Hashes of the terms (letter runs) of ``raw``, ASCII lower-cased."""
    return word_hashes(raw, True, _NO_LETTER)


def batch_term_hashes(texts: list[str | None]):
    """``batch_word_hashes`` for terms."""
    return batch_word_hashes(texts, True, _NO_LETTER)


def batch_word_hashes(texts: list[str | None], lower: bool = False, space: np.ndarray = _SPACE):
    """Yield ``(first, last, hashes, offsets)`` for runs of texts.

    Runs hold about ``BLOCK`` bytes (one text may be larger), so memory is
    bounded by the longest text; ``offsets[i]:offsets[i + 1]`` are the words
    of text ``first + i``. Null texts have no words.
    """
    first, pending = 0, None
    while first < len(texts):
        raw, size = [], 0
        while first + len(raw) < len(texts):
            new = pending if pending is not None else (texts[first + len(raw)] or "").encode("utf-8", "surrogatepass")
            pending = None
            if raw and size + len(new) + 1 > BLOCK:
                pending = new
                break
            size += len(new) + 1
            raw.append(new)
        last = first + len(raw)
        if len(raw) == 1:
            h = word_hashes(raw[0], lower, space)
            yield first, last, h, np.array([0, len(h)])
        else:
            h, start = _hash_block(b"\n".join(raw), lower, space)
            edges = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
            yield first, last, h, np.searchsorted(start, edges)
        first = last


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words (none if there are fewer)."""
    if len(words) < n:
        return np.zeros(0, dtype=U64)
    with np.errstate(over="ignore"):
        out = words[: len(words) - n + 1].copy()
        for i in range(1, n):
            out = out * U64(0xD6E8FEB86659FD93) + words[i : len(words) - n + 1 + i]
            out ^= out >> U64(32)
    return mix(out)


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()
