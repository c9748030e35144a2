"""Order-preserving packing of documents into token sequences by dynamic programming.

The token streams of a task's documents are laid end to end, in the order in
which the rows stand, and cut into windows of at most ``length`` tokens. The
cuts minimise

    sum over windows of  padding(window) + WINDOW + penalty(cut)   (WINDOW keeps short windows rare)

where a window is padded to ``length`` unless its length is a power of two, and
the penalty is 0 at a document's end, ``SENTENCE`` after a sentence or line and
``TRUNCATION`` anywhere else. Candidates are all document and sentence ends, plus
truncation points every ``length`` tokens from each document's start, for as long
as the document lasts and ``LOOKAHEAD`` windows beyond it.

With f(p) the least cost up to candidate p,

    f(p) = penalty(p) + WINDOW + min( min_{p - length <= q < p} (f(q) + q) + length - p,
                                      min_k f(p - 2^k) )

The first minimum is a sliding window's, kept in a monotone queue (each candidate
enters and leaves once); the second looks up at most eleven candidates. The whole
costs time in proportion to the candidates.

Each partition is packed on its own, in segments of about ``SEGMENT`` tokens,
which bounds memory; a segment ends at a document's end. Nothing is shuffled
(give ``order_by`` to range-sort the table first), so a lost task is simply
repeated. Sequence ids are the partition number and a running number in it.

Ids come from the tokenizer file itself: its vocabulary is the rank table of the
same byte-level BPE in ``tiktoken``, which is several times faster; texts with
characters outside Latin, Greek and Cyrillic go through ``tokenizers`` because
the two libraries may know different Unicode versions. Strings of special tokens
in a text are ordinary text.

Defined cases: a null or empty text is the single closing id; rows that share a
``doc_id`` are documents of their own; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections import deque

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prepared

LENGTH = 1024
CLOSING_ID = 0
SEGMENT = 1 << 20
LOOKAHEAD = 12
WINDOW, SENTENCE, TRUNCATION = 32, 1, 6

#: Fixed value: the splitting pattern of the byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_length long, ids array<int>")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ByteBpe:
    """Encoder of a byte-level BPE tokenizer file; ``sentence_end[id]`` marks ids that close a sentence or line."""

    _kept: dict[str, ByteBpe] = {}

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        # the printable stand-ins of the 256 bytes: printable Latin-1 stands for itself, the rest follows from 256
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        self.sentence_end = np.zeros(max(spec["model"]["vocab"].values()) + 1, dtype=bool)
        for piece, i in ranks.items():
            self.sentence_end[i] = piece.rstrip(b" \"')")[-1:] in (b".", b"!", b"?") or b"\n" in piece

    @classmethod
    def at(cls, path: str) -> ByteBpe:
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.uint32)
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        if raw.max() >= 0xD4:  # the lead byte of U+0500 and beyond
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.asarray(self.fast.encode_to_numpy(text), dtype=np.uint32)


def candidates(ids: np.ndarray, ends: np.ndarray, sentence_end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted candidate cuts and their penalties; ``ends`` are the documents' ends."""
    total = int(ends[-1])
    after = np.flatnonzero(sentence_end[ids]) + 1
    starts = np.concatenate(([0], ends[:-1]))
    reach = (ends - starts) // length + LOOKAHEAD
    steps = np.arange(1, reach.sum() + 1) - np.repeat(np.cumsum(reach) - reach, reach)
    chains = np.repeat(starts, reach) + steps * length
    pos = np.unique(np.concatenate(([0], after, chains[chains < total], ends)))
    penalty = np.full(len(pos), TRUNCATION)
    penalty[np.searchsorted(pos, after)] = SENTENCE
    penalty[np.searchsorted(pos, ends)] = 0
    return pos, penalty


def best_cuts(pos: np.ndarray, penalty: np.ndarray, length: int) -> np.ndarray:
    """The cheapest increasing sequence of candidates from the first to the last one."""
    n = len(pos)
    # candidates exactly a power of two earlier, listed by candidate
    at, src = [], []
    size = 1
    while size <= length:
        i = np.searchsorted(pos, pos - size)
        hit = np.flatnonzero((pos[np.minimum(i, n - 1)] == pos - size))
        at.append(hit)
        src.append(i[hit])
        size *= 2
    at, src = np.concatenate(at), np.concatenate(src)
    order = np.argsort(at, kind="stable")
    src = src[order].tolist()
    first = np.searchsorted(at[order], np.arange(n + 1)).tolist()
    p, pen = pos.tolist(), penalty.tolist()
    cost, back = [0] * n, [0] * n
    queue: deque = deque([(0, 0, 0)])  # (f(q) + q, q, index): values increase, so the head is the minimum
    for j in range(1, n):
        here = p[j]
        while queue[0][1] < here - length:
            queue.popleft()
        least, _, via = queue[0]
        least += length - here
        for i in src[first[j] : first[j + 1]]:
            if cost[i] < least:
                least, via = cost[i], i
        cost[j] = least = least + pen[j] + WINDOW
        back[j] = via
        least += here
        while queue and queue[-1][0] >= least:
            queue.pop()
        queue.append((least, here, j))
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return pos[np.array(cuts[::-1])]


def padding(lengths, length: int = LENGTH):
    """Padding of windows of these lengths: none at a power of two."""
    n = np.asarray(lengths)
    return np.where((n & (n - 1)) == 0, 0, length - n)


def _pieces(docs: list, ids: list[np.ndarray], sentence_end, length: int, first_sequence: int, with_ids: bool):
    ends = np.cumsum([len(x) for x in ids])
    stream = np.concatenate(ids)
    cuts = best_cuts(*candidates(stream, ends, sentence_end, length), length)
    starts = np.concatenate(([0], ends[:-1]))
    edges = np.union1d(cuts, ends)
    a, b = edges[:-1], edges[1:]
    doc = np.searchsorted(ends, a, side="right")
    window = np.searchsorted(cuts, a, side="right") - 1
    raw = stream.astype("<u4").tobytes()
    out = pd.DataFrame({
        "doc_id": pd.array([docs[d] for d in doc], dtype="Int64"), "start": a - starts[doc], "length": b - a,
        "ids_crc32": [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(a.tolist(), b.tolist())],
        "doc_tokens": (ends - starts)[doc], "sequence_id": first_sequence + window, "offset": a - cuts[window],
        "sequence_length": np.diff(cuts)[window]})
    out["ids"] = [stream[x:y].astype(np.int32) for x, y in zip(a, b)] if with_ids else None
    return out, len(cuts) - 1


def pack(docs: DataFrame, length: int = LENGTH, path: str | None = None, order_by: str | None = None,
         with_ids: bool = False) -> DataFrame:
    """One row per piece (a run of one document's ids in one sequence), ``PIECES``; ``ids`` is null unless asked for."""
    docs = prepared(docs)
    if order_by:
        docs = docs.repartitionByRange(order_by).sortWithinPartitions(order_by)
    # text ids keep nulls and large numbers apart from pandas' floats
    docs = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = path or tokenizer_path()
    closing = np.array([CLOSING_ID], dtype=np.uint32)

    def tasks(batches):
        bpe = ByteBpe.at(path)
        sequence = TaskContext.get().partitionId() << 32
        names, ids, size = [], [], 0
        for pdf in batches:
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                names.append(None if doc is None else int(doc))
                ids.append(np.concatenate((bpe.encode(text or ""), closing)))
                size += len(ids[-1])
                if size >= SEGMENT:
                    out, n = _pieces(names, ids, bpe.sentence_end, length, sequence, with_ids)
                    sequence += n
                    names, ids, size = [], [], 0
                    yield out
        if ids:
            yield _pieces(names, ids, bpe.sentence_end, length, sequence, with_ids)[0]

    return docs.mapInPandas(tasks, PIECES)
