r"""Information-theoretic sanitisation of personal data.

Protected entities are the values that the base patterns find (e-mail, IP, card,
phone). A term - a run of letters - discloses an entity as far as the corpus makes
them go together. With counts over all documents,

    information of the entity     IC(e)   = log2(T / n(e))
    disclosed by a term           I(t; e) = log2(n(t, e) * T / (n(t) * n(e)))

and a term whose share I / IC reaches ``GENERALISE`` is replaced by a general
mark, from ``REMOVE`` on it is removed. n(t, e) counts documents with both t and e,
wherever they stand; a pair must occur in ``SUPPORT`` different texts, so single
documents and their exact copies are no evidence. A disclosing term is marked at
every place in every document of its entity. Terms of any length count.

Plan. One pass finds base spans and entities, one counts the documents of every term;
a task keeps its term counts over its batches and sends them at a bound, so the rows
grow with the text. A term can disclose an entity only if n(t) <= T^(1-g) n(e)^g with g =
``GENERALISE``, for n(t, e) is at most n(e). That drops common words before any
pair is formed: the documents of entities with ``SUPPORT`` texts give one row per
term (without the terms that are both above that bound for every entity and among the
``HOT`` most common ones, which are held as a list), which meet the exact n(t), and the
documents' entities, on the document. A document with many entities and terms is dealt
out to many keys on both sides. Pairs are counted by Spark, and the disclosing ones
find their places through a list of places of disclosing terms, joined by term and then
by document and entity. Bitmaps of fixed size (``BITS``) tell the tasks what may
matter; what comes through is joined exactly, so false positives cost rows but never
change a result. Texts are not shuffled.

Base patterns, leftmost and non-overlapping per kind; failing matches are dropped
without retry. They are written so that they take linear time.

Defined cases: null text is empty and has no span; rows that repeat count as
documents but not as different texts; rows are told apart by their place, so
equal ids do not matter; other columns are passed through by ``sanitised``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prepared, scratch
from .textops import batch_term_hashes, mix, term_hashes

SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95
BITS = 1 << 22
HOT = 1 << 14  # terms, the most common first, that tasks know by heart
DISTINCT = 1 << 20  # term counts that a task holds before it sends them
PRODUCT = 1 << 18  # pairs of entities and terms of a document under one key

#: Kinds in their order, and the marks that replace them.
KINDS = ("email", "ip", "card", "phone")
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalised": "[TERM]", "removed": ""}

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile("[A-Za-z\u0080-\U0010ffff]+")


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            start = at
            while start > end and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at:
                yield start, m.end()
                end = m.end()
        at = text.find("@", max(at + 1, end))


def _part_fits(x: str) -> bool:
    x = x.lstrip("0")
    return len(x) < 3 or len(x) == 3 and int(x) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` in code points, by start and then kind as listed."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_part_fits, m.groups()))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


def _entity(kind: str, value: str) -> int:
    value = value.lower() if kind in ("email", "ip") else "".join(c for c in value if c.isdigit())
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)


def terms_outside(text: str, spans: list) -> tuple[list, np.ndarray]:
    """Places ``(start, end)`` of the terms outside all spans of a text, and their hashes."""
    parts, at = [], 0
    for a, _, b in spans:  # spans may overlap
        a = max(a, at)
        if b > a:
            parts += [text[at:a], " " * (b - a)]
            at = b
    found = list(_TERM.finditer("".join([*parts, text[at:]])))
    h = term_hashes(" ".join(m.group() for m in found).encode("utf-8", "surrogatepass")).view(np.int64)
    return [m.span() for m in found], h


def _bitmap(keys: DataFrame, spark):
    """Broadcast of ``BITS`` flags of the column ``key``; at most BITS / 64 rows come to the driver, whatever the number of keys."""
    slot = f"pmod(key, {BITS})"
    bits = np.zeros(BITS // 64, dtype=np.int64)
    got = keys.selectExpr(f"{slot} div 64 AS w", f"shiftleft(1L, cast({slot} % 64 AS int)) AS bit").groupBy("w").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits[got["w"].to_numpy(int)] = got["bits"]
    return spark.sparkContext.broadcast(np.unpackbits(bits.view(np.uint8), bitorder="little"))


def _entities(text: str, spans: list) -> list[int]:
    return sorted({_entity(kind, text[a:b]) for a, kind, b in spans})


SPANS = "array<struct<start: int, kind: string, end: int>>"
NEAR = "array<struct<term: long, start: int, end: int>>"


def _rows(docs: DataFrame) -> DataFrame:
    return prepared(docs).select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                 F.xxhash64("text").alias("of"))


def find(docs: DataFrame, terms=None) -> DataFrame:
    """``row, doc_id, of, spans, entities, near``: base spans and their entities per row; ``of`` is a hash of the text.

    ``near`` has the places of the terms in the bitmap ``terms``, in texts with an entity.
    """

    def found(batches):
        row = TaskContext.get().partitionId() << 40
        seen = None if terms is None else terms.value.view(bool)
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            spans = [base_spans(t) for t in texts]
            entities = [_entities(t, s) for t, s in zip(texts, spans)]
            near: list[list] = [[] for _ in texts]
            for i, of in enumerate(entities if seen is not None else []):
                if of:
                    places, h = terms_outside(texts[i], spans[i])
                    near[i] = [(int(h[k]), *places[k]) for k in np.flatnonzero(seen[h % BITS])]
            yield pd.DataFrame({"row": np.arange(row, row + len(pdf)), "doc_id": pdf["doc_id"], "of": pdf["of"], "spans": spans,
                                "entities": entities, "near": near})
            row += len(pdf)

    return scratch(_rows(docs).mapInPandas(found, f"row long, doc_id string, of long, spans {SPANS}, entities array<long>, near {NEAR}"), "pii-found")


def _summed(term: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(term, return_inverse=True)
    return found, np.bincount(where, n, len(found)).astype(np.int64)


def term_documents(docs: DataFrame) -> DataFrame:
    """``term, n_term``: the number of rows of ``docs`` that contain each term, for all terms."""

    def counted(batches):
        held, size, known = [], 0, (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for pdf in batches:
            for _, _, h, at in batch_term_hashes(pdf["text"].tolist()):
                text = np.searchsorted(at, np.arange(len(h)), side="right")
                order = np.lexsort((text, h.view(np.int64)))
                h, text = h.view(np.int64)[order], text[order]
                held.append(h[np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])))] if len(h) else h)
                size += len(held[-1])
                if size >= DISTINCT:
                    known = _summed(np.concatenate([known[0], *held]), np.concatenate([known[1], np.ones(size, np.int64)]))
                    held, size = [], 0
                    if len(known[0]) >= DISTINCT:
                        yield pd.DataFrame({"term": known[0], "n": known[1]})
                        known = (known[0][:0], known[1][:0])
        known = _summed(np.concatenate([known[0], *held]), np.concatenate([known[1], np.ones(size, np.int64)]))
        if len(known[0]):
            yield pd.DataFrame({"term": known[0], "n": known[1]})

    found = prepared(docs).select(F.col("text").cast("string").alias("text")).mapInPandas(counted, "term long, n long")
    return scratch(found.groupBy("term").agg(F.sum("n").alias("n_term")), "pii-terms")


def _pairs(docs: DataFrame, entities: DataFrame, terms: DataFrame, most: float, generalise: float, total: int, support: int) -> DataFrame:
    """``entity, term, n_pair, texts, n_entity, n_term``: rows and different texts that hold both, for the pairs that can disclose.

    ``most`` is the greatest number of rows of a term that can disclose any of ``entities``.
    """
    spark = docs.sparkSession
    shared = _bitmap(entities.select(F.col("entity").alias("key")), spark)
    common = terms.where(F.col("n_term") > most).orderBy(F.desc("n_term"), "term").limit(HOT)
    common = spark.sparkContext.broadcast(np.sort(common.toPandas()["term"].to_numpy(np.int64)))

    def held(batches):
        row = TaskContext.get().partitionId() << 40
        seen, skipped = shared.value.view(bool), common.value
        for pdf in batches:
            for i, (text, of) in enumerate(zip(pdf["text"], pdf["of"])):
                spans = base_spans(text or "")
                known = np.array([e for e in _entities(text, spans) if seen[e % BITS]] if spans else [], dtype=np.int64)
                if len(known):
                    found = np.setdiff1d(terms_outside(text, spans)[1], skipped)
                    deals = 1 + len(known) * len(found) // PRODUCT
                    deal = np.arange(len(found)) % deals
                    for a in range(0, len(found), 1 << 17):
                        part = found[a : a + (1 << 17)]
                        yield pd.DataFrame({"row": row + i, "of": of, "deal": deal[a : a + (1 << 17)], "deals": deals, "term": part, "entity": pd.array([None] * len(part), dtype="Int64")})
                    yield pd.DataFrame({"row": row + i, "of": of, "deal": 0, "deals": deals, "term": 0, "entity": pd.array(known, dtype="Int64")})
            row += len(pdf)

    rows = scratch(_rows(docs).select("text", "of").mapInPandas(held, "row long, of long, deal long, deals long, term long, entity long"), "pii-held")
    of_term = rows.where("entity IS NULL").select("row", "deal", "term").join(terms.where(F.col("n_term").between(support, most)), "term")
    of_entity = rows.where("entity IS NOT NULL").join(entities, "entity").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)))
    both = of_entity.select("row", "of", "deal", "entity", "n_entity").join(of_term, ["row", "deal"])
    both = both.where(F.col("n_term") <= _bound(F.col("n_entity"), generalise, total))
    by_text = both.groupBy("entity", "term", "n_entity", "n_term", "of").agg(F.count(F.lit(1)).alias("n"))
    return by_text.groupBy("entity", "term", "n_entity", "n_term").agg(F.sum("n").alias("n_pair"), F.count(F.lit(1)).alias("texts"))


def _bound(n_entity, generalise: float, total: int):
    """Rows of a term above which it cannot disclose an entity of ``n_entity`` rows; one more for rounding."""
    return F.pow(F.lit(float(total)), F.lit(1 - generalise)) * F.pow(n_entity.cast("double"), F.lit(generalise)) + 1


def disclosing(docs: DataFrame, found: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``entity, term, share, action`` of the terms that disclose an entity beyond the threshold."""
    total = found.count()
    entities = found.select("of", F.explode("entities").alias("entity")).groupBy("entity", "of").agg(F.count(F.lit(1)).alias("n"))
    entities = entities.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= support)
    entities = scratch(entities.select("entity", "n_entity"), "pii-entities")
    # an entity of all rows carries no information; a bound below 1 share is that of the most common entity
    most = entities.select(F.max(_bound(F.col("n_entity"), min(generalise, 1.0), max(total, 1)))).first()[0] or 0.0
    pairs = _pairs(docs, entities, term_documents(docs), most, generalise, max(total, 1), support).where(F.col("texts") >= support)
    information = F.log2(F.lit(float(total)) / F.col("n_entity"))
    disclosed = F.log2(F.col("n_pair") * F.lit(float(total)) / (F.col("n_term") * F.col("n_entity")))
    both = pairs.withColumn("share", F.when(information > 0, disclosed / information).otherwise(F.lit(0.0)))
    return both.where(F.col("share") >= generalise).select(
        "entity", "term", "share", F.when(F.col("share") >= remove, "removed").otherwise("generalised").alias("action"))


def find_all(docs: DataFrame, **settings) -> DataFrame:
    """``row, doc_id, of, base, spans`` per row of ``docs``: base spans, and all spans by start, each ``start, kind, end``."""
    flagged = scratch(disclosing(docs, find(docs), **settings), "pii-flagged")
    found = find(docs, _bitmap(flagged.select(F.col("term").alias("key")).distinct(), docs.sparkSession))
    near = found.select("row", F.explode("near").alias("x")).select("row", "x.term", "x.start", "x.end").join(flagged, "term")
    holds = found.select("row", F.explode("entities").alias("entity"))
    # one mark per place: removal wins
    marks = near.join(holds, ["row", "entity"], "left_semi").groupBy("row", "start", "end").agg(F.max("action").alias("kind"))
    marks = marks.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("marks"))  # at most a text's own places
    out = found.drop("near", "entities").join(marks, "row", "left")
    order = F.create_map(*[F.lit(x) for i, k in enumerate((*KINDS, "generalised", "removed")) for x in (k, i)])
    every = F.concat("spans", F.coalesce("marks", F.array().cast(SPANS)))
    every = F.array_sort(F.transform(every, lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("place"), x["kind"].alias("kind"), x["end"].alias("end"))))
    return out.select("row", F.col("doc_id").cast("long").alias("doc_id"), "of", F.col("spans").alias("base"),
                      F.transform(every, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))).alias("spans"))


def joined(spans):
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """The contract's digest: counts per base kind, a hash of the base spans, and all spans."""
    out = find_all(docs)

    def of_kind(k):
        return lambda x: x["kind"] == k

    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def replaced(text: str, spans) -> str:
    """``text`` with its spans replaced by their marks; of overlapping spans the first (then longest) counts."""
    out, at = [], 0
    for start, kind, end in sorted(spans, key=lambda s: (s[0], -s[2])):
        if start >= at:
            out += [text[at:start], MARKS[kind]]
            at = end
        elif end > at:  # overlaps the mark before: swallow the rest
            at = end
    return "".join(out) + text[at:]


def sanitised(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in ``text``; null texts stay null."""
    marks = find_all(docs, **settings).where(F.size("spans") > 0).select("doc_id", "of", "spans").dropDuplicates(["doc_id", "of"])
    rows = docs.withColumn("__of", F.xxhash64("text"))
    both = rows.join(marks.withColumnsRenamed({"doc_id": "__id", "of": "__at", "spans": "__spans"}),
                     F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__at")), "left")

    @F.pandas_udf("string")
    def apply(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None or t is None else replaced(t, [(x["start"], x["kind"], x["end"]) for x in s]) for t, s in zip(text, spans)])

    clean = F.when(F.col("__spans").isNotNull(), apply(F.col("text").cast("string"), "__spans")).otherwise(F.col("text"))
    return both.select(*[(clean if c == "text" else F.col(c)).alias(c) for c in docs.columns])
