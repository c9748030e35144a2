"""Order MinHash fingerprints, in DataFrame expressions only.

A text is a sequence of pieces: white-space separated words, cut after ``PIECE``
characters. Its k-mers are ``K`` consecutive pieces (fewer at the end), each
numbered by how often it has occurred before, so that repeats count. For every
one of ``COORDINATES`` signature places the ``DRAWN`` k-mers that are minimal
under that place's salted hash orders are selected, put back into text order,
and hashed as a tuple: swapping passages changes tuples, editing a part leaves
those that lie elsewhere. The likeness of two fingerprints is the share of equal
places.

Occurrence numbers come from sorting a text's packed (hash, position) longs and
numbering each run, which is linear after the sort; then k-mers are exploded to
plain longs and the minima are ``min`` aggregates in generated code. Nothing is
collected per text beyond its own arrays.

``next`` follows ascending ``doc_id``: ids are range-partitioned (ids only), led
within partitions, and partition ends are joined to the following partition's
first. Texts are shuffled once, by document; the start of the next text, at most
a quarter of its predecessor's length, joins that same shuffle.

Defined cases: null text is empty; texts without a piece share one fingerprint;
rows with equal ``doc_id`` and different text are ordered by a hash of the text,
equal rows are one document and are returned once each; null ``doc_id`` comes
first; a lone document is its own next; a text of more than ``2^POSITION_BITS`` pieces stops
the job with an error; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import scratch

PIECE = 16
K = 3
COORDINATES = 16
DRAWN = 2
POSITION_BITS = 26
NO_ID = -(1 << 63)
_LOW = (1 << POSITION_BITS) - 1


def _let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and names it inside ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def occurrence_kmers(text: str) -> str:
    """SQL: array of longs, one per k-mer of the text: hash of (k-mer, occurrence) in the high bits, position in the low."""
    pieces = rf"regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]{{1,{PIECE}}}', 0)"
    kmer = ", ".join(f"get(w, i + {j})" for j in range(1, K))
    packed = f"transform(w, (x, i) -> (xxhash64(x, {kmer}) & {~_LOW}L) | i)"
    first = f"filter(sequence(0, size(s) - 1), i -> i = 0 OR shiftright(s[i], {POSITION_BITS}) <> shiftright(s[i - 1], {POSITION_BITS}))"
    numbered = (f"flatten(transform(f, (a, r) -> transform(slice(s, a + 1, coalesce(get(f, r + 1), size(s)) - a), "
                f"(e, o) -> (xxhash64(shiftright(e, {POSITION_BITS}), o) & {~_LOW}L) | (e & {_LOW}L))))")
    some = _let("s", f"array_sort({packed})", _let("f", first, numbered))
    # positions have POSITION_BITS bits: a longer text must not pass with positions that run into the hash
    fits = f"if(size(w) > {1 << POSITION_BITS}, raise_error('a text has more pieces than positions can number'), {some})"
    return _let("w", pieces, f"if(size(w) = 0, cast(array() AS array<bigint>), {fits})")


def signatures(df: DataFrame, keys: list[str], kmers: str) -> DataFrame:
    """``keys, fingerprint``: one signature per key group of a column of ``occurrence_kmers`` arrays."""
    rows = df.select(*keys, F.explode_outer(kmers).alias("y"))
    order = [f"min((xxhash64(shiftright(y, {POSITION_BITS}), {salt}) & {~_LOW}L) | (y & {_LOW}L)) AS m{salt}"
             for salt in range(COORDINATES * DRAWN)]
    least = rows.groupBy(*keys).agg(*[F.expr(x) for x in order])
    places = []
    for j in range(COORDINATES):
        drawn = [f"struct(m{s} & {_LOW}L AS at, {s} AS salt, shiftright(m{s}, {POSITION_BITS}) AS h)" for s in range(j * DRAWN, (j + 1) * DRAWN)]
        in_order = f"transform(array_sort(array({', '.join(drawn)})), x -> xxhash64(x.salt, x.h))"
        places.append(f"if(m{j * DRAWN} IS NULL, '00000000', lpad(hex(xxhash64({in_order}) & 4294967295L), 8, '0'))")
    return least.select(*keys, F.lower(F.expr(f"concat({', '.join(places)})")).alias("fingerprint"))


def likeness(a: str, b: str):
    """Share of equal places of two fingerprints."""
    same = [F.substring(a, 8 * j + 1, 8).eqNullSafe(F.substring(b, 8 * j + 1, 8)).cast("int") for j in range(COORDINATES)]
    total = same[0]
    for s in same[1:]:
        total = total + s
    return total / F.lit(float(COORDINATES))


def with_next(ids: DataFrame) -> DataFrame:
    """``id, th, next_id, next_th`` for distinct ``(id, th)`` in ascending order, the first after the last."""
    placed = scratch(ids.repartitionByRange("id", "th").withColumn("part", F.spark_partition_id()), "omh-order")
    here = F.struct("id", "th")
    led = placed.select("id", "th", "part", F.lead(here).over(W.partitionBy("part").orderBy("id", "th")).alias("next"))
    # one row per partition
    firsts = placed.groupBy("part").agg(F.min(here).alias("first"))
    in_order = W.orderBy("part")
    firsts = firsts.select("part", F.coalesce(F.lead("first").over(in_order), F.first("first").over(in_order)).alias("beyond"))
    nxt = F.coalesce("next", "beyond")
    return led.join(firsts, "part").select("id", "th", nxt.getField("id").alias("next_id"), nxt.getField("th").alias("next_th"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    sizes = docs.groupBy("id", "th").agg(F.max(F.char_length("text")).cast("long").alias("n_chars"), F.count(F.lit(1)).alias("rows"))
    sizes = scratch(sizes, "omh-sizes")
    order = scratch(with_next(sizes.select("id", "th")), "omh-next")
    cut = F.floor(F.col("n_chars") / 4)
    heads = order.join(sizes, ["id", "th"]).select("id", "th", "next_id", "next_th", "n_chars", "rows", cut.cast("int").alias("cut"))
    texts = docs.dropDuplicates(["id", "th"]) if sizes.where("rows > 1").head(1) else docs
    # both joins read the same columns by the same key, so that the texts are shuffled once and reused
    texts = texts.select("id", "th", "text")
    heads = heads.withColumnsRenamed({"id": "of_id", "th": "of_th"}).join(
        texts, (F.col("next_id") == F.col("id")) & (F.col("next_th") == F.col("th")))
    heads = heads.select("of_id", "of_th", "n_chars", "cut", F.expr("substring(text, 1, cut)").alias("head"))
    both = heads.join(texts, (F.col("of_id") == texts["id"]) & (F.col("of_th") == texts["th"]))
    both = both.withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars - cut AS int)), head)"))
    both = both.select("id", "th", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       F.explode(F.expr("array(struct(0 AS side, text AS t), struct(1 AS side, edited AS t))")).alias("x"))
    keys = ["id", "th", "n_chars", "edited_sha256", "side"]
    kmers = both.select("id", "th", "n_chars", "edited_sha256", F.col("x.side").alias("side"), F.expr(occurrence_kmers("x.t")).alias("kmers"))
    sides = signatures(kmers, keys, "kmers")
    one = sides.groupBy(*keys[:4]).agg(F.max(F.when(F.col("side") == 0, F.col("fingerprint"))).alias("fingerprint"),
                                       F.max(F.when(F.col("side") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    one = scratch(one, "omh-signatures")
    nxt = one.select(F.col("id").alias("next_id"), F.col("th").alias("next_th"), F.col("fingerprint").alias("next_fingerprint"))
    out = one.join(order, ["id", "th"]).join(nxt, ["next_id", "next_th"]).join(sizes.select("id", "th", "rows"), ["id", "th"])
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                      likeness("fingerprint", "next_fingerprint").alias("near_next"))
