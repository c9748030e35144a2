"""Mixing sources to target weights by pivotal dependent rounding.

Targets. Sources in code point order (null last) weigh 3, 1, 2, repeating, and
share ``total_share`` times the size of everything; a source takes at most
``max_copies`` times its own size and the excess is shared by weight among the
others. That water level is found in closed form with running sums over the
sources in the order of their cap per weight.

Rounding. A document of a source at rate r = target / size is taken floor(r)
times for sure and has the rest f = r - floor(r) as copy probability. A pivotal
step takes two documents with probabilities p and q strictly between 0 and 1 and
moves words between them: with the right odds either as many as p can take from
q or as many as q can take from p, until one of the two is 0 or 1. Expected
copies stay as they are and the words moved are conserved, so a source's words
follow its target exactly, however the coins fall.

Steps run in a reduction tree: documents meet in nodes of about ``NODE`` within
their source, every node passes its one undecided document up, and the level
above is formed by the nodes' numbers, until one document per source is left. A
hot source only has more nodes. Each level is a ``groupBy`` of bounded arrays
folded by ``aggregate``; no Python, and coins are hashes of the two documents
and a seed, so reruns agree.

The last undecided document of a source is taken in part: ``floor(p * size)``
words of it beyond its whole copies.

Words are counted in units of 1 / ``UNIT`` word, as integers, so nothing is lost
to rounding on the way.

Defined cases: null text has size 0 and nothing is taken of it; a null source is
a source of its own, the last; rows that repeat or share a ``doc_id`` are
documents of their own (numbered within equal texts of an id); an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import WORD, scratch

WEIGHTS = (3, 1, 2)
NODE = 256
UNIT = 1 << 16


def source_targets(sizes: DataFrame, weights=WEIGHTS, total_share: float = 1.5, max_copies: float = 2.0) -> DataFrame:
    """``source, source_size, docs, target`` from ``source, size`` rows.

    Source rows are few (one per source); their running sums go through one task.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    s = s.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1))
    s = s.withColumn("cap", max_copies * F.col("source_size"))
    by_level = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = W.partitionBy(F.lit(1))
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumns({
        "total": total_share * F.sum("source_size").over(everything),
        "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "free": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    # the level if exactly the sources before this one are capped; right for the first whose cap reaches it
    s = s.withColumn("level", F.when(F.col("cap") >= (F.col("total") - F.col("capped")) / F.col("free") * F.col("weight"),
                                     (F.col("total") - F.col("capped")) / F.col("free")))
    s = s.withColumn("level", F.first("level", ignorenulls=True).over(by_level.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return s.select("source", "source_size", "docs", target.alias("target"))


def _fold(level: int, seed: int) -> str:
    """SQL of the pivotal steps within one node: array<(key, s, x)> -> decided and the one undecided."""
    item = "struct<key: bigint, doc_id: bigint, of: bigint, row: int, s: bigint, x: bigint>"
    # a is the undecided one so far, b the next; up moves words from b to a, down from a to b
    step = f"""
      named_struct('done', acc.done, 'a', acc.a, 'b', b,
        'up', least(acc.a.s - acc.a.x, b.x), 'down', least(acc.a.x, b.s - b.x),
        'coin', (xxhash64(acc.a.key, b.key, {level}, {seed}) & 9007199254740991) / 9007199254740992D)"""
    # after the move exactly one of the two is 0 or full; it is done and the other goes on
    moved = """
      named_struct('done', t.done,
        'a', named_struct('key', t.a.key, 'doc_id', t.a.doc_id, 'of', t.a.of, 'row', t.a.row, 's', t.a.s, 'x', if(t.coin * (t.up + t.down) < t.down, t.a.x + t.up, t.a.x - t.down)),
        'b', named_struct('key', t.b.key, 'doc_id', t.b.doc_id, 'of', t.b.of, 'row', t.b.row, 's', t.b.s, 'x', if(t.coin * (t.up + t.down) < t.down, t.b.x - t.up, t.b.x + t.down)))"""
    out = """
      if(m.a.x = 0 OR m.a.x = m.a.s,
         named_struct('done', array_append(m.done, m.a), 'a', m.b),
         named_struct('done', array_append(m.done, m.b), 'a', m.a))"""

    def let(name: str, value: str, body: str) -> str:
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    return f"""aggregate(slice(items, 2, size(items)),
        named_struct('done', cast(array() AS array<{item}>), 'a', items[0]),
        (acc, b) -> {let('t', step, let('m', moved, out))})"""


def pivotal(rows: DataFrame, levels: int, seed: int) -> DataFrame:
    """Round ``source, node, key, doc_id, row, s, x`` (0 < x < s, in units).

    Returns ``source, doc_id, row, s, x`` with x in {0, s} but for one row per
    source. ``node`` numbers the leaves of a source's tree; ``levels`` is how
    often the node numbers are divided by ``NODE`` before one node is left.
    """
    fields = ["key", "doc_id", "of", "row", "s", "x"]
    decided = []
    for level in range(levels):
        nodes = rows.groupBy("source", "node").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("items"))
        folded = scratch(nodes.select("source", "node", F.expr(_fold(level, seed)).alias("r")), f"pivotal-{level}")
        decided.append(folded.select("source", F.explode("r.done").alias("d")).select("source", "d.*"))
        # the last one of a node may have come out whole
        rows = folded.select("source", F.floor(F.col("node") / NODE).alias("node"), "r.a.*")
        decided.append(rows.where("x = 0 OR x = s").drop("node"))
        rows = rows.where("x > 0 AND x < s")
    out = rows.drop("node")
    for d in decided:
        out = out.unionByName(d)
    return out.drop("key")


def _numbered(docs: DataFrame, *more) -> DataFrame:
    """``doc_id, source, size, of, row`` and ``more``: documents that share id and text (by its hash ``of``) are numbered by source.

    Rows without an id so meet by their texts, and one id for many texts is no hot key either.
    """
    count = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        count.alias("size"), F.xxhash64("text").alias("of"), *more)
    return sized.withColumn("row", F.row_number().over(W.partitionBy("doc_id", "of").orderBy("source")))


def mix(docs: DataFrame, weights=WEIGHTS, total_share: float = 1.5, max_copies: float = 2.0, seed: int = 7) -> DataFrame:
    """``doc_id, of, row, source, size, source_size, target, copies, taken`` per document.

    ``copies`` are whole copies and ``taken`` the words taken; ``of`` is the text's hash and ``row``
    numbers documents that share both it and ``doc_id`` (1 if none does). The words taken of a
    source differ from its target by less than one word, and a unit per document.
    """
    sized = scratch(_numbered(docs), "mix-sizes")
    targets = scratch(source_targets(sized, weights, total_share, max_copies), "mix-targets")
    most = targets.agg(F.max("docs")).first()[0] or 0
    levels, left = 1, -(-most // NODE)
    while left > 1:
        levels, left = levels + 1, -(-left // NODE)
    # few sources are broadcast by their size; many are joined, with skewed ones split
    of_source = targets.withColumnRenamed("source", "of_source")

    def with_targets(df: DataFrame) -> DataFrame:
        df = df.join(of_source, df.source.eqNullSafe(of_source.of_source)).drop("of_source")
        rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
        return df.withColumn("rate", rate).withColumn("copies", F.floor("rate"))

    rated = with_targets(sized).withColumns({
        "key": F.xxhash64("doc_id", "of", "row"), "s": F.col("size") * UNIT,
        "x": F.floor((F.col("rate") - F.col("copies")) * F.col("size") * UNIT)})
    rated = scratch(rated.select("source", "key", "doc_id", "of", "row", "s", "x", "docs"), "mix-rated")
    fractional = (F.col("x") > 0) & (F.col("x") < F.col("s"))
    leaves = rated.where(fractional).withColumn("node", F.pmod("key", F.ceil(F.col("docs") / NODE)))
    rounded = pivotal(leaves.drop("docs"), levels, seed)
    out = with_targets(rated.where(~fractional).select("source", "doc_id", "of", "row", "s", "x").unionByName(rounded))
    size = (F.col("s") / UNIT).cast("long")
    whole = F.when((F.col("s") > 0) & (F.col("x") == F.col("s")), 1).otherwise(0)
    return out.select("doc_id", "of", "row", "source", size.alias("size"), "source_size", "target",
                      (F.col("copies") + whole).cast("int").alias("copies"),
                      (F.col("copies") * size + F.floor(F.col("x") / UNIT)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns.

    A source's partly taken document ends with a copy of its taken words, joined by one blank.
    """
    chosen = mix(docs, **settings).where("taken > 0").select("doc_id", "of", "row", "size", "copies", "taken")
    rows = _numbered(docs, F.struct(*docs.columns).alias("doc")).drop("size", "source")
    both = rows.join(chosen, rows.doc_id.eqNullSafe(chosen.doc_id) & (rows.of == chosen.of) & (rows.row == chosen.row)).drop("doc_id", "of", "row")
    rest = F.col("taken") - F.col("copies") * F.col("size")
    times = F.array_repeat(F.lit(None).cast("long"), F.col("copies"))
    times = F.when(rest > 0, F.array_append(times, rest)).otherwise(times)
    both = both.select("doc", F.explode(times).alias("part"))
    words = F.regexp_extract_all(F.col("doc.text").cast("string"), F.lit(WORD), F.lit(0))
    head = F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), " ")
    text = F.when(F.col("part").isNull(), F.col("doc.text")).otherwise(head)
    return both.select(*[(text if c == "text" else F.col(f"doc.{c}")).alias(c) for c in docs.columns])
