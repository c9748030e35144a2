r"""Filter interaction audit by failing-id relations.

Every filter has one stored table with the ids of the rows that fail it. Applying the
filters in an order means: the survivors of a prefix are the rows that are left after
an anti-join with each of its tables, and a filter removes the survivors that its own
table holds. What a filter removes after a prefix depends on the set of filters in the
prefix, not on their order, so all orders together have one removal relation per
filter and set:

    removed(f, {})      = ids of f
    removed(f, S + {g}) = removed(f, S) left-anti ids of g

All of them are computed together, with one left-anti join per filter: each row of
``removed(f, S)`` is carried twice, with and without g in the prefix, and the join drops
the second where g's table holds the id. All joins are on the id, so the rows are
dealt and sorted once. Labels are semi-joins of the ids with the labelled ids. Counts
per part, filter and prefix follow by one aggregate; only these (parts x filters x
sets) meet the table of orders.

    kept        rows of the part less those removed at this and all earlier steps
    redundant   failing rows of the filter less those it removes
    unique      removed(f, all other filters)
    shapley     sum over orders of removed(f, S) = sum over S of |S|! (m - 1 - |S|)! removed(f, S)

Rows that agree in id, text, part and failures are one row with a number, so no id is
hot however often a row repeats. Copies (filter E): the first holder of a text is its
smallest doc_id; the failing ids are all others, found by an anti-join on (doc_id,
text digest) with the first holders, so a text with a third of all rows is no hot key.

Defined cases: null text is empty (no words, no characters) and is identical to other
empty and null texts; a null ``doc_id`` is no smaller than any and has no smaller one,
so such a row passes E and has no label; rows that repeat an id with its text are not
copies of each other, for none has a smaller id; several labels of one id count if any
is 1; a null part is the empty string; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import itertools
import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import scratch

SPACE = r"[\x20\x09-\x0D]+"


def text_filters(text: Column) -> dict[str, Column]:
    """The contract's conditions on one text, true where the filter fails it."""
    words = F.array_remove(F.split(text, SPACE), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _rows(docs: DataFrame, filters: dict[str, Column], part: Column) -> DataFrame:
    """``id, doc_id, of, part, n`` and a flag per filter: the distinct rows, stored with an id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    flags = [F.coalesce(c, F.lit(False)).alias(f"fails_{name}") for name, c in filters.items()]
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("of"),
                       F.coalesce(part.cast("string"), F.lit("")).alias("part"), *flags)
    return scratch(each.groupBy(*each.columns).agg(F.count(F.lit(1)).alias("n")).withColumn("id", F.monotonically_increasing_id()), "audit-rows")


def _copies(rows: DataFrame) -> DataFrame:
    """The rows whose text a smaller doc_id holds: all but the first holders."""
    known = rows.where("doc_id IS NOT NULL")
    first = known.groupBy("of").agg(F.min("doc_id").alias("doc_id"))
    return known.join(first, ["doc_id", "of"], "left_anti")


def failing_ids(docs: DataFrame, labels: DataFrame | None = None, part: Column | None = None, copies: str | None = "E",
                filters: dict[str, Column] | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The stored rows (``id, part, n, good, toxic``) and one stored table of failing ids per filter.

    ``filters`` are conditions on the columns of ``docs``; ``copies`` names a further filter that
    fails copies of texts, none if null.
    """
    part = F.col("source") if part is None else part
    filters = text_filters(F.coalesce(F.col("text").cast("string"), F.lit(""))) if filters is None else filters
    rows = _rows(docs, filters, part)
    tables = {name: scratch(rows.where(f"fails_{name}").select("id"), f"audit-fails-{name}") for name in filters}
    if copies:
        tables[copies] = scratch(_copies(rows).select("id"), f"audit-fails-{copies}")
    marked = rows.select("id", "doc_id", "part", "n", "of")
    for name, column in (("good", "quality"), ("toxic", "toxic")):
        flag = F.lit(False)
        if labels is not None:
            # rows without an id are spread by their text: they have no label, and else would meet in one task
            ids = labels.where(F.col(column) == 1).select(F.col("doc_id").cast("long").alias("l_id"), F.lit(0).cast("long").alias("l_spread")).distinct()
            spread = F.when(F.col("doc_id").isNull(), F.xxhash64("of")).otherwise(F.lit(0).cast("long"))
            marked = marked.withColumn("spread", spread).join(ids, (F.col("doc_id") == F.col("l_id")) & (F.col("spread") == F.col("l_spread")), "left")
            flag = F.col("l_id").isNotNull()
        marked = marked.withColumn(name, flag.cast("long")).drop("l_id", "l_spread", "spread")
    return scratch(marked.drop("doc_id", "of"), "audit-marked"), tables


def removals(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """``part, filter, prefix, removed, good, toxic`` for every filter and every set of other filters before it.

    ``prefix`` has bit i for the i-th filter. Pairs that remove nothing have no row.
    """
    fails = None
    for i, name in enumerate(tables):
        one = tables[name].select("id", F.lit(i).alias("filter"))
        fails = one if fails is None else fails.unionByName(one)
    alive = fails.join(rows, "id").withColumn("prefix", F.lit(0))
    for i, name in enumerate(tables):
        # both with and without this filter in the prefix; its own removals only without
        taken = F.when(F.col("filter") == i, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1 << i)))
        alive = alive.withColumn("taken", F.explode(taken)).withColumn("prefix", F.col("prefix") + F.col("taken"))
        gone = tables[name].select(F.col("id").alias("gone"))
        alive = alive.join(gone, (F.col("id") == F.col("gone")) & (F.col("taken") > 0), "left_anti")
    return alive.groupBy("part", "filter", "prefix").agg(
        F.sum("n").alias("removed"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame | None = None, part: Column | None = None, copies: str | None = "E",
          filters: dict[str, Column] | None = None) -> DataFrame:
    """One row per part, order of all filters and step: what the step keeps, removes and loses (contract columns)."""
    rows, tables = failing_ids(docs, labels, part, copies, filters)
    names = list(tables)
    m, everything = len(names), (1 << len(names)) - 1
    cells = scratch(removals(rows, tables), "audit-removals")
    parts = rows.groupBy("part").agg(F.sum("n").alias("total"))
    # per part and filter: failing rows in all, those that fail nothing else, and the sum over all orders
    weight = F.element_at(F.array(*[F.lit(math.factorial(s) * math.factorial(m - 1 - s)) for s in range(m)]), F.bit_count("prefix").cast("int") + 1)
    others = F.lit(everything) - F.expr("shiftleft(1, filter)")
    per_filter = cells.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("prefix") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("prefix") == others, F.col("removed"))).alias("unique_fails"),
        F.sum(weight * F.col("removed")).alias("shapley"))
    steps = [("".join(names[i] for i in order), step + 1, f, sum(1 << i for i in order[:step]))
             for order in itertools.permutations(range(m)) for step, f in enumerate(order)]
    plan = F.from_json(F.lit(json.dumps([dict(zip(("filter_order", "step", "filter", "prefix"), s)) for s in steps])),
                       "array<struct<filter_order: string, step: int, filter: int, prefix: int>>")
    grid = parts.select("part", "total", F.explode(plan).alias("s")).select("part", "total", "s.*")
    out = grid.join(cells, ["part", "filter", "prefix"], "left").join(per_filter, ["part", "filter"], "left")
    out = out.na.fill(0, ["removed", "good", "toxic", "fails", "unique_fails", "shapley"])
    so_far = F.sum("removed").over(W.partitionBy("part", "filter_order").orderBy("step"))
    return out.select("part", "filter_order", "step", (F.col("total") - so_far).alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
                      "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")
