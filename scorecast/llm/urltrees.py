r"""URL filter: rules first, then gradient-boosted trees on lexical features.

A url's host is what follows its first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
lower case; its path goes on from there up to ``?``, ``#`` or the end. A rule such as
``example.net/en/`` fits a host, its subdomains, and the paths that begin with the
rule's; the longest fitting rule decides. Urls without a rule are judged by the model,
which learns from the urls with one.

Features, all from the url alone: lengths of url, host and path; labels of the host and
depth of the path; share of digits and of other marks; entropy of the characters;
numbers of parameters and of their characters; whether there is a fragment and a file
suffix; and for four suffixes (last label of the host, last two labels, last directory and
file suffix of the path) how often labelled urls that end so are blocked. Suffix counts
cover all labelled rows. A labelled row must not see its own label, so its suffix rates come from the other
``FOLDS - 1`` folds (crc32 of the url), a row without a rule reads all folds. Rates are shrunk to
the overall rate by ``PRIOR`` rows.

The trees are fitted by Spark's gradient boosting on labelled rows with equal total
weight for both verdicts. At most about ``SAMPLE`` of them (a hash sample of whole rows; the only bound)
take part; suffix statistics, rules and verdicts cover all rows. The main path is
DataFrame expressions and MLlib on the JVM, without Python workers.

Skew. Joins are by suffix only. Suffixes with more than one in ``FREQUENT`` rows, labelled
or not, are fewer than ``FREQUENT`` by arithmetic; those are broadcast. No other
suffix is hot, and rows already answered are spread. Counts are taken per combination
of suffixes before they are shuffled. No row is joined with another row.

Defined cases: a null url, or one without ``://``, has empty host and path, no rule and is
judged by its other features; repeated rows are judged each; rows without labels of
both kinds cannot train: all urls without a rule then get the only label seen, or
``allow``; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import scratch

#: The contract's rules.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

SAMPLE = 100_000
FOLDS = 5
PRIOR = 20.0
FREQUENT = 1024
ROUNDS, DEPTH, STEP = 20, 4, 0.3

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SUFFIXES = ("tld", "domain", "directory", "extension")


def parts_of(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substr(rest, F.length(host) + 1)
    empty = F.lit("")
    return F.coalesce(F.translate(host, UPPER, LOWER), empty), F.coalesce(F.regexp_extract(after, r"^[^?#]*", 0), empty)


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, null if none does; of equally long ones the first."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        of_host, _, of_path = rule.partition("/")
        fits = ((host == of_host) | F.endswith(host, F.lit("." + of_host))) & F.startswith(path, F.lit("/" + of_path))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The features that need nothing but the url."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    seen = F.array_distinct(F.split(url, ""))
    n = F.greatest(F.length(url), F.lit(1))
    bits = F.transform(seen, lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n)
    entropy = F.aggregate(F.filter(bits, lambda p: p > 0), F.lit(0.0), lambda total, p: total - p * F.log2(p))
    return {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "labels": F.size(F.split(host, r"\.")), "depth": F.regexp_count(path, F.lit("[^/]+")),
        "digit_share": _share(url, "[0-9]"), "host_digit_share": _share(host, "[0-9]"), "mark_share": _share(url, "[^0-9A-Za-z]"),
        "hyphens": F.regexp_count(host, F.lit("-")), "entropy": entropy, "parameters": F.regexp_count(query, F.lit("[^&]+")),
        "query_length": F.length(query), "fragment": F.contains(url, F.lit("#")).cast("int"), "secure": F.startswith(url, F.lit("https:")).cast("int"),
        "last_length": F.length(F.regexp_extract(path, r"([^/]*)/?$", 1)),
    }


def _suffixes(host: Column, path: Column) -> list[Column]:
    return [F.regexp_extract(host, r"[^.]*$", 0), F.regexp_extract(host, r"[^.]*\.?[^.]*$", 0),
            F.regexp_extract(path, r"([^/]*)/[^/]+/?$", 1), F.regexp_extract(path, r"\.[^./]*$", 0)]


def _with_rates(rows: DataFrame, overall: float) -> DataFrame:
    """``rows`` with a column ``rate_<suffix>`` per suffix kind: the share of blocked urls among the labelled rows of other folds."""
    names = list(SUFFIXES)
    # one row per combination of suffixes and fold, not per url
    cells = rows.groupBy(*names, "fold").agg(F.count(F.lit(1)).alias("every"), F.count("label").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"))
    cells = scratch(cells, "url-cells")
    total = cells.agg(F.sum("every")).first()[0] or 0
    sums = [F.sum(c).alias(c) for c in ("every", "n", "blocked")]
    for name in names:
        per = cells.groupBy(name, "fold").agg(*sums).groupBy(name).agg(
            *sums, F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "blocked")))).alias("folds"))  # FOLDS entries
        per = scratch(per.select(F.col(name).alias("suffix"), "every", F.struct("n", "blocked", "folds").alias("counts")), f"url-{name}")
        often = F.col("every") > total / FREQUENT
        frequent = F.broadcast(per.where(often).select("suffix", F.col("counts").alias("often")))  # fewer than FREQUENT rows
        rows = rows.join(frequent, F.col(name) == F.col("suffix"), "left").drop("suffix")
        # the others are in fewer rows each; rows already answered are spread and find nothing
        spread = F.when(F.col("often").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("url", "page_id"), F.lit(1 << 20)).cast("int"))
        rare = per.where(~often).select("suffix", F.lit(0).alias("at"), F.col("counts").alias("rare"))
        rows = rows.withColumn("spread", spread).join(rare, (F.col(name) == F.col("suffix")) & (F.col("spread") == F.col("at")), "left")
        found = F.coalesce("often", "rare")
        own = F.when(F.col("label").isNotNull(), F.try_element_at(found["folds"], F.col("fold")))
        n = F.coalesce(found["n"], F.lit(0)) - F.coalesce(own["n"], F.lit(0))
        blocked = F.coalesce(found["blocked"], F.lit(0)) - F.coalesce(own["blocked"], F.lit(0))
        rows = rows.withColumn(f"rate_{name}", (blocked + PRIOR * overall) / (n + PRIOR)).drop("suffix", "at", "spread", "often", "rare")
    return rows


def features(pages: DataFrame, rules: dict[str, str] = RULES, training: Column | None = None) -> tuple[DataFrame, list[str], tuple[int, int]]:
    """Stored rows with ``page_id, host, path, rule, label`` and features; the features' names; labelled rows and blocked ones.

    ``label`` is 1 for a rule that blocks, 0 for one that allows, and null without a rule or where ``training`` (a
    condition on ``page_id, url, host, path, rule``) does not hold.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = parts_of(F.col("url"))
    rows = rows.select("*", host.alias("host"), path.alias("path"))
    rows = rows.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("rule"))
    blocks = [r for r, v in rules.items() if v == "block"]
    label = F.when(F.col("rule").isNotNull() & (F.lit(True) if training is None else F.coalesce(training, F.lit(False))), F.col("rule").isin(blocks).cast("int"))
    made = {n: c.cast("double") for n, c in lexical(F.col("url"), F.col("host"), F.col("path")).items()}
    rows = rows.select("*", label.alias("label"), F.pmod(F.crc32(F.coalesce(F.col("url"), F.lit("")).cast("binary")), F.lit(FOLDS)).cast("int").alias("fold"),
                       *[c.alias(n) for c, n in zip(_suffixes(F.col("host"), F.col("path")), SUFFIXES)], *[c.alias(n) for n, c in made.items()])
    rows = scratch(rows, "url-lexical")
    seen = rows.agg(F.count("label"), F.coalesce(F.sum("label"), F.lit(0))).first()
    rows = _with_rates(rows, seen[1] / seen[0] if seen[0] else 0.5)
    names = [*made, *[f"rate_{s}" for s in SUFFIXES]]
    return scratch(rows.select("page_id", "url", "host", "path", "rule", "label", *names), "url-features"), names, (seen[0], seen[1])


def judged(pages: DataFrame, rules: dict[str, str] = RULES, training: Column | None = None, rounds: int = ROUNDS, depth: int = DEPTH,
           step: float = STEP, sample: int = SAMPLE) -> DataFrame:
    """``page_id, url, host, path, rule, verdict, model_verdict, score`` per page; ``score`` is the model's probability of ``block``."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows, names, (labelled, blocked) = features(pages, rules, training)
    if 0 < blocked < labelled:
        place = F.pmod(F.xxhash64("url", "page_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / labelled))
        weight = F.when(F.col("label") == 1, labelled / blocked).otherwise(labelled / (labelled - blocked))
        vectors = VectorAssembler(inputCols=names, outputCol="features")
        train = vectors.transform(rows.where(F.col("label").isNotNull() & place)).select("features", F.col("label").cast("double").alias("label"), weight.alias("weight"))
        trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, maxBins=32, minInstancesPerNode=5, seed=1, weightCol="weight")
        model = trees.fit(scratch(train, "url-train"))
        rows = model.transform(vectors.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    else:
        rows = rows.withColumn("score", F.lit(1.0 if labelled and blocked else 0.0))
    by_model = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    verdict = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]), F.col("rule")), by_model) if rules else by_model
    return rows.select("page_id", "url", "host", "path", "rule", verdict.alias("verdict"), by_model.alias("model_verdict"), "score")
