"""Scoring: batches (impute -> encode -> predict -> round) and request tables
(validate -> encode -> predict -> clip -> round), with bad rows routed to an
``error`` column instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip_score, round_half_even, round_python
from ..schema import CATEGORY_MAPS, FEATURE_COLUMNS, REQUEST_RULES
from .models.linear import LinearModel
from .prepare import Preparer, mode_values
from .validate import category_checks, range_checks


def _missing_error(features: list[str]):
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in features]))
    return F.when(F.size(names) > 0, F.concat(F.lit("missing or unknown value in: "), F.array_join(names, ", ")))


def predict(model, df: DataFrame, features: list[str] | None = None, output: str = "prediction") -> DataFrame:
    """Model prediction with error rows: rows with a null feature get a null
    prediction and an ``error`` text (a linear model is one projection; other
    models score only complete rows, the rest are unioned back)."""
    features = features or FEATURE_COLUMNS
    err = _missing_error(features)
    if isinstance(model, LinearModel):
        return model.transform(df, output).withColumn("error", err).withColumn(
            output, F.when(F.col("error").isNull(), F.col(output)))
    flagged = df.withColumn("error", err)
    ok = flagged.where(F.col("error").isNull())
    bad = flagged.where(F.col("error").isNotNull()).withColumn(output, F.lit(None).cast("double"))
    scored = model.transform(ok, output=output)
    return scored.unionByName(bad, allowMissingColumns=True)


def score_batch(df: DataFrame, model, preparer: Preparer, places: int = 2, clip: bool = False,
                recompute_mode: bool = False, output: str = "predicted_exam_score") -> DataFrame:
    """Raw columns kept, prediction appended (rounded; clipped only if asked).

    ``recompute_mode=True`` imputes with the mode of this batch instead of the
    fitted one (the original job's behaviour).
    """
    prep = preparer
    if recompute_mode:
        cols = [c for c in preparer.impute_columns if c in df.columns]
        fills = {r["column"]: r["mode"] for r in mode_values(df, cols).collect()} if cols else {}
        prep = Preparer(fills=fills, maps=preparer.maps, impute_columns=preparer.impute_columns,
                        drop_columns=preparer.drop_columns)
    from ..functions.text import encode_level

    raw_cols = df.columns
    enc = []
    for c in FEATURE_COLUMNS:
        src = F.col(f"__raw_{c}")
        if prep.fills.get(c) is not None:
            src = F.coalesce(src, F.lit(prep.fills[c]))
        enc.append((encode_level(src, prep.maps[c]) if c in prep.maps else src).alias(c))
    # raw columns kept under temporary names; encoded features take the model's names
    work = df.select(*[F.col(c).alias(f"__raw_{c}") for c in raw_cols], *enc)
    scored = predict(model, work, output="__p")
    pred = round_half_even(clip_score(F.col("__p")) if clip else F.col("__p"), places)
    return scored.select(*[F.col(f"__raw_{c}").alias(c) for c in raw_cols], pred.alias(output), "error")


def score_requests(df: DataFrame, model, maps: dict | None = None, rules: dict | None = None,
                   clip: bool = True, places: int = 2, key: str = "request_id") -> DataFrame:
    """Per request: ``predicted_exam_score`` or ``error`` (first failing check)."""
    maps = maps or CATEGORY_MAPS
    checks = range_checks(rules or REQUEST_RULES) + category_checks(maps, schema=df.schema)
    v = df.withColumn("__errors", F.array_compact(F.array(*checks)))
    enc = Preparer(fills={}, maps=maps, impute_columns=[], drop_columns=[]).transform(v)
    # a column of its own: rounding reads the score dozens of times, and must not repeat its lookups and sums
    if isinstance(model, LinearModel):
        enc = enc.withColumn("__p", model.prediction_column())
    else:  # rows with an error are not scored; requests may share an id, so nothing is joined by it
        ok = model.transform(enc.where(F.size("__errors") == 0), output="__p")
        enc = ok.unionByName(enc.where(F.size("__errors") > 0).withColumn("__p", F.lit(None).cast("double")))
    if clip:
        enc = enc.withColumn("__p", clip_score("__p"))
    return enc.select(
        key, F.when(F.size("__errors") == 0, round_python("__p", places)).alias("predicted_exam_score"),
        F.try_element_at(F.col("__errors"), F.lit(1)).alias("error"))


def predict_row(df: DataFrame, index: int, model, preparer: Preparer, target: str, key: str) -> DataFrame:
    """The stored row at a position in key order: key, unclipped prediction and actual value side by side."""
    from .sampling import row_lookup

    row = preparer.transform(row_lookup(df, index, key), keep=[key])
    return predict(model, row, output="prediction").select(key, "prediction", F.col(target).alias("actual"), "error")
