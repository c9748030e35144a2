"""Row-level validation that routes bad rows instead of failing the job.

Every check is a column expression; a row's problems are collected into an
``errors`` array (``array_compact`` drops the passing checks), so valid and
invalid rows come out of one scan and can be split into a clean table and a
quarantine table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_level, fill, map_literal, python_list
from ..schema import (CATEGORY_MAPS, EXPECTED_FEATURE_COUNT, FEATURE_COLUMNS, MSG_REQUEST_ABOVE, MSG_REQUEST_BELOW,
                      MSG_REQUEST_MISSING, MSG_REQUEST_NOT_TEXT, MSG_REQUEST_UNKNOWN_LEVEL, MSG_VECTOR_COUNT,
                      MSG_VECTOR_TYPES, REQUEST_RULES)


def _fmt(v) -> str:
    return str(int(v)) if float(v).is_integer() else repr(float(v))


def range_checks(rules: dict | None = None) -> list[Column]:
    """One nullable message per rule: missing value, or outside [lo, hi]."""
    rules = rules or REQUEST_RULES
    checks = []
    for col, (_, lo, hi) in rules.items():
        c = F.col(col)
        checks.append(F.when(c.isNull(), F.lit(MSG_REQUEST_MISSING.format(field=col))))
        if lo is not None:
            checks.append(F.when(c < F.lit(lo), F.lit(MSG_REQUEST_BELOW.format(field=col, bound=_fmt(lo)))))
        if hi is not None:
            checks.append(F.when(c > F.lit(hi), F.lit(MSG_REQUEST_ABOVE.format(field=col, bound=_fmt(hi)))))
    return checks


def category_checks(maps: dict | None = None, columns: list[str] | None = None,
                    schema: T.StructType | None = None) -> list[Column]:
    """Per categorical column: null / non-text, or a level outside the map.

    With ``schema``, a categorical column that is not text (numbers, booleans)
    fails as "must be text" on every row, as the request contract demands.
    """
    maps = maps or CATEGORY_MAPS
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    checks = []
    for col, mapping in maps.items():
        if columns is not None and col not in columns:
            continue
        not_text = F.lit(MSG_REQUEST_NOT_TEXT.format(field=col))
        if col in types and not isinstance(types[col], T.StringType):
            checks.append(not_text)
            continue
        known = F.try_element_at(map_literal(mapping), clean_level(col)).isNotNull()
        checks.append(
            F.when(F.col(col).isNull(), not_text)
            .when(~known, F.lit(MSG_REQUEST_UNKNOWN_LEVEL.format(field=col, allowed=python_list(mapping))))
        )
    return checks


def with_errors(df: DataFrame, checks: list[Column], name: str = "errors") -> DataFrame:
    """Adds ``errors`` (array of messages, empty when valid) and ``is_valid``."""
    return df.withColumn(name, F.array_compact(F.array(*checks))).withColumn(
        "is_valid", F.size(F.col(name)) == 0)


def validate_ranges(df: DataFrame, rules: dict | None = None) -> DataFrame:
    return with_errors(df, range_checks(rules))


def validate_categories(df: DataFrame, maps: dict | None = None) -> DataFrame:
    """``error`` holds the first failing column in map order (request semantics)."""
    checks = category_checks(maps, [c for c in (maps or CATEGORY_MAPS) if c in df.columns], df.schema)
    return with_errors(df, checks).withColumn("error", F.try_element_at(F.col("errors"), F.lit(1)))


def check_vector_schema(df: DataFrame, columns: list[str] | None = None) -> None:
    """Reject non-numeric feature columns (Boolean, text) before assembling."""
    columns = columns or FEATURE_COLUMNS
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    bad = [c for c in columns if c not in types or isinstance(types[c], (T.BooleanType, T.StringType))
           or not isinstance(types[c], T.NumericType)]
    if bad:
        raise ValueError(f"{MSG_VECTOR_TYPES} Offending columns: {bad}")


def feature_array(columns: list[str] | None = None) -> Column:
    columns = columns or FEATURE_COLUMNS
    return F.array(*[F.col(c).cast("double") for c in columns])


def validate_vector(df: DataFrame, vector_col: str = "features",
                    expected: int = EXPECTED_FEATURE_COUNT) -> DataFrame:
    """Checks an array column: exactly ``expected`` entries, none null (NaN is a number)."""
    v = F.col(vector_col)
    n = F.size(v)
    err = (F.when(v.isNull(), F.lit("Feature vector is missing."))
           .when(n != expected, fill(MSG_VECTOR_COUNT, expected=expected, got=n.cast("string")))
           .when(~F.forall(v, lambda x: x.isNotNull()), F.lit(MSG_VECTOR_TYPES)))
    return df.withColumn("n_features", n.cast("int")).withColumn("error", err).withColumn(
        "is_valid", err.isNull())
