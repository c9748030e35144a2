"""Reusable preparation: drop key, impute with the fitted mode, clean and encode.

``Preparer.fit`` runs one distributed aggregation to learn the modes;
``Preparer.transform`` is then a pure projection, so it also runs on streams.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_level, encode_level
from ..schema import CATEGORY_MAPS, IMPUTE_COLUMNS, KEY_COLUMN

# Largest code-map table that is broadcast to every task; larger maps shuffle.
MAX_BROADCAST_MAP_ROWS = 1_000_000


def mode_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent non-null value per column; ties go to the smallest value.

    Long form ``(column, mode, n)`` with the mode rendered as text. Ties are
    broken in the column's own order (numeric order for numeric columns).
    Counting is a partial/final hash aggregate on ``(column, value)``, so no
    task holds more than one row per distinct value and hot values are
    pre-combined map-side; one scan serves all columns.
    """
    if not columns:
        raise ValueError("no columns")
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in
               ("integer", "long", "short", "byte", "double", "float", "decimal")}
    items = []
    for c in columns:
        num = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        items.append(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), num.alias("num")))
    stacked = df.select(F.explode(F.array(*items)).alias("s")).select("s.column", "s.value", "s.num")
    counts = (stacked.where(F.col("value").isNotNull())
              .groupBy("column", "value", "num").agg(F.count(F.lit(1)).alias("n")))
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("num"), F.col("value"))).alias("mode"),
        F.max("n").alias("n"),
    )


def mode_value(df: DataFrame, column: str) -> DataFrame:
    """One-row DataFrame with the mode of a single column (typed as the column)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.min_by(column, F.struct((-F.col("n")).alias("neg_n"), F.col(column))).alias("mode"),
        F.max("n").alias("n"),
    )


def impute(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Fill nulls with fitted scalars; other columns pass through."""
    cols = []
    for c in df.columns:
        if c in fills and fills[c] is not None:
            cols.append(F.coalesce(F.col(c), F.lit(fills[c])).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def encode_categories(df: DataFrame, maps: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """Replace each categorical column present by its integer code (unknown -> null)."""
    maps = maps or CATEGORY_MAPS
    return df.select(*[encode_level(c, maps[c]).alias(c) if c in maps else F.col(c) for c in df.columns])


def category_map_frame(spark: SparkSession, maps: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """Long form ``(column, level, code)`` of the code maps."""
    maps = maps or CATEGORY_MAPS
    rows = [(c, lvl, int(code)) for c, m in maps.items() for lvl, code in m.items()]
    return spark.createDataFrame(rows, "column string, level string, code int")


def encode_categories_join(df: DataFrame, map_df: DataFrame, columns: list[str] | None = None,
                           map_rows: int | None = None) -> DataFrame:
    """Left-outer equi-join lookup against a ``(column, level, code)`` table.

    For maps too big to inline as literals. The map side is broadcast only
    when its row count is within ``MAX_BROADCAST_MAP_ROWS`` (counted here if
    not given); otherwise Spark plans a shuffle join.
    """
    if columns is None:
        columns = [c for c in CATEGORY_MAPS if c in df.columns]
    if map_rows is None:
        map_rows = map_df.count()
    small = map_rows <= MAX_BROADCAST_MAP_ROWS
    out = df
    for c in columns:
        m = map_df.where(F.col("column") == c).select(
            F.col("level").alias(f"__lvl_{c}"), F.col("code").alias(f"__code_{c}")
        )
        if small:
            m = F.broadcast(m)
        out = out.withColumn(f"__key_{c}", clean_level(c)).join(
            m, F.col(f"__key_{c}") == F.col(f"__lvl_{c}"), "left"
        )
    return out.select(
        *[F.col(f"__code_{c}").cast("int").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


@dataclass
class Preparer:
    """Fitted preparation (the reference's ``prepare_data`` as fit/transform)."""

    fills: dict[str, str] = field(default_factory=dict)
    maps: dict[str, dict[str, int]] = field(default_factory=lambda: dict(CATEGORY_MAPS))
    impute_columns: list[str] = field(default_factory=lambda: list(IMPUTE_COLUMNS))
    drop_columns: list[str] = field(default_factory=lambda: [KEY_COLUMN])

    def fit(self, df: DataFrame) -> "Preparer":
        cols = [c for c in self.impute_columns if c in df.columns]
        fills = {}
        if cols:
            for r in mode_values(df, cols).collect():  # one row per imputed column
                fills[r["column"]] = r["mode"]
        return Preparer(fills=fills, maps=self.maps, impute_columns=self.impute_columns,
                        drop_columns=self.drop_columns)

    def fill_columns(self) -> dict[str, Column]:
        return {c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.fills.items()}

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Impute -> strip/title -> code. ``keep`` names columns exempt from dropping."""
        keep = keep or []
        drop = [c for c in self.drop_columns if c not in keep]
        fills = self.fill_columns()
        cols = []
        for c in df.columns:
            if c in drop:
                continue
            src = fills.get(c, F.col(c))
            if c in self.maps:
                cols.append(encode_level(src, self.maps[c]).alias(c))
            else:
                cols.append(src.alias(c) if c in fills else F.col(c))
        return df.select(*cols)

    def to_json(self) -> str:
        return json.dumps({"fills": self.fills, "maps": self.maps, "impute_columns": self.impute_columns,
                           "drop_columns": self.drop_columns})

    @staticmethod
    def from_json(text: str) -> "Preparer":
        d = json.loads(text)
        return Preparer(fills=d["fills"], maps=d["maps"], impute_columns=d["impute_columns"],
                        drop_columns=d["drop_columns"])


def derived_features(df: DataFrame) -> DataFrame:
    """Add total screen time and the study-to-leisure ratio."""
    from ..schema import RATIO_EPSILON

    total = F.col("social_media_hours") + F.col("netflix_hours")
    return df.withColumn("total_screen_time", total).withColumn(
        "study_to_leisure_ratio", F.col("study_hours_per_day") / (total + F.lit(RATIO_EPSILON))
    )
