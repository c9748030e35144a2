"""Queries: preparation, encoding, splitting and fixed-coefficient scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import round_half_even
from ..operators.metrics import regression_metrics
from ..operators.models.linear import LinearModel
from ..operators.prepare import (Preparer, category_map_frame, encode_categories, encode_categories_join, impute,
                                 mode_values)
from ..operators.sampling import split_column, with_split_and_fold
from ..schema import CATEGORICAL_COLUMNS, CATEGORY_MAPS, FEATURE_COLUMNS, TARGET_COLUMN
from ..sources.standin import habits
from .registry import (D_MODE_PARENT, WITH_HABITS, d_code, d_hash, d_linear, d_prepared, dr, query, rnd)

# A fixed scoring artefact (coefficients in original units) used where the
# oracle must recompute predictions exactly.
FIXED_INTERCEPT = 5.0
FIXED_COEF = {
    "age": 0.1,
    "gender": 0.5,
    "study_hours_per_day": 9.0,
    "social_media_hours": -2.5,
    "netflix_hours": -2.0,
    "part_time_job": -1.0,
    "attendance_percentage": 0.15,
    "sleep_hours": 2.0,
    "diet_quality": 0.8,
    "exercise_frequency": 1.5,
    "parental_education_level": 0.6,
    "internet_quality": 0.4,
    "mental_health_rating": 2.0,
    "extracurricular_participation": 0.3,
}


def fixed_model() -> LinearModel:
    return LinearModel(FEATURE_COLUMNS, [FIXED_COEF[c] for c in FEATURE_COLUMNS], FIXED_INTERCEPT, name="fixed")


def prepared(spark, sf_dir):
    h = habits(spark, sf_dir)
    return Preparer().fit(h).transform(h, keep=["student_id"])


def scored_fixed(spark, sf_dir):
    """Prepared rows scored by the fixed model, prediction rounded to 2 places."""
    p = prepared(spark, sf_dir)
    return fixed_model().transform(p).withColumn("prediction", round_half_even(F.col("prediction"), 2))


D_SCORED_FIXED = (
    f"{WITH_HABITS}, prep AS (SELECT {d_prepared()} FROM habits), "
    f"scored AS (SELECT *, {dr(d_linear(FIXED_COEF, FIXED_INTERCEPT), 2)} AS prediction FROM prep)"
)


@query("prepare_features", f"{WITH_HABITS} SELECT {d_prepared()} FROM habits")
def q_prepare_features(spark, sf_dir):
    return prepared(spark, sf_dir)


@query(
    "impute_mode",
    f"{WITH_HABITS} SELECT student_id, coalesce(parental_education_level, {D_MODE_PARENT}) "
    f"AS parental_education_level FROM habits",
)
def q_impute_mode(spark, sf_dir):
    h = habits(spark, sf_dir)
    fills = Preparer().fit(h).fills
    return impute(h.select("student_id", "parental_education_level"), fills)


_MODE_UNION = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS mode, CAST(count(*) AS BIGINT) AS n "
    f"FROM habits WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    for c in CATEGORICAL_COLUMNS + ["age", "exercise_frequency", "mental_health_rating"]
)


@query("mode_value", f"{WITH_HABITS} {_MODE_UNION}")
def q_mode_value(spark, sf_dir):
    h = habits(spark, sf_dir)
    cols = CATEGORICAL_COLUMNS + ["age", "exercise_frequency", "mental_health_rating"]
    return mode_values(h, cols).select(F.col("column").alias("column_name"), "mode", F.col("n").cast("bigint"))


_ENC_SQL = (f"{WITH_HABITS} SELECT student_id, "
            + ", ".join(f"{d_code(c)} AS {c}" for c in CATEGORICAL_COLUMNS) + " FROM habits")


@query("encode_categories", _ENC_SQL)
def q_encode_categories(spark, sf_dir):
    h = habits(spark, sf_dir).select("student_id", *CATEGORICAL_COLUMNS)
    return encode_categories(h)


@query("encode_join", _ENC_SQL)
def q_encode_join(spark, sf_dir):
    h = habits(spark, sf_dir).select("student_id", *CATEGORICAL_COLUMNS)
    return encode_categories_join(h, category_map_frame(spark), map_rows=sum(len(m) for m in CATEGORY_MAPS.values()))


@query("score_linear", f"{D_SCORED_FIXED} SELECT student_id, exam_score, prediction FROM scored")
def q_score_linear(spark, sf_dir):
    from ..operators.score import score_batch

    h = habits(spark, sf_dir)
    return score_batch(h, fixed_model(), Preparer().fit(h), output="prediction").select("student_id", "exam_score", "prediction")


@query("predict_row", f"{D_SCORED_FIXED} SELECT student_id, prediction, exam_score AS actual, CAST(NULL AS VARCHAR) AS error FROM "
       "(SELECT *, row_number() OVER (ORDER BY student_id) - 1 AS i FROM scored) WHERE i = 7")
def q_predict_row(spark, sf_dir):
    """One stored row by position: its prediction beside the actual score."""
    from ..operators.score import predict_row

    h = habits(spark, sf_dir)
    r = predict_row(h, 7, fixed_model(), Preparer().fit(h), TARGET_COLUMN, "student_id")
    return r.withColumn("prediction", round_half_even("prediction", 2))


_SPLIT = f"({d_hash('student_id', ':42')} % 100 < 20)"


@query(
    "regression_metrics",
    f"{D_SCORED_FIXED}, s AS (SELECT *, {_SPLIT} AS is_test FROM scored "
    f"WHERE exam_score IS NOT NULL AND prediction IS NOT NULL) "
    f"SELECT is_test, {dr('sqrt(avg((exam_score - prediction) * (exam_score - prediction)))')} AS rmse, "
    f"{dr('avg(abs(exam_score - prediction))')} AS mae, "
    f"{dr('CASE WHEN var_pop(exam_score) * count(exam_score) > 0 THEN 1e0 - sum((exam_score - prediction) * (exam_score - prediction)) / (var_pop(exam_score) * count(exam_score)) WHEN sum((exam_score - prediction) * (exam_score - prediction)) = 0 THEN 1e0 ELSE 0e0 END')} AS r2 "
    f"FROM s GROUP BY is_test",
)
def q_regression_metrics(spark, sf_dir):
    s = scored_fixed(spark, sf_dir).withColumn("is_test", split_column())
    m = regression_metrics(s, by=["is_test"])
    return m.select("is_test", rnd("rmse").alias("rmse"), rnd("mae").alias("mae"), rnd("r2").alias("r2"))


@query("hash_split", f"{WITH_HABITS} SELECT student_id, {_SPLIT} AS is_test FROM habits")
def q_hash_split(spark, sf_dir):
    return habits(spark, sf_dir).select("student_id", split_column().alias("is_test"))


@query(
    "fold_counts",
    f"{WITH_HABITS}, f AS (SELECT {_SPLIT} AS is_test, "
    f"CASE WHEN NOT {_SPLIT} THEN CAST({d_hash('student_id', ':fold:42')} % 5 AS INTEGER) END AS fold FROM habits) "
    f"SELECT is_test, fold, CAST(count(*) AS BIGINT) AS n FROM f GROUP BY is_test, fold",
)
def q_fold_counts(spark, sf_dir):
    h = with_split_and_fold(habits(spark, sf_dir))
    return h.groupBy("is_test", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("drop_ident", f"{WITH_HABITS} SELECT * EXCLUDE (student_id) FROM habits")
def q_drop_ident(spark, sf_dir):
    """Drop the identifier (names that are absent are ignored)."""
    return habits(spark, sf_dir).drop("student_id", "row_index_not_present")


@query("feature_select", f"{WITH_HABITS} SELECT {', '.join(FEATURE_COLUMNS)} FROM (SELECT {d_prepared()} FROM habits)")
def q_feature_select(spark, sf_dir):
    """Model inputs in the saved feature order (all columns but key and target)."""
    return prepared(spark, sf_dir).select(*FEATURE_COLUMNS)
