"""Declared schemas and the fixed values every stage must agree on.

All values under "FIXED VALUES" must stay equal to the data dictionary,
code maps and thresholds of the pipeline this engine re-creates; changing
them changes results.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original pipeline's; do not reorder)
# ---------------------------------------------------------------------------

KEY_COLUMN = "student_id"
TARGET_COLUMN = "exam_score"
PREDICTION_COLUMN = "prediction"

# Raw table, in file order.
RAW_COLUMNS = [
    "student_id",
    "age",
    "gender",
    "study_hours_per_day",
    "social_media_hours",
    "netflix_hours",
    "part_time_job",
    "attendance_percentage",
    "sleep_hours",
    "diet_quality",
    "exercise_frequency",
    "parental_education_level",
    "internet_quality",
    "mental_health_rating",
    "extracurricular_participation",
    "exam_score",
]

# Text level -> integer code, per categorical column (map order matters for
# error precedence and for the "Allowed" lists in error messages).
CATEGORY_MAPS: dict[str, dict[str, int]] = {
    "gender": {"Male": 0, "Female": 1, "Other": 2},
    "part_time_job": {"No": 0, "Yes": 1},
    "diet_quality": {"Poor": 0, "Fair": 1, "Good": 2},
    "parental_education_level": {"High School": 0, "Bachelor": 1, "Master": 2},
    "internet_quality": {"Poor": 0, "Average": 1, "Good": 2},
    "extracurricular_participation": {"No": 0, "Yes": 1},
}

# Model feature order = raw order without key and target.
FEATURE_COLUMNS = [c for c in RAW_COLUMNS if c not in (KEY_COLUMN, TARGET_COLUMN)]
EXPECTED_FEATURE_COUNT = 14

# Numeric features kept raw in scored tables and tested for drift.
MONITOR_FEATURES = [
    "age",
    "study_hours_per_day",
    "social_media_hours",
    "netflix_hours",
    "attendance_percentage",
    "sleep_hours",
    "exercise_frequency",
    "mental_health_rating",
]

# Profiling column sets.
DERIVED_FEATURES = ["total_screen_time", "study_to_leisure_ratio"]
PROFILE_NUMERIC = MONITOR_FEATURES + DERIVED_FEATURES
OUTLIER_COLUMNS = MONITOR_FEATURES + [TARGET_COLUMN]
CORR_COLUMNS = PROFILE_NUMERIC + [TARGET_COLUMN]
SCATTER_FEATURES = [c for c in PROFILE_NUMERIC if c != "age"]
CATEGORICAL_COLUMNS = list(CATEGORY_MAPS)
LEVEL_ORDER = {
    "diet_quality": ["Poor", "Fair", "Good"],
    "parental_education_level": ["High School", "Bachelor", "Master"],
    "internet_quality": ["Poor", "Average", "Good"],
}
RATIO_EPSILON = 0.1

# Column to impute with its mode before encoding.
IMPUTE_COLUMNS = ["parental_education_level"]

# Text read as missing (pandas read_csv default NA tokens).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Whitespace removed by str.strip() for ASCII text.
STRIP_CHARS = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")

SCORE_MIN = 0.0
SCORE_MAX = 100.0
DRIFT_P_THRESHOLD = 0.05
ANOVA_P_THRESHOLD = 0.05
TUKEY_K = 1.5
SPLIT_SEED = 42
TEST_PERCENT = 20
CV_FOLDS = 5
HIST_BINS_TARGET = 30
HIST_BINS_FEATURE = 25
KDE_GRID_POINTS = 200
CORR_GUIDE = 0.1

# Request contract (API schema): column -> (type, lower bound, upper bound).
REQUEST_RULES = {
    "age": ("int", 0, 100),
    "study_hours_per_day": ("double", 0, None),
    "social_media_hours": ("double", 0, None),
    "netflix_hours": ("double", 0, None),
    "attendance_percentage": ("double", 0, 100),
    "sleep_hours": ("double", 0, 24),
    "exercise_frequency": ("int", 0, None),
    "mental_health_rating": ("int", 0, 10),
}

# What-if scenario: column -> (delta, lower clip, upper clip).
DRIFT_SCENARIO = {
    "study_hours_per_day": (2.0, None, 24.0),
    "social_media_hours": (-1.0, 0.0, None),
}

# Error texts of the scoring service, stream function and prediction core
# ({...} are filled per row). Request range messages follow the request
# schema validator's wording.
MSG_REQUEST_UNKNOWN_LEVEL = "Invalid value for {field}. Allowed values: {allowed}"
MSG_REQUEST_NOT_TEXT = "Invalid value for {field}. This field must be text"
MSG_REQUEST_MISSING = "{field}: field required"
MSG_REQUEST_BELOW = "{field}: must be greater than or equal to {bound}"
MSG_REQUEST_ABOVE = "{field}: must be less than or equal to {bound}"
MSG_EVENT_UNKNOWN_LEVEL = "Invalid value '{value}' for field '{field}'. Allowed: {allowed}"
MSG_EVENT_MISSING_FEATURES = "Missing required features: {names}"
MSG_EVENT_BAD_NUMBER = "could not convert value to float: '{value}'"
MSG_VECTOR_COUNT = "Student-habits input must contain exactly {expected} features, got {got}."
MSG_VECTOR_TYPES = "All features must be numeric (int or float)."
MSG_INDEX_RANGE = "sample_index must be between 0 and {last}"
MSG_NO_BATCHES = "No batch files found in {root}"

# Search grids.
RIDGE_ALPHAS = [0.1, 1.0, 10.0, 100.0]
LASSO_ALPHAS = [0.001, 0.01, 0.1, 1.0]
KNN_NEIGHBORS = [5, 10, 15, 20]
KNN_WEIGHTS = ["uniform", "distance"]
RF_GRID = {"numTrees": [100, 200], "maxDepth": [5, 10, 20], "minSplit": [2, 5]}
GBT_GRID = {"maxIter": [100, 200], "maxDepth": [3, 5], "stepSize": [0.05, 0.1]}
LASSO_MAX_ITER = 10000

BATCH_SAMPLE_SIZE = 100
MONITOR_SAMPLE_SIZE = 50
SELECTION_METRIC = "rmse"

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

_RAW_TYPES = {
    "student_id": T.StringType(),
    "age": T.IntegerType(),
    "gender": T.StringType(),
    "study_hours_per_day": T.DoubleType(),
    "social_media_hours": T.DoubleType(),
    "netflix_hours": T.DoubleType(),
    "part_time_job": T.StringType(),
    "attendance_percentage": T.DoubleType(),
    "sleep_hours": T.DoubleType(),
    "diet_quality": T.StringType(),
    "exercise_frequency": T.IntegerType(),
    "parental_education_level": T.StringType(),
    "internet_quality": T.StringType(),
    "mental_health_rating": T.IntegerType(),
    "extracurricular_participation": T.StringType(),
    "exam_score": T.DoubleType(),
}

RAW_SCHEMA = T.StructType([T.StructField(c, _RAW_TYPES[c], True) for c in RAW_COLUMNS])

SCORED_SCHEMA = T.StructType(
    [T.StructField(c, _RAW_TYPES[c], True) for c in MONITOR_FEATURES]
    + [
        T.StructField(TARGET_COLUMN, T.DoubleType(), True),
        T.StructField(PREDICTION_COLUMN, T.DoubleType(), True),
    ]
)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), True),
        T.StructField("batch_id", T.StringType(), True),
        T.StructField("batch_size", T.IntegerType(), True),
        T.StructField("num_drifted_features", T.IntegerType(), True),
        T.StructField("share_drifted_features", T.DoubleType(), True),
        T.StructField("drifted_feature_names", T.StringType(), True),
        T.StructField("rmse", T.DoubleType(), True),
        T.StructField("mae", T.DoubleType(), True),
        T.StructField("r2", T.DoubleType(), True),
        T.StructField("pred_mean", T.DoubleType(), True),
        T.StructField("pred_std", T.DoubleType(), True),
        T.StructField("pred_min", T.DoubleType(), True),
        T.StructField("pred_max", T.DoubleType(), True),
    ]
)

RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("run_name", T.StringType(), True),
        T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
        T.StructField("model_path", T.StringType(), True),
    ]
)

# A stream event after decoding: features arrive as text so that absent keys
# and unparsable numbers can be told apart from explicit values.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("student_id", T.StringType(), True),
        T.StructField("features", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("_corrupt_record", T.StringType(), True),
    ]
)
