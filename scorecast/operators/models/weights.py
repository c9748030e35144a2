"""Feature weights of a fitted model, by model kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .linear import LinearModel
from .trees import ForestModel


def feature_weights(spark: SparkSession, model) -> DataFrame:
    """Linear: scaled coefficient, effect per original unit, ordered by |effect|.
    Trees: impurity importances, ordered by importance. Other kinds
    (KNN, the averaging ensemble) have no per-feature weights."""
    if isinstance(model, LinearModel):
        scaled = model.coef_scaled() or [None] * len(model.coef)
        rows = [(c, float(s) if s is not None else None, float(b)) for c, b, s in zip(model.features, model.coef, scaled)]
        df = spark.createDataFrame(rows, "feature string, coef_scaled double, effect_per_original_unit double")
        return df.withColumn("abs_effect", F.abs("effect_per_original_unit")).orderBy(F.col("abs_effect").desc())
    if isinstance(model, ForestModel):
        rows = [(n, float(v)) for n, v in zip(model.binning.features, model.importances())]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())
    stages = getattr(getattr(model, "pipeline_model", None), "stages", None)
    if stages:
        assembler, est = stages[0], stages[-1]
        names = assembler.getInputCols()
        imp = est.featureImportances.toArray()
        rows = [(n, float(v)) for n, v in zip(names, imp)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())
    raise TypeError(f"{getattr(model, 'name', type(model).__name__)} has no per-feature weights")
