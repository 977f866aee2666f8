"""Trained forecasts: forest, boosted trees and least squares on MLlib."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.scalar import clip, risk_level, utilization
from zoneflow.ml.forecast import is_validation, linear_importance
from zoneflow.operators.cleaning import last_interval
from zoneflow.operators.grid import FEATURES, TARGET
from zoneflow.session import ensure_checkpoint_dir

# Settings of the trained models.
FOREST = {"numTrees": 200, "maxDepth": 30, "minInstancesPerNode": 2, "featureSubsetStrategy": "all"}
BOOSTED = {"maxIter": 350, "maxDepth": 7, "stepSize": 0.05, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.9"}
SEED = 42


def complete(df: DataFrame) -> DataFrame:
    """Features as doubles, missing ones as 0."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES})


def _spread(train: DataFrame) -> DataFrame:
    """Rows over all cores: every tree level scans them, and a small table may come as one partition."""
    ensure_checkpoint_dir(train.sparkSession)
    cores = train.sparkSession.sparkContext.defaultParallelism
    return complete(train).repartition(cores, "zone_id", "timestamp")


def _assembled(regressor) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), regressor])


def fit_forest(train: DataFrame, **overrides) -> PipelineModel:
    """Random forest over all features; depth is Spark's limit of 30.

    `featureSubsetStrategy='onethird'` gives the variant that tries a third of
    the features per split.
    """
    params = {**FOREST, **overrides}
    return _assembled(RandomForestRegressor(
        labelCol=TARGET, seed=SEED, maxMemoryInMB=1024, predictionCol="random_forest_prediction", **params
    )).fit(_spread(train))


def fit_boosted(train: DataFrame, **overrides) -> PipelineModel:
    """Boosted trees; columns are sampled per node, not per tree."""
    params = {**BOOSTED, **overrides}
    return _assembled(GBTRegressor(
        labelCol=TARGET, seed=SEED, maxMemoryInMB=1024, checkpointInterval=10,
        predictionCol="xgboost_prediction", **params
    )).fit(_spread(train))


def fit_linear(train: DataFrame) -> PipelineModel:
    return _assembled(LinearRegression(
        labelCol=TARGET, regParam=0.0, solver="normal", predictionCol="linear_prediction"
    )).fit(_spread(train))


def linear_coefficients(model: PipelineModel) -> tuple[float, dict[str, float]]:
    fitted = model.stages[-1]
    return float(fitted.intercept), dict(zip(FEATURES, (float(c) for c in fitted.coefficients)))


def importance(model: PipelineModel, train: DataFrame, name: str) -> DataFrame:
    """Feature weights that sum to 1, greatest first."""
    fitted = model.stages[-1]
    if hasattr(fitted, "coefficients"):
        shares = linear_importance(complete(train), linear_coefficients(model)[1])
    else:
        raw = [abs(float(v)) for v in fitted.featureImportances.toArray()]
        total = sum(raw)
        rows = [(f, v / total if total else 0.0) for f, v in zip(FEATURES, raw)]
        shares = train.sparkSession.createDataFrame(rows, "feature string, importance double")
    return shares.select(F.lit(name).alias("model"), "feature", "importance").orderBy(F.desc("importance"), "feature")


def score_recent(models: dict[str, PipelineModel], features: DataFrame, interval: str = "7 DAY") -> DataFrame:
    """Prediction table of the recent rows by every model, bounded by the capacity."""
    recent = complete(last_interval(features, "timestamp", interval))

    def scored(df: DataFrame, model: PipelineModel) -> DataFrame:
        return model.transform(df).drop("features")

    out = reduce(scored, models.values(), recent)
    columns = [m.stages[-1].getPredictionCol() for m in models.values()]
    out = out.withColumns({c: F.bround(clip(c, 0.0, F.col("capacity")), 1) for c in columns})
    return out.select(
        "timestamp", "zone_id", "current_occupancy", F.col(TARGET).alias("actual_occupancy"),
        F.col(columns[0]).alias("predicted_occupancy"), *columns, F.col("capacity").cast("int").alias("capacity"),
        risk_level(utilization(columns[0], "capacity")).alias("risk_level"),
        is_validation().alias("is_validation"),
    )
