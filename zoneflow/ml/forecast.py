"""Forecasts that are plain column expressions, and what is read off them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.scalar import available_bays, clip, risk_level, utilization
from zoneflow.operators.aggregates import regression_metrics
from zoneflow.operators.occupancy import latest_per_zone

# Published linear model.
LINEAR_INTERCEPT = -0.17439350066308634
LINEAR_COEFFICIENTS = {
    "hour": 0.04460364854107772,
    "day_of_week": -0.04790000512139525,
    "is_weekend": 0.24025251427531252,
    "is_holiday": 0.5214346752849233,
    "temperature": -0.007583898896045734,
    "rainfall": 0.03789520921855526,
    "current_occupancy": 0.8995140338914603,
    "capacity": 0.02931654235965693,
    "average_duration": -0.002831618017382227,
}

# What-if presets (hour, rain, temperature, share of capacity, dwell, holiday).
SCENARIOS = {
    "monsoon": (18, 42.0, 25.0, 0.72, 105.0, 0),
    "match": (19, 0.0, 30.0, 0.82, 140.0, 1),
    "festival": (20, 2.0, 29.0, 0.88, 165.0, 1),
    "weekday": (18, 0.0, 31.0, 0.62, 80.0, 0),
}

# Width of the 95 % band in standard errors, critical load.
BAND_WIDTH = 1.96
CRITICAL_PCT = 85


def score_linear(coefficients: dict[str, float] = LINEAR_COEFFICIENTS, intercept: float = LINEAR_INTERCEPT) -> Column:
    """Intercept plus weighted features; a missing feature counts as 0."""
    total = F.lit(intercept)
    for name, weight in coefficients.items():
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * weight
    return total


def forecast_analytical(
    occupancy: Column, capacity: Column, hour: Column, rainfall: Column, dwell: Column,
    holiday: Column | None = None,
) -> Column:
    """Half-hour forecast from persistence plus hour, holiday, rain and dwell effects, within capacity."""
    peak = (
        F.when(hour.between(8, 10) | hour.between(17, 21), 0.13).when(hour <= 5, -0.04).otherwise(0.02)
    )
    event = F.when(holiday == 1, 0.08).otherwise(0.0) if holiday is not None else F.lit(0.0)
    rain = F.least(F.lit(0.09), F.coalesce(rainfall, F.lit(0.0)) / 1000)
    stay = clip((dwell - 75) / 2500, -0.03, 0.06)
    raw = occupancy * 0.82 + capacity * (F.lit(0.09) + peak + event + rain + stay)
    return clip(raw, 0.0, capacity)


def network_forecast(state: DataFrame, hour: int, rainfall: float = 0.0) -> DataFrame:
    """Forecast of every zone's state, with the hubs expected to reach the critical load."""
    forecast = forecast_analytical(
        F.col("occupancy").cast("double"), F.col("capacity").cast("double"), F.lit(hour), F.lit(rainfall),
        F.col("mean_duration_min"),
    )
    out = state.withColumn("_f", forecast)
    load = F.bround(utilization("_f", "capacity", clipped=True), 1)
    return (
        out.withColumn("forecast_occupancy_30m", F.bround("_f", 1)).withColumn("forecast_utilization_30m", load)
        .withColumn("is_risk_hub", F.col("forecast_utilization_30m") >= CRITICAL_PCT).drop("_f")
    )


def predictions(features: DataFrame) -> DataFrame:
    """Prediction table from the two portable models: analytical first, linear beside it."""
    analytical = forecast_analytical(
        F.col("current_occupancy"), F.col("capacity").cast("double"), F.col("hour"), F.col("rainfall"),
        F.col("average_duration"), F.col("is_holiday"),
    )
    linear = clip(score_linear(), 0.0, F.col("capacity").cast("double"))
    return features.select(
        "timestamp", "zone_id", "current_occupancy", F.col("future_occupancy").alias("actual_occupancy"),
        analytical.alias("predicted_occupancy"), linear.alias("linear_prediction"), "capacity",
        risk_level(utilization(analytical, F.col("capacity"))).alias("risk_level"),
        is_validation().alias("is_validation"),
    )


def is_validation() -> Column:
    """1 for the fifth of the rows held out, by a hash of the key that any engine repeats."""
    key = F.concat_ws("|", "zone_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 5 == 0).cast("int")


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows."""
    marked = df.withColumn("is_validation", is_validation())
    return (marked.where("is_validation = 0").drop("is_validation"),
            marked.where("is_validation = 1").drop("is_validation"))


def linear_importance(train: DataFrame, coefficients: dict[str, float] = LINEAR_COEFFICIENTS) -> DataFrame:
    """Absolute coefficient times population deviation, normalized to sum 1."""
    spread = train.agg(*[
        F.abs(F.lit(weight) * F.coalesce(F.stddev_pop(F.col(name).cast("double")), F.lit(0.0))).alias(name)
        for name, weight in coefficients.items()
    ])
    total = sum((F.col(c) for c in coefficients), F.lit(0.0))
    shares = spread.select(*[F.when(total > 0, F.col(c) / total).otherwise(F.lit(0.0)).alias(c) for c in coefficients])
    return shares.unpivot([], list(coefficients), "feature", "importance").orderBy(F.desc("importance"), "feature")


def zone_forecasts(pred: DataFrame, column: str = "predicted_occupancy") -> DataFrame:
    """Latest prediction of each zone as occupancy and load."""
    latest = latest_per_zone(pred.na.drop(subset=[column]))
    return latest.select(
        "zone_id", F.col(column).alias("predicted_occupancy"), "capacity",
        utilization(column, "capacity").alias("forecast_utilization"),
    )


def prediction_band(pred: DataFrame, column: str = "predicted_occupancy", per_row: bool = False) -> DataFrame:
    """95 % band around the latest prediction of each zone, or around every prediction.

    The half width is 1.96 times the zone's RMSE, at least one bay.
    """
    rmse = regression_metrics(pred, [column], by_zone=True).select("zone_id", "rmse")
    points = pred if per_row else latest_per_zone(pred.na.drop(subset=[column]))
    half = F.greatest(F.lit(1.0), F.coalesce("rmse", F.lit(0.0)) * BAND_WIDTH)
    room = F.col("capacity").cast("double")
    point = F.col(column)
    out = points.join(rmse, "zone_id", "left").select(
        "zone_id", "timestamp", point.alias("predicted_occupancy"), "capacity",
        clip(point - half, 0.0, room).alias("confidence_low"), clip(point + half, 0.0, room).alias("confidence_high"),
        available_bays(point, room).alias("available"),
        (point - F.col("current_occupancy")).alias("net_change"),
        utilization(column, "capacity").alias("utilization"),
    )
    return out.withColumn("risk", risk_level(F.col("utilization")))


def scenarios(zones: DataFrame, day: int = 0) -> DataFrame:
    """Each preset scored for each zone by both portable models."""
    presets = F.array(*[
        F.struct(
            F.lit(name).alias("scenario"), F.lit(hour).alias("hour"), F.lit(rain).alias("rainfall"),
            F.lit(temp).alias("temperature"), F.lit(share).alias("share"), F.lit(dwell).alias("average_duration"),
            F.lit(holiday).alias("is_holiday"),
        )
        for name, (hour, rain, temp, share, dwell, holiday) in SCENARIOS.items()
    ])
    rows = zones.select("zone_id", "capacity", F.explode(presets).alias("p")).select("zone_id", "capacity", "p.*")
    inputs = (
        rows.withColumn("current_occupancy", F.floor(F.col("capacity") * F.col("share") + 0.5).cast("double"))
        .withColumn("day_of_week", F.lit(day)).withColumn("is_weekend", F.lit(int(day >= 5)))
    )
    room = F.col("capacity").cast("double")
    analytical = forecast_analytical(
        F.col("current_occupancy"), room, F.col("hour"), F.col("rainfall"), F.col("average_duration"), F.col("is_holiday"),
    )
    return inputs.select(
        "zone_id", "scenario", "capacity", "current_occupancy",
        analytical.alias("analytical_forecast"), clip(score_linear(), 0.0, room).alias("linear_forecast"),
        risk_level(utilization(analytical, F.col("capacity"))).alias("risk"),
    )


def risk_matrix(state: DataFrame, forecasts: DataFrame, k: int = 10) -> DataFrame:
    """Fullest zones by forecast, falling back from the model to the half-hour forecast to the present."""
    chosen = forecasts.select(
        "zone_id", F.col("predicted_occupancy").alias("_p"), F.col("forecast_utilization").alias("_u")
    )
    half_hour = F.col("forecast_occupancy_30m") if "forecast_occupancy_30m" in state.columns else F.lit(None)
    half_load = F.col("forecast_utilization_30m") if "forecast_utilization_30m" in state.columns else F.lit(None)
    predicted = F.coalesce(F.col("_p"), half_hour, F.col("occupancy").cast("double"))
    joined = state.join(chosen, "zone_id", "left").withColumn("predicted", predicted)
    load = F.coalesce(F.col("_u"), half_load, utilization("predicted", "capacity"))
    ranked = joined.withColumn("projected_utilization", load).orderBy(F.desc("projected_utilization"), "zone_id").limit(k)
    return ranked.select(
        "zone_id", "zone_name", "predicted", "capacity", "projected_utilization",
        risk_level(F.col("projected_utilization"), labels=("NORMAL", "MODERATE", "CRITICAL")).alias("band"),
    )


def weather_now(live: DataFrame, ev: DataFrame) -> DataFrame:
    """Temperature and rainfall from the live reading, each falling back to the newest stored event."""
    order = F.struct("timestamp", "event_id")
    stored = ev.agg(F.max_by("temperature", order).alias("t"), F.max_by("rainfall", order).alias("r"))
    reading = live.agg(F.max("temperature").alias("t"), F.max("rainfall").alias("r"))
    return stored.select(
        F.coalesce(reading.select("t").scalar(), F.col("t")).alias("temperature"),
        F.coalesce(reading.select("r").scalar(), F.col("r")).alias("rainfall"),
    )
