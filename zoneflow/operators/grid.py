"""Regular time grid per zone, as-of resampling and the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.functions.scalar import day_of_week, is_holiday, is_weekend

STEP_MINUTES = 30
DEFAULT_DWELL = 30.0

# Model inputs in their order.
FEATURES = (
    "hour", "day_of_week", "is_weekend", "is_holiday", "temperature", "rainfall",
    "current_occupancy", "capacity", "average_duration",
)
TARGET = "future_occupancy"


def day_bounds(ev: DataFrame, minutes: int = STEP_MINUTES) -> tuple[Column, Column]:
    """First and last grid time of the days the events touch, as constants.

    One small job reads the time column; plans over the grid then hold two
    literals in place of repeated subqueries.
    """
    day_end = F.date_trunc("day", F.max("timestamp")) + F.make_dt_interval(mins=F.lit(24 * 60 - minutes))
    row = ev.agg(
        F.unix_micros(F.date_trunc("day", F.min("timestamp"))).alias("first"), F.unix_micros(day_end).alias("last"),
    ).first()
    return tuple(F.timestamp_micros(F.lit(row[c]).cast("bigint")) for c in ("first", "last"))


def time_grid(zones: DataFrame, start: Column, end: Column, minutes: int = STEP_MINUTES) -> DataFrame:
    """Every grid time from start to end for every zone.

    Zones are spread over all cores first, so each task expands only its own.
    The number is given: by size alone Spark would keep the few zones together.
    """
    steps = F.sequence(start, end, F.make_dt_interval(mins=F.lit(minutes)))
    cores = zones.sparkSession.sparkContext.defaultParallelism
    return zones.repartition(cores, "zone_id").withColumn("timestamp", F.explode(steps))


def resample_asof(ev: DataFrame, grid: DataFrame, start: Column, minutes: int = STEP_MINUTES) -> DataFrame:
    """Occupancy at or before each grid time, 0 before a zone's first event.

    Events are first reduced to the last one per grid step, so the carried
    window runs over the calendar and never over a hot zone's events.
    """
    step = minutes * 60 * 1_000_000
    since = F.greatest(F.lit(0), F.unix_micros("timestamp") - F.unix_micros(start))
    # Round up to the first grid time that is not before the event.
    slot = F.timestamp_micros(F.unix_micros(start) + since + F.pmod(-since, F.lit(step)))
    last = ev.groupBy("zone_id", slot.alias("timestamp")).agg(
        F.max_by("occupancy", F.struct("timestamp", "event_type", "event_id")).alias("_seen")
    )
    history = Window.partitionBy("zone_id").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    carried = F.last("_seen", ignorenulls=True).over(history)
    return (
        grid.join(last, ["zone_id", "timestamp"], "left")
        .withColumn("current_occupancy", F.coalesce(carried, F.lit(0)).cast("double")).drop("_seen")
    )


def future_target(grid: DataFrame) -> DataFrame:
    """Occupancy one step later in the same zone; the last step of a zone has none and goes."""
    ahead = F.lead("current_occupancy").over(Window.partitionBy("zone_id").orderBy("timestamp"))
    return grid.withColumn(TARGET, ahead).na.drop(subset=[TARGET])


def average_duration(ev: DataFrame) -> DataFrame:
    return ev.where("event_type = 'EXIT'").groupBy("zone_id").agg(
        F.bround(F.avg("parking_duration"), 1).alias("average_duration")
    )


def build_features(
    ev: DataFrame,
    zones: DataFrame,
    weather: DataFrame,
    holidays: tuple[str, ...] = (),
    minutes: int = STEP_MINUTES,
) -> DataFrame:
    """Feature table: grid, as-of occupancy, calendar, weather, mean dwell and target."""
    start, end = day_bounds(ev, minutes)
    grid = time_grid(zones.select("zone_id", "capacity"), start, end, minutes)
    current = future_target(resample_asof(ev, grid, start, minutes))
    joined = (
        current.withColumn("date", F.to_date("timestamp"))
        .join(weather.select("date", "temperature", "rainfall"), "date", "left")
        .join(average_duration(ev), "zone_id", "left")
    )
    return joined.select(
        "timestamp", "zone_id", F.hour("timestamp").alias("hour"),
        day_of_week("timestamp").alias("day_of_week"), is_weekend("timestamp").alias("is_weekend"),
        is_holiday("timestamp", holidays).alias("is_holiday"), "temperature", "rainfall",
        "current_occupancy", "capacity",
        F.coalesce("average_duration", F.lit(DEFAULT_DWELL)).alias("average_duration"), TARGET,
    )
