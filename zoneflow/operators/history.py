"""History roll-ups: trends, heatmap, flow, dwell, weather and their summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.functions.scalar import bucket, clip, day_of_week, utilization
from zoneflow.operators.ordered import quantile, ranked_values, upper_median

FEE_PER_EXIT = 60

# Upper bounds of the dwell bins in minutes and their labels.
DWELL_BOUNDS = (15, 30, 60, 120, 180, 240)
DWELL_LABELS = ("0-15m", "15-30m", "30-60m", "1-2h", "2-3h", "3-4h", "4h+")

# Most points a series keeps.
MAX_POINTS = {"hourly": 720, "daily": 120, "weekly": 120}


def _row_utilization() -> Column:
    return utilization(F.coalesce("occupancy", F.lit(0)), "capacity", clipped=True)


def history_trend(ev: DataFrame, zones: DataFrame) -> DataFrame:
    """Mean occupancy per hour and zone; a zone the dimension lacks counts as capacity 1."""
    hourly = ev.groupBy(bucket("timestamp", "hourly").alias("timestamp"), "zone_id").agg(
        F.avg("occupancy").alias("occupancy")
    )
    joined = hourly.join(zones.select("zone_id", "capacity"), "zone_id", "left")
    capacity = F.coalesce("capacity", F.lit(1))
    share = F.coalesce("occupancy", F.lit(0.0)) / capacity * 100
    return joined.withColumn("capacity", capacity).withColumn("utilization", clip(share, 0.0, 100.0))


def heatmap(ev: DataFrame) -> DataFrame:
    return ev.groupBy(
        "zone_id", day_of_week("timestamp").alias("day_of_week"), F.hour("timestamp").alias("hour")
    ).agg(F.avg("occupancy").alias("occupancy"), F.avg(_row_utilization()).alias("utilization"))


def heatmap_network(heat: DataFrame) -> DataFrame:
    """Complete 7 x 24 matrix, each cell the mean of its zones' means and 0 where empty."""
    cells = heat.groupBy("day_of_week", "hour").agg(F.avg("utilization").alias("_u"))
    spine = heat.sparkSession.range(7 * 24).select(
        F.floor(F.col("id") / 24).cast("int").alias("day_of_week"), (F.col("id") % 24).cast("int").alias("hour")
    )
    return spine.join(cells, ["day_of_week", "hour"], "left").select(
        "day_of_week", "hour", F.coalesce("_u", F.lit(0.0)).alias("utilization")
    )


def peak_slot(heat: DataFrame, keys: tuple[str, ...] = ("day_of_week", "hour")) -> DataFrame:
    """Slot with the greatest utilization, the first in day and hour order on a tie."""
    return heat.orderBy(F.desc("utilization"), *keys).limit(1)


def hourly_flow(ev: DataFrame, zones: DataFrame, fee: int = FEE_PER_EXIT) -> DataFrame:
    """Entries and exits per hour and zone, turnover in percent and revenue."""
    counts = ev.groupBy(bucket("timestamp", "hourly").alias("bucket"), "zone_id").agg(
        F.count_if(F.col("event_type") == "ENTRY").alias("entry"),
        F.count_if(F.col("event_type") == "EXIT").alias("exit"),
    )
    joined = counts.join(zones.select("zone_id", "capacity"), "zone_id", "left")
    return (
        joined.withColumn("capacity", F.coalesce("capacity", F.lit(1)))
        .withColumn("turnover_rate", (F.col("entry") + F.col("exit")) / F.col("capacity") * 100)
        .withColumn("estimated_revenue", F.col("exit") * fee)
    )


def dwell_histogram(ev: DataFrame) -> DataFrame:
    """Counts and shares of seven dwell bins, with the mean and both medians of all stays.

    One scan reduces the stays to a count per length; the rest works on those.
    """
    stays = ev.where(F.col("parking_duration") > 0).select(
        F.lit(1).alias("_all"), F.col("parking_duration").alias("minutes")
    )
    ranked = ranked_values(stays, ["_all"], "minutes")
    index = F.lit(len(DWELL_BOUNDS))
    for i in reversed(range(len(DWELL_BOUNDS))):
        index = F.when(F.col("minutes") < DWELL_BOUNDS[i], i).otherwise(index)
    bins = ranked.groupBy("_all", index.alias("bin")).agg(F.sum("n").alias("stays"), F.max("total").alias("_total"))
    overall = ranked.groupBy("_all").agg(
        (F.sum(F.col("minutes") * F.col("n")) / F.sum("n")).alias("mean_minutes"),
        quantile("minutes", 0.5).alias("median_minutes"), upper_median("minutes").alias("upper_median_minutes"),
    )
    labels = F.array(*[F.lit(x) for x in DWELL_LABELS])
    return bins.join(overall, "_all").select(
        "bin", labels[F.col("bin")].alias("label"), "stays",
        (F.col("stays") / F.col("_total") * 100).alias("share_pct"),
        "mean_minutes", "median_minutes", "upper_median_minutes",
    )


def weather_by_hour(ev: DataFrame) -> DataFrame:
    return ev.groupBy(F.hour("timestamp").alias("hour")).agg(
        F.avg("occupancy").alias("occupancy"), F.avg(_row_utilization()).alias("utilization"),
        F.avg("temperature").alias("temperature"), F.avg("rainfall").alias("rainfall"),
    )


def rain_effect(hours: DataFrame) -> DataFrame:
    """Utilization of rainy hours minus that of dry hours, empty sides counting as 0."""
    rainy = F.avg(F.when(F.col("rainfall") > 0, F.col("utilization")))
    dry = F.avg(F.when(F.col("rainfall") == 0, F.col("utilization")))
    return hours.agg(
        F.count_if(F.col("rainfall") > 0).alias("rain_hours"),
        (F.coalesce(rainy, F.lit(0.0)) - F.coalesce(dry, F.lit(0.0))).alias("rain_gap"),
    )


def history_summary(ev: DataFrame, fee: int = FEE_PER_EXIT) -> DataFrame:
    """Headline figures of a period, all from one pre-aggregation by zone, day and hour.

    The events are read once; the peak, the rain hours and the totals are
    rolled up from at most 168 rows per zone.
    """
    pct = _row_utilization()
    cells = ev.groupBy(
        "zone_id", day_of_week("timestamp").alias("day_of_week"), F.hour("timestamp").alias("hour")
    ).agg(
        F.count("*").alias("n"), F.sum(pct).alias("pct"),
        F.sum(F.when(F.col("parking_duration") > 0, F.col("parking_duration"))).alias("minutes"),
        F.count_if(F.col("parking_duration") > 0).alias("stays"),
        F.count_if(F.col("event_type") == "EXIT").alias("exits"),
        F.sum("rainfall").alias("rain"), F.count("rainfall").alias("rain_n"),
    )
    slot = F.struct(
        F.round(F.col("pct") / F.col("n"), 9).alias("u"), (-F.col("day_of_week")).alias("d"), (-F.col("hour")).alias("h")
    )
    hours = cells.groupBy("hour").agg(
        F.sum("n").alias("n"), F.sum("pct").alias("pct"), F.sum("minutes").alias("minutes"),
        F.sum("stays").alias("stays"), F.sum("exits").alias("exits"), F.max(slot).alias("best"),
        (F.coalesce(F.sum("rain") / F.sum("rain_n"), F.lit(0.0)) > 0).alias("rainy"),
    )
    best = F.max("best")
    return hours.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
        F.round(F.coalesce(F.sum("pct") / F.sum("n"), F.lit(0.0)), 1).alias("average_utilization"),
        F.round(F.coalesce(F.sum("minutes") / F.sum("stays"), F.lit(0.0)), 1).alias("average_dwell_minutes"),
        (-best["d"]).alias("peak_day_of_week"), (-best["h"]).alias("peak_hour"),
        F.round(best["u"], 1).alias("peak_utilization"),
        F.coalesce(F.sum("exits") * fee, F.lit(0)).alias("estimated_revenue"),
        F.count_if("rainy").alias("rain_affected_hours"),
    )


def rollup_series(df: DataFrame, value: str, resolution: str, how: str = "mean", ts: str = "timestamp") -> DataFrame:
    """Series at a coarser resolution: the mean per zone, or the sum across zones."""
    key = bucket(ts, resolution).alias("bucket")
    filled = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    if how == "mean":
        return df.groupBy("zone_id", key).agg(F.avg(filled).alias("value"))
    if how == "sum":
        return df.groupBy(key).agg(F.sum(filled).alias("value"))
    raise ValueError("how must be 'mean' or 'sum'")


def downsample(series: DataFrame, max_points: int, by: tuple[str, ...] = ("zone_id",), order: str = "bucket") -> DataFrame:
    """Every ceil(n / max)-th point of each series, and its last.

    A series has one point per bucket, so its length follows the calendar and
    not the number of events.
    """
    whole = Window.partitionBy(*by)
    numbered = series.withColumn("_n", F.count("*").over(whole)).withColumn(
        "_i", F.row_number().over(whole.orderBy(order))
    )
    step = F.greatest(F.lit(1), F.ceil(F.col("_n") / max_points))
    return numbered.where(((F.col("_i") - 1) % step == 0) | (F.col("_i") == F.col("_n"))).drop("_n", "_i")


def points_for(resolution: str) -> int:
    return MAX_POINTS[resolution]

