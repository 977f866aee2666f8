"""Row validity, duplicates, defaults, filters and search."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.functions.scalar import available_bays, literal_pattern, utilization


def valid_events(ev: DataFrame) -> DataFrame:
    """Rows with identity, time, a non-negative occupancy and a capacity."""
    return ev.where(
        F.col("event_id").isNotNull() & F.col("timestamp").isNotNull()
        & (F.col("occupancy") >= 0) & (F.col("capacity") > 0)
    )


def first_copy(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row of each key in `order`.

    Each task keeps one row per key before the shuffle, so a key repeated
    without end costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rn", rank).where("_rn = 1").drop("_rn")


_SANE = "occupancy >= 0 AND capacity > 0 AND parking_duration >= 0"


def clean_events(ev: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """One row per event id, then only sane counts and durations."""
    return first_copy(ev, "event_id", order).where(_SANE)


def clean_report(ev: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Row counts before and after cleaning, from one pass."""
    before = F.count("*").alias("rows_in")
    per_id = ev.groupBy("event_id").agg(
        before, F.min_by(F.expr(f"coalesce({_SANE}, false)"), F.struct(*order)).alias("_ok")
    )
    return per_id.agg(
        F.sum("rows_in").alias("rows_before"), F.count_if("_ok").alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def mark_duplicates(ev: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add `is_duplicate` and `status`: the first arrival of an id is verified, later ones are dropped.

    Only ids seen twice reach the join; Spark splits a hot id there.
    """
    arrival = F.struct(*order)
    repeated = (
        ev.groupBy("event_id").agg(F.count("*").alias("_n"), F.min(arrival).alias("_first"))
        .where("_n > 1").drop("_n")
    )
    late = F.coalesce(arrival > F.col("_first"), F.lit(False))
    return (
        ev.join(repeated, "event_id", "left")
        .withColumn("is_duplicate", late).drop("_first")
        .withColumn("status", F.when(F.col("is_duplicate"), "DROP").otherwise("VERIFIED"))
    )


def with_utilization(df: DataFrame, clipped: bool = False, out: str = "utilization") -> DataFrame:
    return df.withColumn(out, utilization("occupancy", "capacity", clipped))


def with_available(df: DataFrame, out: str = "available") -> DataFrame:
    return df.withColumn(out, available_bays("occupancy", "capacity"))


def drop_missing(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.na.fill(defaults)


def to_serving(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Columns of a serving table: source name -> served name."""
    return df.select(*[F.col(source).alias(name) for source, name in mapping.items()])


def filter_zones(df: DataFrame, zones: Sequence[str] | None, ignore_case: bool = False) -> DataFrame:
    """Keep the named zones; no names, or ALL alone, keep everything."""
    wanted = [z for z in zones or [] if z and z != "ALL"]
    if not wanted:
        return df
    if ignore_case:
        return df.where(F.upper("zone_id").isin([z.upper() for z in wanted]))
    return df.where(F.col("zone_id").isin(wanted))


def search_rows(df: DataFrame, pattern: str, regex: bool = True) -> DataFrame:
    """Rows where any column, read as text, matches without regard to case."""
    expr = "(?i)" + (pattern if regex else literal_pattern(pattern))
    hits = [F.coalesce(F.col(c).cast("string").rlike(expr), F.lit(False)) for c in df.columns]
    return df.where(reduce(Column.__or__, hits))


def last_interval(df: DataFrame, ts: str, interval: str) -> DataFrame:
    """Rows within `interval` of the newest row; the bound is a scalar the scan can use."""
    cutoff = df.agg((F.max(ts) - F.expr(f"INTERVAL {interval}")).alias("cutoff"))
    return df.where(F.col(ts) >= cutoff.scalar())


def clamp_days(days: int) -> int:
    return min(120, max(1, int(days)))


def last_days(ev: DataFrame, days: int) -> DataFrame:
    return last_interval(ev, "timestamp", f"{clamp_days(days)} DAY")


def range_report(ev: DataFrame, days: int) -> DataFrame:
    """What is available, what the last `days` days cover, and whether data is missing at the start."""
    days = clamp_days(days)
    cutoff = ev.agg((F.max("timestamp") - F.expr(f"INTERVAL {days} DAY")).alias("c")).scalar()
    whole = ev.agg(
        F.min("timestamp").alias("available_start"), F.max("timestamp").alias("available_end"),
        F.min(F.when(F.col("timestamp") >= cutoff, F.col("timestamp"))).alias("start"),
    )
    seconds = F.col("available_end").cast("double") - F.col("start").cast("double")
    return whole.select(
        F.lit(days).alias("requested_days"),
        F.round(F.coalesce(seconds / 86400, F.lit(0.0)), 1).alias("coverage_days"),
        "start", F.col("available_end").alias("end"), "available_start", "available_end",
        F.coalesce(
            F.col("available_start") > F.col("available_end") - F.expr(f"INTERVAL {days} DAY"), F.lit(False)
        ).alias("truncated"),
    )


def vacancy_band(zones: DataFrame) -> DataFrame:
    """Flags for the three map filters; critical overlaps the other two."""
    return (
        zones.withColumn("is_vacancy", F.col("available") > 40)
        .withColumn("is_moderate", F.col("available").between(10, 40))
        .withColumn("is_critical", F.col("utilization") >= 85)
    )


def band_counts(zones: DataFrame) -> DataFrame:
    return vacancy_band(zones).agg(
        F.count("*").alias("all_zones"), F.count_if("is_vacancy").alias("vacancy"),
        F.count_if("is_moderate").alias("moderate"), F.count_if("is_critical").alias("critical"),
    )


def match_zone_text(zones: DataFrame, text: str) -> DataFrame:
    return zones.where(F.lower(F.concat_ws(" ", "zone_id", "zone_name")).contains(text.lower()))


def union_events(preferred: DataFrame, stored: DataFrame) -> DataFrame:
    """Both inputs by column name; where both hold an id, the preferred row stays."""
    both = preferred.withColumn("_source", F.lit(0)).unionByName(
        stored.withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    return first_copy(both, "event_id", ["_source", "timestamp"]).drop("_source")
