"""Running occupancy, event identity and the state of each zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.functions.scalar import available_bays, clip, padded, risk_level, utilization
from zoneflow.operators.ordered import dense_index, running_sum_in_time

# Equal times are settled by event type (ENTRY before EXIT), then by id.
EVENT_ORDER = ["timestamp", "event_type", "event_id"]


def sessions_to_events(sessions: DataFrame) -> DataFrame:
    """One ENTRY and one EXIT row per stay, from a single scan of the stays."""
    def half(bit: int, kind: str, ts: str, minutes: Column) -> Column:
        return F.struct(
            F.concat(F.lit("E"), padded(F.col("session_id") * 2 + bit, 9)).alias("event_id"),
            F.col(ts).alias("timestamp"),
            F.lit(kind).alias("event_type"),
            minutes.cast("int").alias("parking_duration"),
        )

    both = F.array(half(0, "ENTRY", "entry_ts", F.lit(0)), half(1, "EXIT", "exit_ts", F.col("dwell_min")))
    kept = [c for c in sessions.columns if c not in ("session_id", "entry_ts", "exit_ts", "dwell_min", "zone_key")]
    return sessions.select(F.explode(both).alias("e"), *kept).select("e.*", *kept)


def running_occupancy(ev: DataFrame) -> DataFrame:
    """Add `occupancy`: the zone's running sum of +1/-1, clipped to [0, capacity] afterwards."""
    sign = F.when(F.col("event_type") == "ENTRY", 1).when(F.col("event_type") == "EXIT", -1).otherwise(0)
    summed = running_sum_in_time(ev.withColumn("_sign", sign), ["zone_id"], EVENT_ORDER, "_sign", "_inside")
    return (
        summed.withColumn("occupancy", clip(F.col("_inside"), 0, F.col("capacity")).cast("int"))
        .drop("_sign", "_inside")
    )


def assign_event_ids(ev: DataFrame, order: list[str], out: str = "event_id") -> DataFrame:
    """Dense ids `E00000001`, ... along a total order."""
    numbered = dense_index(ev, order, "_index")
    return numbered.withColumn(out, F.concat(F.lit("E"), padded(F.col("_index"), 8))).drop("_index")


def last_per_instant(ev: DataFrame) -> DataFrame:
    """Of several events of a zone at one time, the last in event order."""
    newest = Window.partitionBy("zone_id", "timestamp").orderBy(F.desc("event_type"), F.desc("event_id"))
    return ev.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def latest_per_zone(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Newest row per zone; the group limit runs before the shuffle."""
    newest = Window.partitionBy("zone_id").orderBy(*[F.desc(c) for c in order or ["timestamp"]])
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def zones_with_snapshot(zones: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Left join on zone and capacity: a snapshot taken at another capacity does not count."""
    return zones.join(snapshot, ["zone_id", "capacity"], "left")


def with_zone_names(df: DataFrame, zones: DataFrame, how: str = "left") -> DataFrame:
    """Add name and coordinates of the zone."""
    extra = [c for c in ("zone_name", "latitude", "longitude") if c not in df.columns]
    return df.join(zones.select("zone_id", *extra), "zone_id", how)


def with_lookup(df: DataFrame, dim: DataFrame, key: str, defaults: dict[str, object] | None = None) -> DataFrame:
    """Left join to a dimension, unmatched values replaced by `defaults`.

    Spark broadcasts `dim` when its size allows and splits hot keys otherwise.
    """
    joined = df.join(dim, key, "left")
    for column, value in (defaults or {}).items():
        joined = joined.withColumn(column, F.coalesce(F.col(column), F.lit(value)))
    return joined


def zone_state(
    zones: DataFrame,
    snapshot: DataFrame,
    live: DataFrame | None = None,
    manual: DataFrame | None = None,
) -> DataFrame:
    """Current state of every zone from the best source that has one.

    An operator observation wins over the latest live event, which wins over
    the stored snapshot; the first two only where their capacity is the zone's.
    """
    out = zones_with_snapshot(zones, snapshot.select("zone_id", "capacity", F.col("occupancy").alias("_stored")))
    occupancy = F.col("_stored").cast("double")
    source: Column = F.lit("STORED_SNAPSHOT")
    updated: Column = F.lit(None).cast("timestamp")
    confidence: Column = F.lit(0.65)

    for rows, prefix, default_source, default_confidence in (
        (live, "_live", "LIVE_EVENT", 0.9), (manual, "_manual", "MANUAL_GATE", 1.0),
    ):
        if rows is None:
            continue
        kind = F.col("source_type") if "source_type" in rows.columns else F.lit(None).cast("string")
        trust = F.col("confidence").cast("double") if "confidence" in rows.columns else F.lit(None).cast("double")
        newest = latest_per_zone(rows, [c for c in ("timestamp", "event_id") if c in rows.columns])
        out = out.join(
            newest.select(
                "zone_id",
                F.struct(
                    F.col("occupancy").cast("double").alias("occupancy"), F.col("capacity").alias("capacity"),
                    F.col("timestamp").alias("at"),
                    F.coalesce(kind, F.lit(default_source)).alias("source"),
                    F.coalesce(trust, F.lit(default_confidence)).alias("confidence"),
                ).alias(prefix),
            ),
            "zone_id", "left",
        )
        usable = F.coalesce(F.col(f"{prefix}.capacity") == F.col("capacity"), F.lit(False))
        occupancy = F.when(usable, F.col(f"{prefix}.occupancy")).otherwise(occupancy)
        source = F.when(usable, F.col(f"{prefix}.source")).otherwise(source)
        updated = F.when(usable, F.col(f"{prefix}.at")).otherwise(updated)
        confidence = F.when(usable, F.col(f"{prefix}.confidence")).otherwise(confidence)

    whole = F.bround(F.coalesce(occupancy, F.lit(0.0)), 0)
    return (
        out.withColumn("occupancy", clip(whole, 0, F.col("capacity")).cast("int"))
        .withColumn("source", source).withColumn("updated_at", updated).withColumn("confidence", confidence)
        .withColumn("utilization", F.bround(utilization("occupancy", "capacity"), 1))
        .withColumn("available", available_bays("occupancy", "capacity").cast("int"))
        .withColumn("risk", risk_level(F.col("utilization"), closed="right"))
        .drop("_stored", "_live", "_manual")
    )
