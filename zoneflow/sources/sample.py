"""Maps the driver's star-schema tables to zones, sessions and entry/exit events.

`nation` plays the zone dimension and each row of `events` a stay: its value is
the dwell in minutes, its user the vehicle, and `props.k` drives the weather.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.scalar import clip, padded, session_exit
from zoneflow.operators.occupancy import running_occupancy, sessions_to_events
from zoneflow.schema import EVENT, EVENT_COLUMNS
from zoneflow.session import once, save_table

EVENT_LOG = T.StructType([*EVENT, T.StructField("channel", T.StringType()), T.StructField("k", T.IntegerType())])
HOLIDAYS = ("2024-01-01", "2024-01-26")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read in UTC whatever the caller's session says."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("Z"), padded(key + 1, 3)).alias("zone_id"),
        F.col("n_name").alias("zone_name"),
        (2 + key % 4).cast("int").alias("capacity"),
        (19.0 + 0.01 * (key % 5)).alias("latitude"),
        (72.8 + 0.01 * F.floor(key / 5)).alias("longitude"),
        (0.5 + 0.01 * key).alias("peak_utilization_target"),
        (45.0 + 5.0 * (key % 10)).alias("mean_duration_min"),
        key.alias("zone_key"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k int").getField("k")
    entry = F.date_trunc("second", F.col("ts").cast("timestamp"))
    dwell = clip(F.round("value"), 5, 240).cast("int")
    stays = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("session_id"),
        F.concat(F.lit("V"), padded(F.col("user_id"), 5)).alias("vehicle_id"),
        (F.col("user_id") % 25).cast("int").alias("zone_key"),
        entry.alias("entry_ts"),
        dwell.alias("dwell_min"),
        (20.0 + props % 16).alias("temperature"),
        (F.greatest(F.lit(0), props - 60) / 10).alias("rainfall"),
        F.col("event_type").alias("channel"),
        props.alias("k"),
    )
    zone = zones(spark, sf_dir).select("zone_key", "zone_id", "capacity", "latitude", "longitude")
    return stays.join(zone, "zone_key").withColumn("exit_ts", session_exit("entry_ts", "dwell_min"))


def bare_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry and exit rows without the running occupancy."""
    return sessions_to_events(sessions(spark, sf_dir))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with running occupancy, derived once per application and stored.

    The stored log is what the analytics read, as they would read a day's
    cleaned files; `channel` and `k` stay on it to seed the dirty variants.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = once(spark, ("event_log", sf_dir), lambda: save_table(running_occupancy(bare_events(spark, sf_dir)), "event_log"))
    return spark.read.schema(EVENT_LOG).parquet(path)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select(*EVENT_COLUMNS)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as it might arrive: replays, negative dwell, overfull and unknown zones.

    Events of the `error` channel arrive twice; `arrival` is the unique order
    of delivery.
    """
    log = event_log(spark, sf_dir)
    number = F.expr("substring(event_id, 2)").cast("bigint")
    copies = F.when(F.col("channel") == "error", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    dirty = log.withColumn("copy", F.explode(copies))
    return dirty.select(
        "event_id", "timestamp", "vehicle_id",
        F.when((F.col("channel") == "view") & (F.col("k") < 3), F.lit("Z999")).otherwise(F.col("zone_id")).alias("zone_id"),
        "event_type",
        F.when((F.col("channel") == "signup") & (F.col("k") < 10), -F.col("parking_duration"))
        .otherwise(F.col("parking_duration")).alias("parking_duration"),
        F.when((F.col("channel") == "purchase") & (F.col("k") > 95), F.col("occupancy") + F.col("capacity"))
        .otherwise(F.col("occupancy")).alias("occupancy"),
        F.when((F.col("channel") == "click") & (F.col("k") == 50), F.lit(0)).otherwise(F.col("capacity")).alias("capacity"),
        "latitude", "longitude", "temperature", "rainfall",
        (F.col("copy").cast("bigint") * 1_000_000_000_000_000_000 + number).alias("arrival"),
    )


def operator_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations entered by staff: the `error` channel, re-read one bay fuller."""
    log = event_log(spark, sf_dir).where("channel = 'error'")
    return log.select(
        *[c for c in EVENT_COLUMNS if c != "occupancy"],
        F.least(F.col("occupancy") + 1, F.col("capacity")).alias("occupancy"),
        F.lit("MANUAL_GATE").alias("source_type"),
        F.lit(1.0).alias("confidence"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means of the sensor readings."""
    return (
        events(spark, sf_dir).groupBy(F.to_date("timestamp").alias("date"))
        .agg(F.avg("temperature").alias("temperature"), F.avg("rainfall").alias("rainfall"))
    )
