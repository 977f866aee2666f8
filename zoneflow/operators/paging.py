"""Newest rows, pages and the fixed query templates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.operators.cleaning import union_events
from zoneflow.operators.ordered import dense_index
from zoneflow.session import write_table

# Up to here a page is a top-k; beyond it a single task would hold too much. Both ways give the same rows in the same order.
TOP_K_ROWS = 100_000
# Rows from which on the newest events are looked up by time first. Both ways give the same rows in the same order.
INDEX_FROM = 1_000_000


def newest_since(rows: DataFrame, ts: str, wanted: int) -> datetime | None:
    """The latest second since which there are at least `wanted` rows; None if there are fewer with a time at all.

    Rows are counted by hour, then by second inside the hour in question: two
    small aggregates, whatever the length of the log.
    """
    def since(part: DataFrame, unit: str, need: int) -> tuple[datetime | None, int]:
        counts = part.where(F.col(ts).isNotNull()).groupBy(F.date_trunc(unit, ts).alias("t")).agg(F.count("*").alias("n"))
        newest = Window.orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
        # At most an hour's seconds, or the log's hours.
        found = counts.withColumn("upto", F.sum("n").over(newest)).where(F.col("upto") >= need).orderBy("upto").select("t", (F.col("upto") - F.col("n")).alias("later")).first()
        return (found["t"], found["later"]) if found else (None, 0)

    hour, later = since(rows, "hour", wanted)
    if hour is None:
        return None
    inside = rows.where((F.col(ts) >= F.lit(hour)) & (F.col(ts) < F.lit(hour) + F.expr("INTERVAL 1 HOUR")))
    return since(inside, "second", wanted - later)[0]


def recent_events(stored: DataFrame, manual: DataFrame | None = None, n: int = 2000, index_from: int = INDEX_FROM) -> DataFrame:
    """Newest `n` events over stored and operator rows, an operator row winning its id.

    Which copy of an id stays must be known before the newest can be told. A
    log of `index_from` rows or more is not shuffled for it: only ids with a
    row in the shortest end of the log that may suffice are, with all their
    copies, and the end is made longer as long as fewer than `n` of them stay.
    """
    order = (F.desc("timestamp"), F.desc("event_id"))
    if manual is None:
        return stored.orderBy(*order).limit(n)
    both = manual.select("event_id", "timestamp").unionByName(stored.select("event_id", "timestamp"))
    total, wanted = (both.count() if index_from else index_from), 2 * n
    while total >= index_from and n > 0 and (start := newest_since(both, "timestamp", wanted)) is not None:
        ids = write_table(both.where(F.col("timestamp") >= F.lit(start)).select(F.col("event_id").alias("_id")).distinct(), "newest")
        own = [df.join(ids, F.col("event_id").eqNullSafe(F.col("_id")), "left_semi") for df in (manual, stored)]
        kept = write_table(union_events(*own).where(F.col("timestamp") >= F.lit(start)), "recent")
        if kept.count() >= n:
            return kept.orderBy(*order).limit(n)
        wanted *= 4
    return union_events(manual, stored).orderBy(*order).limit(n)


def page_info(df: DataFrame, page: int, limit: int, clamp: bool = True) -> DataFrame:
    """Total rows, number of pages and the page in effect."""
    pages = F.greatest(F.lit(1), F.ceil(F.col("total") / limit)).cast("int")
    asked = F.lit(max(1, page))
    return df.agg(F.count("*").alias("total")).withColumn("pages", pages).withColumn(
        "page", F.least(asked, F.col("pages")) if clamp else asked
    )


def page(df: DataFrame, page: int, limit: int, order: list[str], clamp: bool = True) -> DataFrame:
    """Rows of one page along the unique order `order` (`-name` for descending)."""
    number = max(1, page)
    if clamp:
        number = page_info(df, page, limit).first()["page"]
    start = (number - 1) * limit
    if start + limit <= TOP_K_ROWS:
        return df.orderBy(*_keys(order)).offset(start).limit(limit)
    return deep_page(df, start, limit, order)


def deep_page(df: DataFrame, start: int, limit: int, order: list[str]) -> DataFrame:
    """Page in order by distributed row number, whatever its offset; directions may be mixed."""
    indexed = dense_index(df, _keys(order), "_index")
    return indexed.where(F.col("_index").between(start + 1, start + limit)).orderBy("_index").drop("_index")


def last_points(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The last `n` rows along `order`, in that order: the tail of a series."""
    back = [c[1:] if c.startswith("-") else f"-{c}" for c in order]
    return df.orderBy(*_keys(back)).limit(n).orderBy(*_keys(order))


def _keys(order: list[str]) -> list[Column]:
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL text."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


TEMPLATES = {
    "recent_events": """
        SELECT timestamp, event_id, vehicle_id, zone_id, event_type, occupancy, capacity
        FROM bronze_events ORDER BY timestamp DESC, event_id DESC LIMIT :n""",
    "forecast_validation": """
        SELECT timestamp, zone_id, current_occupancy, predicted_occupancy, capacity, risk_level
        FROM predictions ORDER BY timestamp DESC, zone_id LIMIT :n""",
    "silver_features": """
        SELECT timestamp, zone_id, hour, temperature, rainfall, current_occupancy, capacity, average_duration
        FROM ml_features ORDER BY timestamp DESC, zone_id LIMIT :n""",
    "capacity_pressure": """
        SELECT zone_id, zone_name, occupancy, capacity, utilization, available, risk
        FROM zone_state ORDER BY utilization DESC, available, zone_id LIMIT :n""",
}


def run_template(spark: SparkSession, name: str, limit: int = 10) -> DataFrame:
    """Run a template over the registered views; an unknown name means capacity pressure."""
    text = TEMPLATES.get(name, TEMPLATES["capacity_pressure"])
    return spark.sql(text, args={"n": min(100, max(1, int(limit)))})
