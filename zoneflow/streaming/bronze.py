"""The event log as a sink: every valid event once, however late, in days that compaction keeps in few files.

Below the log lie `event_date=/batch_id=` folders. Compaction merges the
batches of a day, and the day's merged files of before, into one folder with a
negative batch number. It replaces the list of live folders in one step, and
from then on batches go to a folder of their own, so no reader sees an event
twice or not at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from zoneflow.sources import live

# Files that one micro-batch, or a compaction, writes per day of events, if none is larger than Spark's advisory size.
FILES_PER_DAY = 4
# Rows of a page: what a look-up by time can skip within a file.
PAGE_ROWS = 5000
# Ranges of time that one look-up names; more are joined to one range a day.
MOST_RANGES = 200
# Seconds of the event's time: files have statistics of a bigint, but not of every kind of timestamp.
SECOND = "event_second"
_KEYS = f"event_id string, {SECOND} bigint, event_date date, batch_id bigint"


def _by_day(events: DataFrame, files_per_day: int) -> DataFrame:
    """Rows of a day in about `files_per_day` slices of its time, each sorted, so that a look-up by time skips files and pages.

    A slice that is too large for one task is split further by Spark.
    """
    timed = events.withColumn(SECOND, F.unix_seconds("timestamp"))
    sliced = timed.withColumn("_slice", F.floor(F.pmod(SECOND, F.lit(86_400)) * files_per_day / 86_400))
    return sliced.hint("rebalance", "event_date", "_slice").sortWithinPartitions("event_date", SECOND, "zone_id").drop("_slice")


def _writer(events: DataFrame, files_per_day: int) -> DataFrameWriter:
    rows = _by_day(events, files_per_day).write.option("parquet.page.row.count.limit", PAGE_ROWS)
    return rows.partitionBy("event_date", "batch_id").mode("overwrite")


def time_ranges(dated: DataFrame, most: int = MOST_RANGES) -> list[tuple]:
    """(day, first, last second) of the hours, or else of the days, that hold events of the batch."""
    def ranges(unit: Column) -> list[tuple]:
        second = F.unix_seconds("timestamp")
        found = dated.groupBy("event_date", unit.alias("_unit")).agg(F.min(second).alias("a"), F.max(second).alias("b"))
        return [(r["event_date"], r["a"], r["b"]) for r in found.collect()]

    hours = ranges(F.date_trunc("hour", "timestamp"))
    return hours if len(hours) <= most else ranges(F.col("event_date"))


def held_events(spark: SparkSession, path: str, ranges: list[tuple], batch_id: int) -> DataFrame | None:
    """Ids that the live folders hold in these ranges of time, but for those of the batch itself.

    A copy bears its event's time. Days are pruned as folders, and times are
    compared with the files' statistics, so what a batch reads follows its own
    span of time and not the size of its days.
    """
    merged, current = live.folders(spark, path)
    reader, parts = spark.read.schema(_KEYS), []
    days = {str(d) for d, *_ in ranges}
    if own := [f"{path}/{f}" for f in merged if _day(f) in days]:
        parts.append(reader.option("basePath", f"{path}/{live.MERGED}").parquet(*own))
    if live.holds(spark, live.full(path, current)):
        parts.append(spark.read.schema(_KEYS).parquet(live.full(path, current)).where(F.col("batch_id") != batch_id))
    if not parts or not ranges:
        return None
    # Files without the seconds are read whole.
    inside = reduce(Column.__or__, [F.col(SECOND).between(a, b) for _, a, b in ranges], F.col(SECOND).isNull())
    touched = F.col("event_date").isin([F.lit(d).cast("date") for d in days])
    return reduce(DataFrame.unionByName, [p.where(touched & inside).select("event_date", "event_id") for p in parts])


def _day(folder: str) -> str:
    return folder.split("event_date=")[1].split("/")[0]


def bronze_writer(path: str, files_per_day: int = FILES_PER_DAY, compact_every: int = 0):
    """Sink that appends the events of a micro-batch which the log does not hold yet, however late they are.

    A batch overwrites its own directories and does not look itself up, so a
    batch run again after a failure leaves one copy, also where its first run
    was merged meanwhile. With `compact_every` the log is compacted in place
    after that many batches, between two of them.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.dropDuplicates(["event_id"]).withColumn("event_date", F.to_date("timestamp")).persist()
        try:
            ranges = time_ranges(dated)
            if ranges:
                held = held_events(spark, path, ranges, batch_id)
                fresh = dated if held is None else dated.join(held, ["event_date", "event_id"], "left_anti").select(dated.columns)
                rows = fresh.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                _writer(rows, files_per_day).option("partitionOverwriteMode", "dynamic").parquet(live.full(path, live.folders(spark, path)[1]))
        finally:
            dated.unpersist()
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_bronze(spark, path, files_per_day=files_per_day)

    return write


def _read(spark: SparkSession, path: str, merged: list[str], current: str) -> DataFrame | None:
    parts = []
    if merged:
        parts.append(spark.read.option("basePath", f"{path}/{live.MERGED}").parquet(*[f"{path}/{f}" for f in merged]))
    if live.holds(spark, live.full(path, current)):
        parts.append(spark.read.parquet(live.full(path, current)))
    return reduce(DataFrame.unionByName, parts) if parts else None


def compact_bronze(spark: SparkSession, path: str, target: str | None = None, files_per_day: int = FILES_PER_DAY) -> None:
    """Merge the batches since the last compaction with the merged files of their days; no other day is read or written.

    In place, readers go on with the folders they have seen, and `live.expire`
    removes these later. Run it from the stream's own sink (`compact_every`) or
    while the stream is stopped. With `target` all days are copied to another
    folder instead, which a stream can then go on with. Merged files bear a
    negative batch number, so no batch ever takes them for its own.
    """
    merged, current = live.folders(spark, path)
    if target is not None:
        rows = _read(spark, path, merged, current)
        if rows is not None:
            _writer(rows.withColumn("batch_id", F.lit(-1).cast("bigint")), files_per_day).parquet(target)
        return
    fresh = _read(spark, path, [], current)
    days = [] if fresh is None else sorted(str(r["event_date"]) for r in fresh.select("event_date").distinct().collect())
    if not days:
        return
    number = live.version(spark, path) + 1
    old = [f for f in merged if _day(f) in days]
    rows = _read(spark, path, old, current).withColumn("batch_id", F.lit(-number).cast("bigint"))
    _writer(rows, files_per_day).option("partitionOverwriteMode", "dynamic").parquet(f"{path}/{live.MERGED}")
    kept = [f for f in merged if f not in old]
    live.publish(spark, path, kept + [f"{live.MERGED}/event_date={d}/batch_id={-number}" for d in days], f"{live.NEW}-{number}")
