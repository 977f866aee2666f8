"""Window metrics as a sink: the newest version of every window as merged days, and the batches since then."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.operators.aggregates import flat_window, silver_latest
from zoneflow.sources import live


def silver_writer(path: str, compact_every: int = 0):
    """Sink for one micro-batch of window updates.

    A batch overwrites its own directory, so a batch run again after a failure
    leaves one copy; each directory holds the batch's versions of its windows.
    With `compact_every` the batches are merged after that many.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = flat_window(batch).persist()
        try:
            if not kept.isEmpty():
                kept.write.mode("overwrite").parquet(f"{live.full(path, live.folders(spark, path)[1])}/batch_id={batch_id}")
        finally:
            kept.unpersist()
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_silver(spark, path)

    return write


def _read(spark: SparkSession, path: str, merged: list[str], current: str) -> DataFrame | None:
    parts, place = [], live.full(path, current)
    if live.holds(spark, place):
        parts.append(spark.read.option("basePath", place).parquet(place).withColumn("batch_id", F.col("batch_id").cast("bigint")))
    if merged:
        days = spark.read.option("basePath", f"{path}/{live.MERGED}").parquet(*[f"{path}/{f}" for f in merged])
        parts.append(days.drop("window_date", "version"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Versions of all windows in the live folders; `silver_latest` picks the last one of each."""
    rows = _read(spark, path, *live.folders(spark, path))
    return spark.read.option("basePath", path).parquet(path) if rows is None else rows


def compact_silver(spark: SparkSession, path: str) -> None:
    """Merge the batches since the last compaction into the days of their windows, one version of each window left.

    Other days are not read. A version keeps the number of its batch, so one
    that comes again later is told apart as before. Readers go on with the
    folders they have seen; `live.expire` removes these later. Run it from the
    stream's own sink or while the stream is stopped.
    """
    merged, current = live.folders(spark, path)
    fresh = _read(spark, path, [], current)
    if fresh is None:
        return
    days = sorted(str(r["d"]) for r in fresh.select(F.to_date("window_start").alias("d")).distinct().collect())
    number = live.version(spark, path) + 1
    old = [f for f in merged if f.split("window_date=")[1].split("/")[0] in days]
    latest = silver_latest(_read(spark, path, old, current)).withColumns({"window_date": F.to_date("window_start"), "version": F.lit(number)})
    latest.hint("rebalance", "window_date").sortWithinPartitions("window_date", "zone_id").write.partitionBy("window_date", "version").mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/{live.MERGED}")
    kept = [f for f in merged if f not in old]
    live.publish(spark, path, kept + [f"{live.MERGED}/window_date={d}/version={number}" for d in days], f"{live.NEW}-{number}")
