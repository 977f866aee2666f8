"""Streaming event log and window metrics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zoneflow.operators.aggregates import zone_window_metrics
from zoneflow.operators.cleaning import valid_events
from zoneflow.sources.stream import parse_events, read_event_stream
from zoneflow.streaming.bronze import FILES_PER_DAY, bronze_writer, compact_bronze  # noqa: F401
from zoneflow.streaming.dedup import dedup_stream
from zoneflow.streaming.metrics import observed, start_metrics, stop_metrics
from zoneflow.streaming.silver import compact_silver, read_silver, silver_writer  # noqa: F401

TRIGGER = "5 seconds"
WATERMARK = "5 minutes"
WIDTH = "5 minutes"


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def write_bronze(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = TRIGGER, files_per_day: int = FILES_PER_DAY, compact_every: int = 0,
) -> StreamingQuery:
    """Append valid events, partitioned by day; give it the stream before any watermark, so that late rows stay.

    `every=None` takes what is there and ends.
    """
    writer = stream.writeStream.foreachBatch(bronze_writer(path, files_per_day, compact_every)).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def write_silver(
    metrics: DataFrame, path: str, checkpoint: str, every: str | None = TRIGGER, mode: str = "update", compact_every: int = 0,
) -> StreamingQuery:
    """Publish windows as they change, or once they close (`mode="append"`); read them through `silver_latest`."""
    writer = (
        metrics.writeStream.outputMode(mode).foreachBatch(silver_writer(path, compact_every))
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def stream_metrics(events: DataFrame, watermark: str = WATERMARK, width: str = WIDTH) -> DataFrame:
    """The batch window metrics with a watermark, which bounds the open state."""
    return zone_window_metrics(events, width, watermark)


@dataclass
class StreamConfig:
    """Where the stream reads and writes, and how it runs.

    `every=None` processes what is available and stops; `run_seconds=0` runs
    until stopped.
    """

    bronze: str
    silver: str
    checkpoints: str
    source_format: str = "kafka"
    source_path: str | None = None
    source_options: dict[str, str] = field(default_factory=dict)
    every: str | None = TRIGGER
    run_seconds: float = 0
    dedup: str = "exact"
    # Offsets of a topic, or files, that one micro-batch takes at most.
    max_per_trigger: int | None = None
    # Micro-batches after which each sink merges its days; 0 leaves that to `compact_bronze` and `compact_silver`.
    compact_every: int = 0
    # Table that gets one row for each micro-batch of both queries.
    metrics: str | None = None


def source_options(cfg: StreamConfig) -> dict[str, str]:
    bound = "maxOffsetsPerTrigger" if cfg.source_format == "kafka" else "maxFilesPerTrigger"
    return cfg.source_options | ({bound: str(cfg.max_per_trigger)} if cfg.max_per_trigger else {})


def valid_stream(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """Valid events, copies and late rows among them."""
    return valid_events(observed(parse_events(read_event_stream(spark, cfg.source_format, cfg.source_path, **source_options(cfg)))))


def run_stream(spark: SparkSession, cfg: StreamConfig) -> dict[str, StreamingQuery]:
    """Run both queries, each on its own checkpoint, and stop both at the end.

    Bronze takes every valid event once, late ones too, and keeps no state but
    itself; only the windows have a watermark and state against copies.
    """
    if cfg.run_seconds < 0:
        raise ValueError("run_seconds must be zero or greater")
    events = valid_stream(spark, cfg)
    listener = start_metrics(spark, cfg.metrics) if cfg.metrics else None
    # Spark takes custom state before an aggregation in append mode only.
    mode = "append" if cfg.dedup == "bloom" else "update"
    queries = {
        "bronze": write_bronze(events, cfg.bronze, f"{cfg.checkpoints}/bronze", cfg.every, compact_every=cfg.compact_every),
        "silver": write_silver(
            zone_window_metrics(dedup_stream(events, WATERMARK, cfg.dedup), WIDTH), cfg.silver, f"{cfg.checkpoints}/silver", cfg.every, mode,
            cfg.compact_every,
        ),
    }
    try:
        if cfg.every is None:
            for q in queries.values():
                q.awaitTermination()
        elif cfg.run_seconds:
            spark.streams.awaitAnyTermination(cfg.run_seconds)
        else:
            spark.streams.awaitAnyTermination()
    finally:
        for q in queries.values():
            if q.isActive:
                q.stop()
        if listener is not None:
            stop_metrics(spark, listener)
    return queries
