"""What each micro-batch of a stream did, as a table: rows, unreadable rows, late and repeated ones, and how long it took.

Rows are counted where they pass, by `observe`; what state operators drop, and
the times, come with the query's progress. A listener gathers both and appends
them to a Parquet table, which `batch_cadence` and any report can read.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

OBSERVED = "events"
RUN_METRICS = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("started", T.TimestampType()), T.StructField("input_rows", T.LongType()), T.StructField("parsed_rows", T.LongType()),
    T.StructField("unreadable_rows", T.LongType()), T.StructField("late_rows", T.LongType()), T.StructField("copies", T.LongType()),
    T.StructField("seconds", T.DoubleType()),
])
# Batches that the listener holds before it writes.
HELD = 50


def observed(events: DataFrame) -> DataFrame:
    """The parsed rows, counted as they pass."""
    return events.observe(OBSERVED, F.count(F.lit(1)).alias("parsed"), F.count_if(F.col("event_id").isNull()).alias("unreadable"))


class RunMetrics(StreamingQueryListener):
    """Appends one row a micro-batch to the table at `path`."""

    def __init__(self, spark: SparkSession, path: str, held: int = HELD):
        self._spark, self._path, self._held = spark, path, held
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = (p.observedMetrics or {}).get(OBSERVED)
        counts = seen.asDict() if seen is not None else {}
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        copies = sum((op.customMetrics or {}).get("numDroppedDuplicateRows", 0) for op in p.stateOperators)
        started = dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        row = (p.name or str(p.id), str(p.runId), p.batchId, started, p.numInputRows, counts.get("parsed"), counts.get("unreadable"),
               late, copies, p.durationMs.get("triggerExecution", 0) / 1000)
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self._held
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self) -> None:
        """Write what is held."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self._spark.createDataFrame(rows, RUN_METRICS).coalesce(1).write.mode("append").parquet(self._path)


def start_metrics(spark: SparkSession, path: str) -> RunMetrics:
    listener = RunMetrics(spark, path)
    spark.streams.addListener(listener)
    return listener


def stop_metrics(spark: SparkSession, listener: RunMetrics) -> None:
    """Wait for the events under way, then write the rest."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    spark.streams.removeListener(listener)
    listener.flush()


def run_report(metrics: DataFrame) -> DataFrame:
    """Batches, rows and rates of every query over all its runs; a batch that ran again counts by its last run."""
    last = F.struct("started", "run_id")
    value = ("input_rows", "parsed_rows", "unreadable_rows", "late_rows", "copies", "seconds")
    once = metrics.groupBy("query", "batch_id").agg(*[F.max_by(c, last).alias(c) for c in value], F.max("started").alias("started"))
    return once.groupBy("query").agg(
        F.count("*").alias("batches"), *[F.sum(c).alias(c) for c in value], F.max("started").alias("last_started"),
    ).withColumn("rows_per_second", F.round(F.col("input_rows") / F.col("seconds"), 2))
