"""Streaming source and decoding of its messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.scalar import parse_timestamp
from zoneflow.schema import EVENT_MESSAGE

RAW = T.StructType([T.StructField("value", T.StringType())])


def read_event_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """Raw messages with a `value` column, from a topic or from files.

    Kafka options use `__` for dots: `kafka__bootstrap__servers`, `subscribe`.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "latest").option("failOnDataLoss", "false")
    else:
        reader = reader.schema(RAW)
    for key, value in options.items():
        reader = reader.option(key.replace("__", "."), value)
    return reader.load(path) if path else reader.load()


def parse_events(raw: DataFrame) -> DataFrame:
    """Flat event columns from JSON messages; extra keys are dropped, a broken message gives nulls."""
    return (
        raw.select(F.from_json(F.col("value").cast("string"), EVENT_MESSAGE).alias("data"))
        .select("data.*")
        .withColumn("timestamp", parse_timestamp("timestamp"))
    )
