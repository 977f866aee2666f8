"""Batch sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.operators.cleaning import filter_zones


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. One file suits a report of a few rows; row data keeps its partitions."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Append to a serving table; needs the database's driver on the class path."""
    df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table).options(**options).save()


def export(df: DataFrame, fmt: str, path: str, zone: str | None = None) -> None:
    """A layer, or one zone of it, as CSV, JSON records or Snappy Parquet."""
    if zone and "zone_id" in df.columns:
        df = filter_zones(df, [zone], ignore_case=True)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS").json(path)
    elif fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    elif fmt == "geojson":
        to_geojson(df).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown export format {fmt}")


def to_geojson(zones: DataFrame) -> DataFrame:
    """One GeoJSON feature per row: a point, every other column a property."""
    props = [c for c in zones.columns if c not in ("latitude", "longitude")]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates"),
        ).alias("geometry"),
        F.struct(*props).alias("properties"),
    )
    return zones.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))


def write_predictions(pred: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Prediction table as Parquet or CSV."""
    export(pred, fmt, path)


def write_importance(importances: list[DataFrame], path: str, fmt: str = "csv") -> None:
    """Feature weights of all models, one row per model and feature, as one CSV file or Parquet."""
    rows = reduce(DataFrame.unionByName, importances).select("model", "feature", "importance").orderBy("model", F.desc("importance"), "feature")
    if fmt == "csv":
        write_csv(rows, path, single_file=True)
    else:
        export(rows, fmt, path)
