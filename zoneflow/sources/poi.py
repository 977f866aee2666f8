"""Points of interest from nested JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.schema import POI_DOCUMENT

# Name of an unnamed place, marker of an unstated property, source label.
UNNAMED = "Mapped parking facility"
UNSTATED = "unknown"
SOURCE = "OPENSTREETMAP"


def flatten_poi(documents: DataFrame, column: str = "value", limit: int | None = None) -> DataFrame:
    """One row per located element; places without coordinates are left out.

    All places are kept; `limit` asks for the first located elements of each
    document, in document order.
    """
    elements = F.from_json(F.col(column), POI_DOCUMENT)["elements"]
    if limit is not None:
        located = F.filter(elements, lambda e: F.coalesce(e["lat"], e["center"]["lat"]).isNotNull() & F.coalesce(e["lon"], e["center"]["lon"]).isNotNull())
        elements = F.slice(located, 1, limit)
    rows = documents.select(F.explode(elements).alias("e"))
    tags = F.coalesce(F.col("e.tags"), F.create_map().cast("map<string,string>"))

    def tag(name: str):
        return F.try_element_at(tags, F.lit(name))

    def named(name: str):
        value = tag(name)
        return F.when(value != "", value)

    digits = F.trim(F.regexp_replace(F.coalesce(tag("capacity"), F.lit("")), ",", ""))
    flat = rows.select(
        F.concat(F.coalesce("e.type", F.lit("node")), F.lit("/"), F.col("e.id").cast("string")).alias("poi_id"),
        F.coalesce(named("name"), named("operator"), F.lit(UNNAMED)).alias("name"),
        F.round(F.coalesce("e.lat", "e.center.lat"), 7).alias("latitude"),
        F.round(F.coalesce("e.lon", "e.center.lon"), 7).alias("longitude"),
        F.when(digits.rlike("^[0-9]+$"), digits.try_cast("int")).alias("capacity"),
        tag("parking").alias("parking_type"),
        F.coalesce(tag("access"), F.lit(UNSTATED)).alias("access"),
        F.coalesce(tag("fee"), F.lit(UNSTATED)).alias("fee"),
        tag("opening_hours").alias("opening_hours"),
        F.lit(SOURCE).alias("source_type"),
        F.lit(False).alias("occupancy_available"),
    ).where("latitude IS NOT NULL AND longitude IS NOT NULL")
    return flat
