"""Column expressions shared by all operators."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str
Number = Column | float | int

# Relative arrival weight of each hour of the day, 0 to 23.
HOUR_WEIGHTS = (
    0.1, 0.1, 0.1, 0.1, 0.1, 1.0, 1.0, 1.0, 3.0, 3.0, 3.0, 1.0,
    3.5, 3.5, 1.0, 1.0, 1.0, 4.0, 4.0, 4.0, 1.0, 1.0, 1.0, 1.0,
)
PEAK_HOUR_SHARE = max(HOUR_WEIGHTS) / sum(HOUR_WEIGHTS)

# Spellings accepted for each model.
MODEL_ALIASES = {
    "rf": "random_forest",
    "randomforest": "random_forest",
    "random forest": "random_forest",
    "random forest v3.2": "random_forest",
    "xgb": "xgboost",
    "xgboost v1.8": "xgboost",
    "linear baseline": "linear",
    "linear_regression": "linear",
}
MODEL_KEYS = ("random_forest", "xgboost", "linear")

# Earth radius in km, 32-bit FNV-1a parameters, number of sensor nodes.
EARTH_RADIUS_KM = 6371.0
FNV_OFFSET = 2166136261
FNV_PRIME = 16777619
SENSOR_NODES = 24


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _lit(value: Number) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def clip(value: ColumnLike, low: Number, high: Number) -> Column:
    """Bound below, then above; a null value stays null."""
    value = _col(value)
    return F.when(value.isNotNull(), F.least(F.greatest(value, _lit(low)), _lit(high)))


def utilization(occupancy: ColumnLike, capacity: ColumnLike, clipped: bool = False) -> Column:
    """Occupied share in percent; 0 where there is no capacity."""
    pct = F.when(_col(capacity) > 0, _col(occupancy) / _col(capacity) * 100).otherwise(F.lit(0.0))
    return clip(pct, 0.0, 100.0) if clipped else pct


def padded(number: Column, width: int) -> Column:
    """Digits filled up with zeros to `width`; a longer number stays whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), "0")


def available_bays(occupancy: ColumnLike, capacity: ColumnLike) -> Column:
    return F.greatest(F.lit(0), _col(capacity) - _col(occupancy))


def risk_level(
    pct: Column,
    medium: float = 60,
    high: float = 85,
    closed: str = "left",
    labels: tuple[str, str, str] = ("LOW", "MEDIUM", "HIGH"),
) -> Column:
    """Band of a percentage. `closed='left'` puts a threshold in the band above it."""
    if closed == "left":
        over_high, over_medium = pct >= high, pct >= medium
    elif closed == "right":
        over_high, over_medium = pct > high, pct > medium
    else:
        raise ValueError("closed must be 'left' or 'right'")
    return F.when(over_high, labels[2]).when(over_medium, labels[1]).when(pct.isNotNull(), labels[0])


def day_of_week(ts: ColumnLike) -> Column:
    """Monday is 0."""
    return F.weekday(_col(ts))


def is_weekend(ts: ColumnLike) -> Column:
    return (F.weekday(_col(ts)) >= 5).cast("int")


def is_holiday(ts: ColumnLike, holidays: tuple[str, ...]) -> Column:
    if not holidays:
        return F.lit(0)
    return F.to_date(_col(ts)).isin([F.to_date(F.lit(d)) for d in holidays]).cast("int")


def parse_timestamp(text: ColumnLike) -> Column:
    """Text to timestamp; offsets are applied, unreadable text gives null."""
    return F.try_to_timestamp(_col(text).cast("string"))


def sunday_week(ts: ColumnLike) -> Column:
    """Start of the week, weeks beginning on Sunday."""
    day = F.expr("INTERVAL 1 DAY")
    return F.date_trunc("week", _col(ts) + day) - day


def bucket(ts: ColumnLike, resolution: str) -> Column:
    if resolution == "weekly":
        return sunday_week(ts)
    units = {"hourly": "hour", "daily": "day", "second": "second"}
    return F.date_trunc(units[resolution], _col(ts))


def local_text(ts: ColumnLike, zone: str = "Asia/Kolkata", fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.from_utc_timestamp(_col(ts), zone), fmt)


def iso_text(ts: ColumnLike) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss")


def session_exit(entry: ColumnLike, minutes: ColumnLike) -> Column:
    return _col(entry) + F.make_dt_interval(mins=_col(minutes).cast("int"))


def to_number(value: ColumnLike, default: float | None = None) -> Column:
    parsed = _col(value).try_cast("double")
    return parsed if default is None else F.coalesce(parsed, F.lit(default))


def null_if_nan(value: ColumnLike) -> Column:
    return F.when(~F.isnan(_col(value)), _col(value))


def sessions_needed(capacity: ColumnLike, target: ColumnLike, dwell_min: ColumnLike, days: int) -> Column:
    """Stays needed to reach the target peak: arrivals in the peak hour over that hour's share."""
    peak_arrivals = _col(target) * _col(capacity) / (_col(dwell_min) / 60)
    return F.greatest(F.lit(1), F.bround(peak_arrivals / F.lit(PEAK_HOUR_SHARE) * days, 0).cast("int"))


def turns_per_day(median_dwell: ColumnLike) -> Column:
    dwell = _col(median_dwell)
    return F.when(dwell > 0, 1440 / dwell).otherwise(F.lit(0.0))


def is_fresh(ts: ColumnLike, now: Column, ttl_seconds: int) -> Column:
    """Younger than the limit; a missing time is stale."""
    age = now.cast("timestamp").cast("double") - _col(ts).cast("timestamp").cast("double")
    return F.coalesce(age < ttl_seconds, F.lit(False))


def model_key(value: ColumnLike) -> Column:
    """Canonical model name; null for a name no model answers to."""
    name = F.translate(F.lower(F.trim(F.coalesce(_col(value), F.lit("random_forest")))), "-", "_")
    aliases = F.create_map(*[F.lit(part) for pair in MODEL_ALIASES.items() for part in pair])
    known = F.coalesce(F.try_element_at(aliases, name), name)
    return F.when(known.isin(*MODEL_KEYS), known)


def haversine_km(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike) -> Column:
    lat1, lon1, lat2, lon2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    half = (
        F.pow(F.sin((lat2 - lat1) / 2), 2)
        + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(half), F.sqrt(F.greatest(F.lit(0.0), 1 - half)))


def fnv1a(text: ColumnLike, salt: int = 0) -> Column:
    """Salted 32-bit FNV-1a over UTF-16 lead units, unsigned."""
    def unit(char: Column) -> Column:
        point = F.ascii(char).cast("bigint")
        lead = 0xD800 + F.shiftright(point - 0x10000, 10)
        return F.when(point > 0xFFFF, lead).otherwise(point)

    def step(acc: Column, char: Column) -> Column:
        return (acc.bitwiseXOR(unit(char)) * FNV_PRIME).bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))

    chars = F.filter(F.split(_col(text), ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(FNV_OFFSET ^ salt).cast("bigint"), step)


def sensor_node(zone_id: ColumnLike) -> Column:
    """Display node 01 to 24 of a zone."""
    return F.lpad((fnv1a(zone_id) % SENSOR_NODES + 1).cast("string"), 2, "0")


def literal_pattern(text: str) -> str:
    """Pattern that matches `text` itself."""
    return re.escape(text)
