"""Fixed schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()

# JSON payload: the time is text on the wire and becomes a timestamp after parsing.
EVENT_MESSAGE = _struct(
    event_id=_S, timestamp=_S, vehicle_id=_S, zone_id=_S, event_type=_S,
    parking_duration=_I, occupancy=_I, capacity=_I,
    latitude=_D, longitude=_D, temperature=_D, rainfall=_D,
)

EVENT = T.StructType([T.StructField("timestamp", _TS) if f.name == "timestamp" else f for f in EVENT_MESSAGE])

EVENT_COLUMNS = EVENT.fieldNames()

ZONE = _struct(
    zone_id=_S, zone_name=_S, capacity=_I, latitude=_D, longitude=_D,
    peak_utilization_target=_D, mean_duration_min=_D,
)

SNAPSHOT = _struct(zone_id=_S, occupancy=_D, capacity=_I, utilization=_D)

FEATURE_TABLE = _struct(
    timestamp=_TS, zone_id=_S, hour=_I, day_of_week=_I, is_weekend=_I, is_holiday=_I,
    temperature=_D, rainfall=_D, current_occupancy=_D, capacity=_I, average_duration=_D,
    future_occupancy=_D,
)

PREDICTION = _struct(
    timestamp=_TS, zone_id=_S, current_occupancy=_D, actual_occupancy=_D, predicted_occupancy=_D,
    random_forest_prediction=_D, xgboost_prediction=_D, linear_prediction=_D,
    capacity=_I, risk_level=_S, is_validation=_I,
)

COMMAND = _struct(
    command_id=_S, zone_id=_S, action=_S, amount=_I, occupancy=_I, vehicle_id=_S,
    source_type=_S, note=_S, observed_at=_TS,
)

POI_DOCUMENT = T.StructType([
    T.StructField("elements", T.ArrayType(T.StructType([
        T.StructField("type", _S),
        T.StructField("id", _L),
        T.StructField("lat", _D),
        T.StructField("lon", _D),
        T.StructField("center", _struct(lat=_D, lon=_D)),
        T.StructField("tags", T.MapType(_S, _S)),
    ]))),
])
