"""Frames the registered queries share, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.ml.forecast import predictions
from zoneflow.operators.grid import build_features
from zoneflow.operators.occupancy import latest_per_zone, zone_state
from zoneflow.sources import sample


def rounded(df: DataFrame, places: int = 9) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    return df.select(*[
        F.round(f.name, places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema
    ])


def features(spark: SparkSession, d: str) -> DataFrame:
    return build_features(sample.events(spark, d), sample.zones(spark, d), sample.weather(spark, d), sample.HOLIDAYS)


def pred(spark: SparkSession, d: str) -> DataFrame:
    return predictions(features(spark, d))


def snapshot(spark: SparkSession, d: str) -> DataFrame:
    return latest_per_zone(features(spark, d)).select("zone_id", F.col("current_occupancy").alias("occupancy"), "capacity")


def manual(spark: SparkSession, d: str) -> DataFrame:
    return sample.operator_rows(spark, d)


def state(spark: SparkSession, d: str) -> DataFrame:
    """State of every zone from its newest event and observation in the whole log."""
    return zone_state(sample.zones(spark, d), snapshot(spark, d), sample.events(spark, d), manual(spark, d))


FEATURES_SQL = """
bounds as (
  select date_trunc('day', min("timestamp")) s,
         date_trunc('day', max("timestamp")) + interval 1 day - interval 30 minute e from ev),
bins as (select unnest(generate_series(s, e, interval 30 minute)) "timestamp" from bounds),
instants as (
  select zone_id, "timestamp", occupancy from ev
  qualify row_number() over (partition by zone_id, "timestamp" order by event_type desc, event_id desc) = 1),
spine as (select z.zone_id, z.capacity, b."timestamp" from zones z cross join bins b),
resampled as (
  select g.zone_id, g.capacity, g."timestamp", coalesce(s.occupancy, 0)::double current_occupancy
  from spine g asof left join instants s on g.zone_id = s.zone_id and g."timestamp" >= s."timestamp"),
ahead as (
  select *, lead(current_occupancy) over (partition by zone_id order by "timestamp") future_occupancy from resampled),
stay_means as (
  select zone_id, round_even(avg(parking_duration), 1) average_duration from ev where event_type = 'EXIT' group by 1),
features as (
  select a."timestamp", a.zone_id, hour(a."timestamp")::int "hour", (isodow(a."timestamp") - 1)::int day_of_week,
         (isodow(a."timestamp") >= 6)::int is_weekend,
         (a."timestamp"::date in (date '2024-01-01', date '2024-01-26'))::int is_holiday,
         w.temperature, w.rainfall, a.current_occupancy, a.capacity,
         coalesce(d.average_duration, 30.0)::double average_duration, a.future_occupancy
  from ahead a left join weather w on w."date" = a."timestamp"::date left join stay_means d using (zone_id)
  where a.future_occupancy is not null)
"""

STATE_SQL = """
snap as (
  select zone_id, capacity, current_occupancy occupancy from features
  qualify row_number() over (partition by zone_id order by "timestamp" desc) = 1),
live1 as (
  select * from ev qualify row_number() over (partition by zone_id order by "timestamp" desc, event_id desc) = 1),
manual1 as (
  select * from manual qualify row_number() over (partition by zone_id order by "timestamp" desc, event_id desc) = 1),
merged as (
  select z.*, m.capacity is not null and m.capacity = z.capacity has_manual,
         l.capacity is not null and l.capacity = z.capacity has_live,
         m.occupancy m_occ, l.occupancy l_occ, coalesce(s.occupancy, 0) s_occ, m."timestamp" m_ts, l."timestamp" l_ts
  from zones z left join snap s on s.zone_id = z.zone_id and s.capacity = z.capacity
  left join live1 l on l.zone_id = z.zone_id left join manual1 m on m.zone_id = z.zone_id),
counted as (
  select *, greatest(0, least(capacity, case when has_manual then m_occ when has_live then l_occ else s_occ end))::int occupancy,
         case when has_manual then 'MANUAL_GATE' when has_live then 'LIVE_EVENT' else 'STORED_SNAPSHOT' end source,
         case when has_manual then m_ts when has_live then l_ts end updated_at,
         case when has_manual then 1.0 when has_live then 0.9 else 0.65 end::double confidence
  from merged),
loaded as (select *, round_even(occupancy::double / capacity * 100, 1) utilization, greatest(0, capacity - occupancy)::int available from counted),
zstate as (
  select *, case when utilization > 85 then 'HIGH' when utilization > 60 then 'MEDIUM' else 'LOW' end risk from loaded)
"""

ANALYTICAL = """greatest(0, least({cap}, {occ} * 0.82::double + {cap} * (0.09::double
  + case when {hour} between 8 and 10 or {hour} between 17 and 21 then 0.13::double when {hour} <= 5 then -0.04::double else 0.02::double end
  + {holiday} + least(0.09::double, coalesce({rain}, 0) / 1000)
  + greatest(-0.03::double, least(0.06::double, ({dwell} - 75) / 2500)))))"""

LINEAR = """(-0.17439350066308634::double + "hour" * 0.04460364854107772::double + day_of_week * -0.04790000512139525::double
  + is_weekend * 0.24025251427531252::double + is_holiday * 0.5214346752849233::double
  + coalesce(temperature, 0) * -0.007583898896045734::double + coalesce(rainfall, 0) * 0.03789520921855526::double
  + current_occupancy * 0.8995140338914603::double + capacity * 0.02931654235965693::double
  + average_duration * -0.002831618017382227::double)"""

PRED_SQL = f"""
scored as (
  select *, {ANALYTICAL.format(cap='capacity::double', occ='current_occupancy', hour='"hour"', rain='rainfall',
             dwell='average_duration', holiday='case when is_holiday = 1 then 0.08::double else 0 end')} predicted_occupancy,
         greatest(0, least(capacity, {LINEAR})) linear_prediction
  from features),
pred as (
  select "timestamp", zone_id, current_occupancy, future_occupancy actual_occupancy, predicted_occupancy, linear_prediction,
         capacity, case when predicted_occupancy / capacity * 100 >= 85 then 'HIGH'
                        when predicted_occupancy / capacity * 100 >= 60 then 'MEDIUM' else 'LOW' end risk_level,
         (('0x' || substr(md5(zone_id || '|' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')), 1, 8))::bigint % 5 = 0)::int is_validation
  from scored)
"""
