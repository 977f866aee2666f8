"""Named queries, each with the SQL another engine should agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`; leave `sql` out where SQL cannot say it."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


# The derived fixture in plain SQL: zones, stays, events with running occupancy.
BASE = """
with zones as (
  select n_nationkey zone_key, 'Z' || lpad((n_nationkey + 1)::varchar, greatest(3, length((n_nationkey + 1)::varchar))::int, '0') zone_id, n_name zone_name,
         (2 + n_nationkey % 4)::int capacity,
         19.0::double + 0.01::double * (n_nationkey % 5) latitude,
         72.8::double + 0.01::double * (n_nationkey // 5) longitude,
         0.5::double + 0.01::double * n_nationkey peak_utilization_target,
         45.0::double + 5.0::double * (n_nationkey % 10) mean_duration_min
  from nation),
stays as (
  select event_id session_id, 'V' || lpad(user_id::varchar, greatest(5, length(user_id::varchar))::int, '0') vehicle_id, user_id % 25 zone_key,
         date_trunc('second', ts) entry_ts,
         cast(least(240, greatest(5, round(value))) as int) dwell_min,
         20.0::double + (props->>'k')::int % 16 temperature,
         greatest(0, (props->>'k')::int - 60)::double / 10 rainfall,
         event_type channel, (props->>'k')::int k
  from events),
halves as (
  select 'E' || lpad((session_id * 2)::varchar, greatest(9, length((session_id * 2)::varchar))::int, '0') event_id, entry_ts as "timestamp", vehicle_id, zone_key,
         'ENTRY' event_type, 0 parking_duration, 1 sgn, temperature, rainfall, channel, k from stays
  union all
  select 'E' || lpad((session_id * 2 + 1)::varchar, greatest(9, length((session_id * 2 + 1)::varchar))::int, '0'), entry_ts + to_minutes(dwell_min), vehicle_id, zone_key,
         'EXIT', dwell_min, -1, temperature, rainfall, channel, k from stays),
elog as (
  select h.event_id, h."timestamp", h.vehicle_id, z.zone_id, h.event_type, h.parking_duration,
         greatest(0, least(z.capacity, sum(h.sgn) over (
           partition by z.zone_id order by h."timestamp", h.event_type, h.event_id rows unbounded preceding)))::int occupancy,
         z.capacity, z.latitude, z.longitude, h.temperature, h.rainfall, h.channel, h.k
  from halves h join zones z using (zone_key)),
ev as (select * exclude (channel, k) from elog),
arrivals as (
  select event_id, "timestamp", vehicle_id,
         case when channel = 'view' and k < 3 then 'Z999' else zone_id end zone_id, event_type,
         case when channel = 'signup' and k < 10 then -parking_duration else parking_duration end parking_duration,
         case when channel = 'purchase' and k > 95 then occupancy + capacity else occupancy end occupancy,
         case when channel = 'click' and k = 50 then 0 else capacity end capacity,
         latitude, longitude, temperature, rainfall,
         c.copy * 1000000000000000000 + substr(event_id, 2)::bigint arrival
  from elog join (values (0), (1)) c(copy) on c.copy = 0 or channel = 'error'),
manual as (
  select * exclude (channel, k, occupancy), least(occupancy + 1, capacity) occupancy,
         'MANUAL_GATE' source_type, 1.0::double confidence
  from elog where channel = 'error'),
weather as (
  select "timestamp"::date "date", avg(temperature) temperature, avg(rainfall) rainfall from ev group by 1)
"""


def sql(body: str, *extra: str) -> str:
    """Oracle text: the fixture, further common tables, then the query itself."""
    return BASE + "".join("," + e.strip() for e in extra) + "\n" + body.strip()
