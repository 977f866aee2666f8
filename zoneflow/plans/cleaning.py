"""Queries over sources, filters, cleaning and quality."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from zoneflow.functions.scalar import available_bays, risk_level, utilization
from zoneflow.operators import aggregates, cleaning, quality, search
from zoneflow.operators.occupancy import with_lookup
from zoneflow.plans import frames
from zoneflow.plans.frames import FEATURES_SQL, STATE_SQL, rounded
from zoneflow.plans.registry import query, sql
from zoneflow.schema import EVENT_COLUMNS
from zoneflow.session import once, shared_dir
from zoneflow.sinks import to_geojson
from zoneflow.sources import files, poi, sample, stream

_ARRIVAL_ORDER = ["timestamp", "arrival"]
_EVENT_SQL = ", ".join(f'"{c}"' for c in EVENT_COLUMNS)


def _csv_copy(spark, d) -> str:
    """The log as CSV in the shared folder, written once per application."""
    def write() -> str:
        path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex[:12]}"
        sample.events(spark, d).write.option("header", True).csv(path)
        return path

    return once(spark, ("csv", d), write)


@query("s1_events_csv", sql(f"select {_EVENT_SQL} from ev"))
def _(spark, d):
    return files.read_events_csv(spark, _csv_copy(spark, d)).select(*EVENT_COLUMNS)


@query("s2_csv_parse_dates", sql("""
    select date_trunc('hour', "timestamp") "hour_start", count(*) "rows", min("timestamp") first_event, max("timestamp") last_event
    from ev group by 1"""))
def _(spark, d):
    df = files.read_csv(spark, _csv_copy(spark, d), sample.events(spark, d).schema, parse_dates=("timestamp",))
    return df.groupBy(F.date_trunc("hour", "timestamp").alias("hour_start")).agg(
        F.count("*").alias("rows"), F.min("timestamp").alias("first_event"), F.max("timestamp").alias("last_event")
    )


@query("s5_parse_json", sql("""
    select case when channel = 'error' then null else event_id end event_id,
           case when channel in ('error', 'signup') then null else "timestamp" end "timestamp",
           case when channel = 'error' then null else zone_id end zone_id,
           case when channel = 'error' then null else parking_duration end parking_duration,
           case when channel = 'error' then null else occupancy end occupancy,
           case when channel = 'error' then null else rainfall end rainfall
    from elog"""))
def _(spark, d):
    """Messages of the `error` channel are cut short, those of `signup` carry an unreadable time."""
    log = sample.event_log(spark, d)
    when = F.when(F.col("channel") == "signup", "not-a-time").otherwise(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    text = F.to_json(F.struct(
        "event_id", when.alias("timestamp"), "vehicle_id", "zone_id", "event_type", "parking_duration", "occupancy",
        "capacity", "latitude", "longitude", "temperature", "rainfall", F.lit(1).alias("day_of_week"),
    ))
    raw = log.select(F.when(F.col("channel") == "error", F.substring(text, 1, 20)).otherwise(text).alias("value"))
    return stream.parse_events(raw).select("event_id", "timestamp", "zone_id", "parking_duration", "occupancy", "rainfall")


@query("s6_row_count", sql('select count(*) "rows" from ev'))
def _(spark, d):
    return aggregates.count_rows(sample.events(spark, d))


@query("s6_footer_bounds", """
    select count(*) n, min(event_id) min_event_id, max(event_id) max_event_id, min(user_id) min_user_id, max(user_id) max_user_id
    from events""")
def _(spark, d):
    """Rows and bounds of the stored events without reading them."""
    return files.footer_bounds(spark, f"{d}/events.parquet", ["event_id", "user_id"])


@query("s7_flatten_poi", """
    select case when c_mktsegment = 'BUILDING' then 'way/' else 'node/' end || c_custkey poi_id,
           case when c_mktsegment = 'MACHINERY' then 'Operator ' || c_nationkey
                when c_mktsegment = 'FURNITURE' then 'Mapped parking facility' else c_name end "name",
           round(19 + c_acctbal / 100000, 7) latitude, round(72.8::double + c_nationkey::double / 1000, 7) longitude,
           case when c_acctbal >= 0 and c_mktsegment <> 'HOUSEHOLD' then floor(c_acctbal)::int end capacity,
           'surface' parking_type, case when c_mktsegment = 'BUILDING' then 'private' else 'unknown' end access,
           'unknown' fee, null::varchar opening_hours, 'OPENSTREETMAP' source_type, false occupancy_available
    from customer where c_mktsegment <> 'AUTOMOBILE'""")
def _(spark, d):
    """One document per customer: nodes, ways with a centre, elements without a place."""
    c = sample.table(spark, d, "customer")
    segment, key = F.col("c_mktsegment"), F.col("c_nationkey")
    is_way, placed = segment == "BUILDING", segment != "AUTOMOBILE"
    lat, lon = 19 + F.col("c_acctbal") / 100000, 72.8 + key.cast("double") / 1000
    capacity = F.when(segment == "HOUSEHOLD", "many").otherwise(F.format_number(F.floor("c_acctbal"), 0))
    tags = F.struct(
        F.when(~segment.isin("MACHINERY", "FURNITURE"), F.col("c_name")).alias("name"),
        F.when(segment == "MACHINERY", F.concat(F.lit("Operator "), key.cast("string"))).alias("operator"),
        capacity.alias("capacity"), F.lit("surface").alias("parking"), F.when(is_way, "private").alias("access"),
    )
    element = F.struct(
        F.when(is_way, "way").otherwise("node").alias("type"), F.col("c_custkey").alias("id"),
        F.when(~is_way & placed, lat).alias("lat"), F.when(~is_way & placed, lon).alias("lon"),
        F.when(is_way, F.struct(lat.alias("lat"), lon.alias("lon"))).alias("center"), tags.alias("tags"),
    )
    documents = c.select(F.to_json(F.struct(F.array(element).alias("elements"))).alias("value"))
    return poi.flatten_poi(documents)


@query("s8_registered_view", sql("select zone_id, count(*) n from ev group by 1"))
def _(spark, d):
    from zoneflow.operators.paging import register
    register(sample.events(spark, d), "zoneflow_events")
    return spark.sql("SELECT zone_id, count(*) AS n FROM zoneflow_events GROUP BY zone_id")


@query("k7_geojson", sql("""
    select '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || longitude || ',' || latitude
           || ']},"properties":{"zone_id":"' || zone_id || '","zone_name":"' || zone_name || '","capacity":' || capacity
           || ',"occupancy":' || occupancy || ',"available":' || available || ',"risk":"' || risk || '"}}' feature
    from zstate""", FEATURES_SQL, STATE_SQL))
def _(spark, d):
    return to_geojson(frames.state(spark, d).select(
        "zone_id", "zone_name", "capacity", "occupancy", "available", "risk", "latitude", "longitude"
    ))


@query("p1_valid_events", sql("select * from arrivals where occupancy >= 0 and capacity > 0"))
def _(spark, d):
    return cleaning.valid_events(sample.arrivals(spark, d))


_CLEAN_SQL = """
firsts as (select * from arrivals qualify row_number() over (partition by event_id order by "timestamp", arrival) = 1),
cleaned as (select * from firsts where occupancy >= 0 and capacity > 0 and parking_duration >= 0)
"""


@query("p2_clean_events", sql("select * from cleaned", _CLEAN_SQL))
def _(spark, d):
    return cleaning.clean_events(sample.arrivals(spark, d), _ARRIVAL_ORDER)


@query("p2_clean_report", sql("""
    select (select count(*) from arrivals) rows_before, (select count(*) from cleaned) rows_after,
           (select count(*) from arrivals) - (select count(*) from cleaned) rows_removed""", _CLEAN_SQL))
def _(spark, d):
    return cleaning.clean_report(sample.arrivals(spark, d), _ARRIVAL_ORDER)


@query("p3_utilization", sql("""
    select event_id, arrival, round(case when capacity > 0 then occupancy::double / capacity * 100 else 0 end, 9) utilization,
           round(case when capacity > 0 then greatest(0, least(100, occupancy::double / capacity * 100)) else 0 end, 9) utilization_clipped
    from arrivals"""))
def _(spark, d):
    df = cleaning.with_utilization(sample.arrivals(spark, d))
    df = cleaning.with_utilization(df, clipped=True, out="utilization_clipped")
    return rounded(df.select("event_id", "arrival", "utilization", "utilization_clipped"))


@query("p4_available", sql("select event_id, arrival, greatest(0, capacity - occupancy)::int available from arrivals"))
def _(spark, d):
    return sample.arrivals(spark, d).select(
        "event_id", "arrival", available_bays("occupancy", "capacity").cast("int").alias("available")
    )


@query("p5_risk_level", sql("""
    select zone_id, timestamp, event_id,
      case when pct >= 85 then 'HIGH' when pct >= 60 then 'MEDIUM' else 'LOW' end risk_left,
      case when pct > 85 then 'HIGH' when pct > 60 then 'MEDIUM' else 'LOW' end risk_right,
      case when pct >= 90 then 'HIGH' when pct >= 70 then 'MEDIUM' else 'LOW' end risk_scored
    from (select *, case when capacity > 0 then occupancy::double / capacity * 100 else 0 end pct from ev)"""))
def _(spark, d):
    pct = utilization("occupancy", "capacity")
    return sample.events(spark, d).select(
        "zone_id", "timestamp", "event_id", risk_level(pct).alias("risk_left"),
        risk_level(pct, closed="right").alias("risk_right"), risk_level(pct, 70, 90).alias("risk_scored"),
    )


_BANDS_SQL = """
scaled as (select zone_id, zone_name, available * 10 available, utilization from zstate)
"""


def _scaled_state(spark, d):
    """Ten times the bays, so that all vacancy bands occur."""
    return frames.state(spark, d).withColumn("available", F.col("available") * 10)


@query("p6_vacancy_band", sql("""
    select zone_id, available, utilization, available > 40 is_vacancy, available between 10 and 40 is_moderate,
           utilization >= 85 is_critical from scaled where lower(zone_id || ' ' || zone_name) like '%nation_1%'""",
    FEATURES_SQL, STATE_SQL, _BANDS_SQL))
def _(spark, d):
    zones = cleaning.match_zone_text(_scaled_state(spark, d), "Nation_1")
    return cleaning.vacancy_band(zones).select(
        "zone_id", "available", "utilization", "is_vacancy", "is_moderate", "is_critical"
    )


@query("p6_band_counts", sql("""
    select count(*) all_zones, count(*) filter (available > 40) vacancy, count(*) filter (available between 10 and 40) moderate,
           count(*) filter (utilization >= 85) critical from scaled""", FEATURES_SQL, STATE_SQL, _BANDS_SQL))
def _(spark, d):
    return cleaning.band_counts(_scaled_state(spark, d))


@query("p7_to_serving", sql("select zone_id id, zone_name \"name\", capacity bays, latitude lat, longitude lon from zones"))
def _(spark, d):
    return cleaning.to_serving(sample.zones(spark, d), {
        "zone_id": "id", "zone_name": "name", "capacity": "bays", "latitude": "lat", "longitude": "lon",
    })


@query("p8_filter_zones", sql("select * from ev where zone_id in ('Z003', 'Z007')"))
def _(spark, d):
    return cleaning.filter_zones(sample.events(spark, d), ["z003", "Z007"], ignore_case=True)


@query("p9_search_rows", sql("""
    select * from ev where regexp_matches(event_id, 'v0001[0-4]|z003|00:1[0-9]:00$', 'i')
       or regexp_matches("timestamp"::varchar, 'v0001[0-4]|z003|00:1[0-9]:00$', 'i')
       or regexp_matches(vehicle_id, 'v0001[0-4]|z003|00:1[0-9]:00$', 'i')
       or regexp_matches(zone_id, 'v0001[0-4]|z003|00:1[0-9]:00$', 'i')"""))
def _(spark, d):
    return cleaning.search_rows(sample.events(spark, d), "v0001[0-4]|z003|00:1[0-9]:00$")


@query("p9_search_indexed", sql("""
    select * from ev where regexp_matches(event_id, 'v0001[0-4].?$', 'i') or regexp_matches("timestamp"::varchar, 'v0001[0-4].?$', 'i')
       or regexp_matches(vehicle_id, 'v0001[0-4].?$', 'i') or regexp_matches(zone_id, 'v0001[0-4].?$', 'i')"""))
def _(spark, d):
    """The same search where an index of trigrams tells which rows can match."""
    ev = sample.events(spark, d)
    return search.search_indexed(ev, search.search_index(ev, "event_id"), "event_id", "v0001[0-4].?$")


@query("p10_last_days", sql("""
    select * from ev where "timestamp" >= (select max("timestamp") - interval 7 day from ev)"""))
def _(spark, d):
    return cleaning.last_days(sample.events(spark, d), 7)


@query("p11_range_report", sql("""
    select 40 requested_days, round(epoch(e - a) / 86400, 1) coverage_days, a "start", e "end", s available_start, e available_end,
           s > e - interval 40 day truncated
    from (select min("timestamp") s, max("timestamp") e from ev),
         (select min("timestamp") a from ev where "timestamp" >= (select max("timestamp") - interval 40 day from ev))"""))
def _(spark, d):
    return cleaning.range_report(sample.events(spark, d), 40)


@query("p12_mark_duplicates", sql("""
    select event_id, arrival, rn > 1 is_duplicate, case when rn > 1 then 'DROP' else 'VERIFIED' end status
    from (select *, row_number() over (partition by event_id order by "timestamp", arrival) rn from arrivals)"""))
def _(spark, d):
    return cleaning.mark_duplicates(sample.arrivals(spark, d), _ARRIVAL_ORDER).select(
        "event_id", "arrival", "is_duplicate", "status"
    )


_HOLES_SQL = """
holes as (select event_id, case when channel = 'view' then null else occupancy end occupancy,
                 case when channel = 'click' then null else capacity end capacity from elog)
"""


def _holes(spark, d):
    log = sample.event_log(spark, d)
    return log.select(
        "event_id", F.when(F.col("channel") != "view", F.col("occupancy")).alias("occupancy"),
        F.when(F.col("channel") != "click", F.col("capacity")).alias("capacity"),
    )


@query("p13_drop_missing", sql("select * from holes where occupancy is not null", _HOLES_SQL))
def _(spark, d):
    return cleaning.drop_missing(_holes(spark, d), ["occupancy"])


@query("p14_fill_defaults", sql("""
    select event_id, coalesce(occupancy, 0) occupancy, coalesce(capacity, 1) capacity from holes""", _HOLES_SQL))
def _(spark, d):
    return cleaning.fill_defaults(_holes(spark, d), {"occupancy": 0, "capacity": 1})


@query("q1_quality_counts", sql("""
    select count(*) filter (occupancy > capacity) over_capacity, count(*) filter (parking_duration < 0) negative_duration,
           count(*) - count(distinct event_id) duplicate_ids from arrivals"""))
def _(spark, d):
    return quality.quality_counts(sample.arrivals(spark, d))


@query("q2_quality_scores", sql("""
    select 100.0::double timestamp_completeness, round(count(distinct event_id)::double / count(*) * 100, 2) record_uniqueness,
           round(avg((occupancy >= 0 and capacity > 0 and occupancy <= capacity)::int) * 100, 2) range_validity,
           100.0::double schema_compliance,
           round((200 + round(count(distinct event_id)::double / count(*) * 100, 2)
             + round(avg((occupancy >= 0 and capacity > 0 and occupancy <= capacity)::int) * 100, 2)) / 4, 2) quality_average
    from (select * from arrivals)"""))
def _(spark, d):
    return quality.quality_scores(sample.arrivals(spark, d))


@query("q3_check_constraints", sql("""
    select 'not_null(event_id)' "constraint", count(*) filter (event_id is null) violations from arrivals
    union all select 'not_null(zone_id)', count(*) filter (zone_id is null) from arrivals
    union all select 'check(capacity_positive)', count(*) filter (not capacity > 0) from arrivals
    union all select 'check(type_in_set)', count(*) filter (event_type not in ('ENTRY', 'EXIT')) from arrivals
    union all select 'unique(event_id)', count(*) - count(distinct event_id) from arrivals"""))
def _(spark, d):
    spec = quality.TableSpec(
        unique=[("event_id",)], not_null=["event_id", "zone_id"],
        checks={"capacity_positive": "capacity > 0", "type_in_set": "event_type IN ('ENTRY', 'EXIT')"},
    )
    return quality.check_constraints(sample.arrivals(spark, d), spec)


@query("q4_orphans", sql("select event_id, arrival, zone_id from arrivals where zone_id not in (select zone_id from zones)"))
def _(spark, d):
    return quality.orphans(sample.arrivals(spark, d), sample.zones(spark, d)).select("event_id", "arrival", "zone_id")


@query("q5_schema_report", sql("""
    select 1 "position", 'event_id' column_name, 'string' data_type, bool_or(event_id is null) has_nulls from holes
    union all select 2, 'occupancy', 'int', bool_or(occupancy is null) from holes
    union all select 3, 'capacity', 'int', bool_or(capacity is null) from holes""", _HOLES_SQL))
def _(spark, d):
    return quality.schema_report(_holes(spark, d))


@query("q5_catalog", sql("""
    select 'raw' layer, count(*) "rows", 12 "columns" from ev union all select 'zones', count(*), 7 from zones
    union all select 'silver', count(*), 12 from features""", FEATURES_SQL))
def _(spark, d):
    return quality.catalog({
        "raw": sample.events(spark, d), "zones": sample.zones(spark, d).drop("zone_key"),
        "silver": frames.features(spark, d),
    })


@query("q6_ddl", sql("""
    select 'CREATE TABLE holes (' || chr(10) || '    "event_id" VARCHAR NOT NULL,' || chr(10)
      || '    "occupancy" BIGINT' || case when bool_or(occupancy is null) then '' else ' NOT NULL' end || ',' || chr(10)
      || '    "capacity" BIGINT' || case when bool_or(capacity is null) then '' else ' NOT NULL' end || chr(10) || ');' || chr(10) ddl
    from holes""", _HOLES_SQL))
def _(spark, d):
    return quality.ddl_for(_holes(spark, d), "holes")


@query("u1_union_events", sql("""
    select event_id, "timestamp", zone_id, occupancy, source_type, confidence from manual
    union all
    select event_id, "timestamp", zone_id, occupancy, null, null from ev where event_id not in (select event_id from manual)"""))
def _(spark, d):
    both = cleaning.union_events(sample.operator_rows(spark, d), sample.events(spark, d))
    return both.select("event_id", "timestamp", "zone_id", "occupancy", "source_type", "confidence")


@query("u2_sessions_to_events", sql("""
    select event_id, "timestamp", vehicle_id, zone_key, event_type, parking_duration from halves""".replace("zone_key", "'Z' || lpad((zone_key + 1)::varchar, 3, '0') zone_id")))
def _(spark, d):
    return sample.bare_events(spark, d).select(
        "event_id", "timestamp", "vehicle_id", "zone_id", "event_type", "parking_duration"
    )


@query("u3_distinct_times", sql("""
    select "timestamp" from ev union select "timestamp" from bins""", FEATURES_SQL))
def _(spark, d):
    from zoneflow.operators.grid import day_bounds, time_grid
    ev = sample.events(spark, d)
    grid = time_grid(sample.zones(spark, d), *day_bounds(ev))
    return ev.select("timestamp").union(grid.select("timestamp")).distinct()


@query("u4_distinct_values", sql("select distinct vehicle_id from ev order by 1"))
def _(spark, d):
    return sample.events(spark, d).select("vehicle_id").distinct().orderBy("vehicle_id")


@query("l1_total_sort", sql('select zone_id, "timestamp", event_type, event_id from ev order by 1, 2 desc, 3, 4'))
def _(spark, d):
    return sample.events(spark, d).select("zone_id", "timestamp", "event_type", "event_id").orderBy(
        "zone_id", F.desc("timestamp"), "event_type", "event_id"
    )


@query("j3_lookup", sql("""
    select e.event_id, e.arrival, coalesce(z.zone_name, 'unknown') zone_name, coalesce(z.mean_duration_min, 30)::double mean_duration_min,
           round(w.temperature, 9) day_temperature,
           (e."timestamp"::date in (date '2024-01-01', date '2024-01-26'))::int is_holiday
    from arrivals e left join zones z using (zone_id) left join weather w on w."date" = e."timestamp"::date"""))
def _(spark, d):
    from zoneflow.functions.scalar import is_holiday
    dim = sample.zones(spark, d).select("zone_id", "zone_name", "mean_duration_min")
    df = with_lookup(sample.arrivals(spark, d), dim, "zone_id", {"zone_name": "unknown", "mean_duration_min": 30.0})
    days = sample.weather(spark, d).select("date", F.col("temperature").alias("day_temperature"))
    df = with_lookup(df.withColumn("date", F.to_date("timestamp")), days, "date")
    return rounded(df.select(
        "event_id", "arrival", "zone_name", "mean_duration_min", "day_temperature",
        is_holiday("timestamp", sample.HOLIDAYS).alias("is_holiday"),
    ))
