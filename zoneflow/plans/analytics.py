"""Queries over summaries, windows, history and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from zoneflow.operators import aggregates, cleaning, history, occupancy, paging, sketches
from zoneflow.operators.grid import future_target, resample_asof, day_bounds, time_grid
from zoneflow.plans import frames
from zoneflow.plans.frames import FEATURES_SQL, PRED_SQL, STATE_SQL, rounded
from zoneflow.plans.registry import query, sql
from zoneflow.sources import sample

PCT = "case when capacity > 0 then occupancy::double / capacity * 100 else 0 end"
CLIPPED = f"greatest(0, least(100, {PCT}))"


@query("a1_zone_occupancy_summary", sql("""
    select zone_id, round(avg(occupancy), 9) average_occupancy, max(occupancy) maximum_occupancy,
           min(occupancy) minimum_occupancy, count(*) total_events from ev group by 1"""))
def _(spark, d):
    return rounded(aggregates.zone_occupancy_summary(sample.events(spark, d)))


@query("a2_zone_utilization", sql(f"""
    select zone_id, round(avg({PCT}), 9) average_utilization, round(max({PCT}), 9) maximum_utilization from ev group by 1"""))
def _(spark, d):
    return rounded(aggregates.zone_utilization(sample.events(spark, d)))


@query("a3_zone_avg_dwell", sql("""
    select zone_id, round(avg(parking_duration), 9) average_parking_duration_min from ev where event_type = 'EXIT' group by 1"""))
def _(spark, d):
    return rounded(aggregates.zone_avg_dwell(sample.events(spark, d)))


@query("a4_hourly_occupancy", sql("""
    select hour("timestamp")::int "hour", round(avg(occupancy), 9) avg_occupancy from ev group by 1"""))
def _(spark, d):
    return rounded(aggregates.hourly_occupancy(sample.events(spark, d)))


@query("a5_distinct_counts", sql("""
    select count(distinct zone_id) zones, count(distinct vehicle_id) vehicles, count(distinct event_id) unique_events from ev"""))
def _(spark, d):
    return aggregates.distinct_counts(sample.events(spark, d))


_WEEK = """"timestamp" >= timestamp '2024-01-08' and "timestamp" < timestamp '2024-01-15'"""


@query("a5_sketched_week", sql(f"""
    select zone_id, count(*) events, count(distinct vehicle_id) vehicles, true vehicles_close, true dwell_close
    from ev where {_WEEK} and parking_duration is not null group by 1"""))
def _(spark, d):
    """A week of every zone from its days' sketches; both estimates are held against the events of that week."""
    ev = sample.events(spark, d).where("parking_duration IS NOT NULL")
    days = sketches.day_sketches(ev, "vehicle_id", "parking_duration")
    week = sketches.merge_sketches(days.where("day >= '2024-01-08' AND day < '2024-01-15'"), "zone_id")
    told = sketches.read_sketches(week, {"dwell": 0.5}, "about")
    rows = ev.where("timestamp >= '2024-01-08' AND timestamp < '2024-01-15'").join(told.select("zone_id", "dwell"), "zone_id")
    exact = rows.groupBy("zone_id").agg(
        F.count_distinct("vehicle_id").alias("vehicles"), F.avg((F.col("parking_duration") < F.col("dwell")).cast("double")).alias("below"),
        F.avg((F.col("parking_duration") <= F.col("dwell")).cast("double")).alias("upto"))
    return told.join(exact, "zone_id").select(
        "zone_id", "events", "vehicles",
        (F.abs(F.col("about") - F.col("vehicles")) <= sketches.DISTINCT_ERROR * F.col("vehicles")).alias("vehicles_close"),
        ((F.col("below") <= 0.5 + sketches.RANK_ERROR) & (F.col("upto") >= 0.5 - sketches.RANK_ERROR)).alias("dwell_close"))


@query("a6_event_type_counts", sql('select event_type, count(*) "count" from ev group by 1'))
def _(spark, d):
    return aggregates.event_type_counts(sample.events(spark, d))


_NUMERIC = ["occupancy", "capacity", "parking_duration", "temperature", "rainfall"]


@query("a7_numeric_summary", sql(" union all ".join(f"""
    select '{c}' "column", count({c}) "count", round(avg({c}), 9) mean, round(stddev_samp({c}), 9) stddev,
           min({c})::double "min", max({c})::double "max", round(quantile_cont({c}, 0.25), 9) q1,
           round(quantile_cont({c}, 0.5), 9) median, round(quantile_cont({c}, 0.75), 9) q3 from ev""" for c in _NUMERIC)))
def _(spark, d):
    return rounded(aggregates.numeric_summary(sample.events(spark, d), _NUMERIC))


@query("a7_date_range", sql('select min("timestamp") first_event, max("timestamp") last_event from ev'))
def _(spark, d):
    return aggregates.date_range(sample.events(spark, d))


@query("a8_network_kpis", sql("""
    select count(*) zones, sum(capacity)::bigint capacity, sum(occupancy)::bigint occupied,
           (sum(capacity) - sum(occupancy))::bigint available, round(sum(occupancy)::double / sum(capacity) * 100, 1) utilization
    from zstate""", FEATURES_SQL, STATE_SQL))
def _(spark, d):
    return aggregates.network_kpis(frames.state(spark, d))


def _flow_sql(window: str) -> str:
    return sql("""
    select count(*) filter (event_type = 'ENTRY') entries, count(*) filter (event_type = 'EXIT') exits,
           count(*) filter (event_type = 'ENTRY') - count(*) filter (event_type = 'EXIT') flow_delta,
           (select max(n) from (select count(*) n from minute group by date_trunc('second', "timestamp"))) peak_events_per_second,
           round(greatest(0, count(*) - 1) / greatest(1, epoch(max("timestamp") - min("timestamp"))), 2) events_per_second,
           (select round(coalesce(median(parking_duration) filter (parking_duration > 0), 0), 1) from minute) median_dwell,
           (select arg_max(temperature, ("timestamp", event_id)) from minute) temperature,
           (select arg_max(rainfall, ("timestamp", event_id)) from minute) rainfall
    from minute""", f"""
    minute as (select * from ev where "timestamp" >= (select max("timestamp") - interval {window} from ev))""")


@query("a9_live_flow", _flow_sql("60 second"))
def _(spark, d):
    return aggregates.live_flow(sample.events(spark, d))


@query("a9_live_flow_hour", _flow_sql("1 hour"))
def _(spark, d):
    return aggregates.live_flow(sample.events(spark, d), window="1 HOUR")


_TREND_SQL = """
trend as (
  select b "timestamp", zone_id, coalesce(z.capacity, 1) capacity, h.occupancy,
         greatest(0, least(100, h.occupancy / coalesce(z.capacity, 1) * 100)) utilization
  from (select date_trunc('hour', "timestamp") b, zone_id, avg(occupancy) occupancy from arrivals group by all) h
  left join zones z using (zone_id))
"""


@query("a10_history_trend", sql("""
    select "timestamp", zone_id, capacity, round(occupancy, 9) occupancy, round(utilization, 9) utilization from trend""", _TREND_SQL))
def _(spark, d):
    return rounded(history.history_trend(sample.arrivals(spark, d), sample.zones(spark, d)))


_WINDOW_SQL = """
win as (
  select time_bucket(interval 5 minute, "timestamp") window_start, time_bucket(interval 5 minute, "timestamp") + interval 5 minute window_end,
         zone_id, avg(occupancy) avg_occupancy, max(occupancy) max_occupancy, avg(capacity) avg_capacity, count(*) event_count,
         avg(occupancy) / avg(capacity) * 100 utilization_pct
  from ev group by all)
"""


@query("t2_zone_window_metrics", sql("""
    select window_start, window_end, zone_id, round(avg_occupancy, 9) avg_occupancy, max_occupancy,
           round(avg_capacity, 9) avg_capacity, event_count, round(utilization_pct, 9) utilization_pct from win""", _WINDOW_SQL))
def _(spark, d):
    return rounded(aggregates.flat_window(aggregates.zone_window_metrics(sample.events(spark, d))))


@query("a11_occupancy_summary", sql("""
    select window_start "timestamp", zone_id, round(avg_occupancy, 9) avg_occupancy,
           round_even(avg_occupancy / avg_capacity * 100, 1) utilization, event_count from win""", _WINDOW_SQL))
def _(spark, d):
    metrics = aggregates.flat_window(aggregates.zone_window_metrics(sample.events(spark, d)))
    return rounded(aggregates.occupancy_summary(metrics))


_HEAT_SQL = f"""
heat as (
  select zone_id, (isodow("timestamp") - 1)::int day_of_week, hour("timestamp")::int "hour", avg(occupancy) occupancy,
         avg({CLIPPED}) utilization
  from arrivals group by all)
"""


@query("a12_heatmap", sql("""
    select zone_id, day_of_week, "hour", round(occupancy, 9) occupancy, round(utilization, 9) utilization from heat""", _HEAT_SQL))
def _(spark, d):
    return rounded(history.heatmap(sample.arrivals(spark, d)))


_MATRIX_SQL = """
matrix as (
  select s.i // 24 day_of_week, s.i % 24 "hour", coalesce(h.u, 0)::double utilization
  from range(168) s(i) left join (select day_of_week d, "hour" h, avg(utilization) u from heat group by 1, 2) h
    on h.d = s.i // 24 and h.h = s.i % 24)
"""


@query("a12_heatmap_network", sql(
    'select day_of_week::int day_of_week, "hour"::int "hour", round(utilization, 9) utilization from matrix', _HEAT_SQL, _MATRIX_SQL))
def _(spark, d):
    return rounded(history.heatmap_network(history.heatmap(sample.arrivals(spark, d))))


@query("a12_peak_slot", sql("""
    select day_of_week::int day_of_week, "hour"::int "hour", round(utilization, 9) utilization from matrix
    order by round(utilization, 9) desc, 1, 2 limit 1""", _HEAT_SQL, _MATRIX_SQL))
def _(spark, d):
    return history.peak_slot(rounded(history.heatmap_network(history.heatmap(sample.arrivals(spark, d)))))


@query("a13_silver_latest", sql("""
    select date_trunc('hour', "timestamp") window_start, zone_id, count(*) event_count, round(avg(occupancy), 9) avg_occupancy
    from ev group by 1, 2"""))
def _(spark, d):
    """An append log of growing versions of each hour: after 20, 40 and 60 minutes."""
    ev = sample.events(spark, d)
    hour = F.date_trunc("hour", "timestamp")
    part = F.floor(F.minute("timestamp") / 20).cast("int")
    # Each third of an hour counts in its own version and in all later ones.
    versions = ev.withColumn("batch_id", F.explode(F.sequence(part, F.lit(2))))
    log = versions.groupBy(hour.alias("window_start"), "zone_id", "batch_id").agg(
        F.count("*").alias("event_count"), F.avg("occupancy").alias("avg_occupancy")
    )
    return rounded(aggregates.silver_latest(log).drop("batch_id"))


_FLOW_SQL = """
flow as (
  select b bucket, zone_id, f.entry, f."exit", coalesce(z.capacity, 1) capacity,
         (f.entry + f."exit")::double / coalesce(z.capacity, 1) * 100 turnover_rate, f."exit" * 60 estimated_revenue
  from (select date_trunc('hour', "timestamp") b, zone_id, count(*) filter (event_type = 'ENTRY') entry,
               count(*) filter (event_type = 'EXIT') "exit" from arrivals group by all) f
  left join zones z using (zone_id))
"""


@query("a14_hourly_flow", sql("""
    select bucket, zone_id, entry, "exit", capacity, round(turnover_rate, 9) turnover_rate, estimated_revenue from flow""", _FLOW_SQL))
def _(spark, d):
    return rounded(history.hourly_flow(sample.arrivals(spark, d), sample.zones(spark, d)))


@query("a15_dwell_histogram", sql("""
    select bin, label, count(*) stays, round(count(*) * 100.0::double / (select count(*) from stay), 9) share_pct,
           (select round(avg(m), 9) from stay) mean_minutes, (select round(quantile_cont(m, 0.5), 9) from stay) median_minutes,
           (select list_sort(list(m))[(count(*) // 2 + 1)::int] from stay) upper_median_minutes
    from (select case when m < 15 then 0 when m < 30 then 1 when m < 60 then 2 when m < 120 then 3 when m < 180 then 4
                      when m < 240 then 5 else 6 end bin, m from stay)
    join (values (0, '0-15m'), (1, '15-30m'), (2, '30-60m'), (3, '1-2h'), (4, '2-3h'), (5, '3-4h'), (6, '4h+')) l(bin, label) using (bin)
    group by 1, 2""", "stay as (select parking_duration m from arrivals where parking_duration > 0)"))
def _(spark, d):
    return rounded(history.dwell_histogram(sample.arrivals(spark, d)))


_HOURS_SQL = f"""
hours as (
  select hour("timestamp")::int "hour", avg(occupancy) occupancy, avg({CLIPPED}) utilization, avg(temperature) temperature,
         avg(rainfall) rainfall from ev group by 1)
"""


@query("a17_weather_by_hour", sql("""
    select "hour", round(occupancy, 9) occupancy, round(utilization, 9) utilization, round(temperature, 9) temperature,
           round(rainfall, 9) rainfall from hours""", _HOURS_SQL))
def _(spark, d):
    return rounded(history.weather_by_hour(sample.events(spark, d)))


@query("a17_rain_effect", sql(f"""
    select count(*) filter (rainfall > 0) rain_hours,
           round(coalesce(avg(utilization) filter (rainfall > 0), 0) - coalesce(avg(utilization) filter (rainfall = 0), 0), 9) rain_gap
    from (select date_trunc('hour', "timestamp") h, zone_id, avg({CLIPPED}) utilization, avg(rainfall) rainfall from ev group by all)"""))
def _(spark, d):
    """Hours of the log and not of the day, so that dry ones occur."""
    ev = sample.events(spark, d)
    pct = F.avg(F.col("occupancy") / F.col("capacity") * 100).alias("utilization")
    hours = ev.groupBy(F.date_trunc("hour", "timestamp").alias("h"), "zone_id").agg(pct, F.avg("rainfall").alias("rainfall"))
    return rounded(history.rain_effect(hours))


@query("a18_history_summary", sql(f"""
    select count(*) "events", round(avg({CLIPPED}), 1) average_utilization,
           (select round(avg(parking_duration), 1) from recent where parking_duration > 0) average_dwell_minutes,
           (select day_of_week from slot) peak_day_of_week, (select "hour" from slot) peak_hour,
           (select round(u, 1) from slot) peak_utilization, count(*) filter (event_type = 'EXIT') * 60 estimated_revenue,
           (select count(*) from (select hour("timestamp") from recent group by 1 having avg(rainfall) > 0)) rain_affected_hours
    from recent""", f"""
    recent as (select * from arrivals where "timestamp" >= (select max("timestamp") - interval 7 day from arrivals)),
    slot as (select (isodow("timestamp") - 1)::int day_of_week, hour("timestamp")::int "hour", zone_id,
                    round(avg({CLIPPED}), 9) u from recent group by all order by u desc, 1, 2 limit 1)"""))
def _(spark, d):
    return rounded(history.history_summary(cleaning.last_days(sample.arrivals(spark, d), 7)))


@query("a19_rollup_weekly", sql("""
    select zone_id, date_trunc('week', "timestamp" + interval 1 day) - interval 1 day bucket, round(avg(utilization), 9) "value"
    from trend group by all""", _TREND_SQL))
def _(spark, d):
    trend = history.history_trend(sample.arrivals(spark, d), sample.zones(spark, d))
    return rounded(history.rollup_series(trend, "utilization", "weekly"))


@query("a19_rollup_daily_flow", sql("""
    select date_trunc('day', bucket) bucket, round(sum(entry), 9)::double "value" from flow group by 1""", _FLOW_SQL))
def _(spark, d):
    flow = history.hourly_flow(sample.arrivals(spark, d), sample.zones(spark, d))
    return rounded(history.rollup_series(flow, "entry", "daily", how="sum", ts="bucket"))


@query("a20_downsample", sql("""
    select zone_id, bucket, round("value", 9) "value" from numbered
    where (i - 1) % greatest(1, ceil(n / 120.0)::bigint) = 0 or i = n""", _TREND_SQL, """
    numbered as (
      select zone_id, "timestamp" bucket, utilization "value", row_number() over (partition by zone_id order by "timestamp") i,
             count(*) over (partition by zone_id) n from trend)"""))
def _(spark, d):
    trend = history.history_trend(sample.arrivals(spark, d), sample.zones(spark, d))
    series = history.rollup_series(trend, "utilization", "hourly")
    return rounded(history.downsample(series, history.points_for("daily")))


@query("a21_network_forecast_series", sql("""
    select "timestamp", round(sum(current_occupancy), 9) actual, round(sum(predicted_occupancy), 9) predicted
    from pred group by 1 order by 1 desc limit 48""", FEATURES_SQL, PRED_SQL))
def _(spark, d):
    return rounded(aggregates.network_forecast_series(frames.pred(spark, d)))


_METRIC_SQL = """
long as (
  select zone_id, is_validation, actual_occupancy y, 'predicted_occupancy' model, predicted_occupancy p from pred
  union all select zone_id, is_validation, actual_occupancy, 'linear_prediction', linear_prediction from pred),
held as (select * from long where is_validation = 1)
"""


def _metrics_sql(keys: str) -> str:
    return sql(f"""
    select {keys} model, count(*) samples, round(avg(abs(y - p)), 9) mae, round(sqrt(avg((y - p) * (y - p))), 9) rmse,
           round(case when var_pop(y) > 0 then 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) else 1 end, 9) r2
    from held group by all""", FEATURES_SQL, PRED_SQL, _METRIC_SQL)


@query("a22_regression_metrics", _metrics_sql(""))
def _(spark, d):
    return rounded(aggregates.regression_metrics(frames.pred(spark, d), ["predicted_occupancy", "linear_prediction"]))


@query("a22_regression_metrics_by_zone", _metrics_sql("zone_id,"))
def _(spark, d):
    return rounded(aggregates.regression_metrics(
        frames.pred(spark, d), ["predicted_occupancy", "linear_prediction"], by_zone=True
    ))


@query("a23_utilization_stats", sql(f"""
    select round(avg({PCT}), 9) mean, round(max({PCT}), 9) "max", round(quantile_cont({PCT}, 0.9), 9) p90 from ev"""))
def _(spark, d):
    return rounded(aggregates.utilization_stats(sample.events(spark, d)))


@query("a24_top_busy_zones", sql("""
    select zone_id, round(avg(occupancy), 2) avg_occupancy, count(*) "events" from ev group by 1
    order by avg_occupancy desc, zone_id limit 5"""))
def _(spark, d):
    return aggregates.top_busy_zones(sample.events(spark, d))


@query("a26_offset_digest", sql("""
    select 'events:' || event_type topic, zone_key::int "partition", (sum(2 * session_id + sgn))::bigint "offset",
           sum(greatest(0, 3 * session_id - (2 * session_id + sgn)))::bigint lag
    from (select *, substr(event_id, 2)::bigint // 2 session_id from halves) where channel <> 'error' group by all"""))
def _(spark, d):
    """Commit lines of the log, those of the `error` channel malformed."""
    log = sample.event_log(spark, d)
    session = F.floor(F.expr("substring(event_id, 2)").cast("bigint") / 2)
    sign = F.when(F.col("event_type") == "ENTRY", 1).otherwise(-1)
    number = F.substring("zone_id", 2, 3).cast("int") - 1
    good = F.concat_ws(":", F.lit("events"), "event_type", number.cast("string"), (session * 2 + sign).cast("string"))
    bad = F.concat_ws(":", F.lit("events"), F.lit("x"), F.lit("1"))
    lines = log.select(
        F.when(F.col("channel") == "error", bad).otherwise(good).alias("value"), (session * 3).alias("end_offset")
    )
    return aggregates.offset_digest(lines)


@query("a27_capacity_pressure", sql("""
    select *, count(*) filter (utilization >= 85) over () critical_in_top
    from (select zone_id, zone_name, capacity, utilization from zstate order by utilization desc, zone_id limit 10)""",
    FEATURES_SQL, STATE_SQL))
def _(spark, d):
    return aggregates.capacity_pressure(frames.state(spark, d))


@query("w1_peak_hour_per_zone", sql("""
    select zone_id, "hour", avg_occupancy from (
      select zone_id, hour("timestamp")::int "hour", round(avg(occupancy), 9) avg_occupancy,
             row_number() over (partition by zone_id order by avg(occupancy) desc, hour("timestamp")) rn
      from ev group by 1, 2, hour("timestamp")) where rn = 1"""))
def _(spark, d):
    return rounded(aggregates.peak_hour_per_zone(sample.events(spark, d)))


@query("w2_running_occupancy", sql("select event_id, zone_id, \"timestamp\", event_type, occupancy from ev"))
def _(spark, d):
    return occupancy.running_occupancy(sample.bare_events(spark, d)).select(
        "event_id", "zone_id", "timestamp", "event_type", "occupancy"
    )


@query("w3_future_target", sql("""
    select zone_id, "timestamp", current_occupancy, future_occupancy from ahead where future_occupancy is not null""", FEATURES_SQL))
def _(spark, d):
    return future_target(_resampled(spark, d)).select("zone_id", "timestamp", "current_occupancy", "future_occupancy")


def _resampled(spark, d):
    ev = sample.events(spark, d)
    start, end = day_bounds(ev)
    return resample_asof(ev, time_grid(sample.zones(spark, d).select("zone_id", "capacity"), start, end), start)


@query("j5_resample_asof", sql('select zone_id, "timestamp", capacity, current_occupancy from resampled', FEATURES_SQL))
def _(spark, d):
    return _resampled(spark, d).select("zone_id", "timestamp", "capacity", "current_occupancy")


@query("j6_time_grid", sql('select zone_id, "timestamp" from spine', FEATURES_SQL))
def _(spark, d):
    ev = sample.events(spark, d)
    return time_grid(sample.zones(spark, d).select("zone_id"), *day_bounds(ev))


@query("w4_latest_per_zone", sql("""
    select * from ev qualify row_number() over (partition by zone_id order by "timestamp" desc, event_id desc) = 1"""))
def _(spark, d):
    return occupancy.latest_per_zone(sample.events(spark, d), ["timestamp", "event_id"])


@query("w6_last_per_instant", sql("""
    select * from ev qualify row_number() over (partition by zone_id, "timestamp" order by event_type desc, event_id desc) = 1"""))
def _(spark, d):
    return occupancy.last_per_instant(sample.events(spark, d))


@query("w7_assign_event_ids", sql("""
    select event_id old_id, 'E' || lpad((row_number() over (order by zone_id, "timestamp", event_type, event_id))::varchar, 8, '0') event_id
    from ev"""))
def _(spark, d):
    ev = sample.events(spark, d).select(F.col("event_id").alias("old_id"), "zone_id", "timestamp", "event_type")
    return occupancy.assign_event_ids(ev, ["zone_id", "timestamp", "event_type", "old_id"]).select("old_id", "event_id")


@query("l2_top_k", sql("select session_id, dwell_min from stays order by dwell_min desc, session_id limit 25"))
def _(spark, d):
    return sample.sessions(spark, d).select("session_id", "dwell_min").orderBy(F.desc("dwell_min"), "session_id").limit(25)


@query("l3_recent_events", sql("""
    select event_id, "timestamp", zone_id, event_type, occupancy, source_type from (
      select event_id, "timestamp", zone_id, event_type, occupancy, source_type from manual
      union all
      select event_id, "timestamp", zone_id, event_type, occupancy, null from ev where event_id not in (select event_id from manual))
    order by "timestamp" desc, event_id desc limit 2000"""))
def _(spark, d):
    rows = paging.recent_events(sample.events(spark, d), sample.operator_rows(spark, d))
    return rows.select("event_id", "timestamp", "zone_id", "event_type", "occupancy", "source_type")


@query("l4_page", """
    select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey desc limit 50 offset 100""")
def _(spark, d):
    orders = sample.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return paging.page(orders, 3, 50, ["-o_totalprice", "-o_orderkey"])


@query("l4_deep_page", """
    select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey desc limit 50 offset 1000""")
def _(spark, d):
    orders = sample.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return paging.deep_page(orders, 1000, 50, ["-o_totalprice", "-o_orderkey"])


@query("l4_last_points", sql("""
    select "timestamp", event_id, occupancy from (
      select * from ev where zone_id = 'Z001' order by "timestamp" desc, event_id desc limit 960)"""))
def _(spark, d):
    series = sample.events(spark, d).where("zone_id = 'Z001'").select("timestamp", "event_id", "occupancy")
    return paging.last_points(series, 960, ["timestamp", "event_id"])


@query("l4_page_info", """
    select count(*) total, greatest(1, ceil(count(*) / 200.0))::int pages, greatest(1, ceil(count(*) / 200.0))::int page from orders""")
def _(spark, d):
    return paging.page_info(sample.table(spark, d, "orders"), 1_000_000, 200)


@query("l5_template_recent_events", sql("""
    select "timestamp", event_id, vehicle_id, zone_id, event_type, occupancy, capacity from ev
    order by "timestamp" desc, event_id desc limit 100"""))
def _(spark, d):
    paging.register(sample.events(spark, d), "bronze_events")
    return paging.run_template(spark, "recent_events", 500)


@query("l5_template_forecast_validation", sql("""
    select "timestamp", zone_id, current_occupancy, round(predicted_occupancy, 9) predicted_occupancy, capacity, risk_level
    from pred order by "timestamp" desc, zone_id limit 20""", FEATURES_SQL, PRED_SQL))
def _(spark, d):
    paging.register(frames.pred(spark, d), "predictions")
    return rounded(paging.run_template(spark, "forecast_validation", 20))


@query("l5_template_silver_features", sql("""
    select "timestamp", zone_id, "hour", round(temperature, 9) temperature, round(rainfall, 9) rainfall, current_occupancy,
           capacity, average_duration from features order by "timestamp" desc, zone_id limit 20""", FEATURES_SQL))
def _(spark, d):
    paging.register(frames.features(spark, d), "ml_features")
    return rounded(paging.run_template(spark, "silver_features", 20))


@query("l5_template_capacity_pressure", sql("""
    select zone_id, zone_name, occupancy, capacity, utilization, available, risk from zstate
    order by utilization desc, available, zone_id limit 20""", FEATURES_SQL, STATE_SQL))
def _(spark, d):
    paging.register(frames.state(spark, d), "zone_state")
    return paging.run_template(spark, "capacity_pressure", 20)
