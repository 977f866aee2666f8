"""Queries over zone state, routing, forecasts and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from zoneflow.ml import forecast
from zoneflow.operators import occupancy, routing
from zoneflow.operators.cleaning import last_days
from zoneflow.plans import frames
from zoneflow.plans.frames import ANALYTICAL, FEATURES_SQL, LINEAR, PRED_SQL, STATE_SQL, rounded
from zoneflow.plans.registry import query, sql
from zoneflow.sources import sample


@query("j1_zones_with_snapshot", sql("""
    select z.zone_id, z.capacity, z.zone_name, s.occupancy
    from zones z left join (select zone_id, occupancy, case when zone_id <= 'Z010' then capacity + 1 else capacity end capacity from snap) s
      on s.zone_id = z.zone_id and s.capacity = z.capacity""", FEATURES_SQL, STATE_SQL))
def _(spark, d):
    """Snapshots of the first ten zones were taken at another capacity."""
    shifted = F.when(F.col("zone_id") <= "Z010", F.col("capacity") + 1).otherwise(F.col("capacity"))
    snap = frames.snapshot(spark, d).withColumn("capacity", shifted)
    return occupancy.zones_with_snapshot(sample.zones(spark, d).select("zone_id", "capacity", "zone_name"), snap)


@query("j2_zone_names", sql("""
    select a.event_id, a.arrival, a.zone_id, z.zone_name from arrivals a left join zones z using (zone_id)"""))
def _(spark, d):
    named = occupancy.with_zone_names(sample.arrivals(spark, d), sample.zones(spark, d))
    return named.select("event_id", "arrival", "zone_id", "zone_name")


@query("j2_zone_names_inner", sql("""
    select a.zone_id, z.zone_name, count(*) n from arrivals a join zones z using (zone_id) group by all"""))
def _(spark, d):
    named = occupancy.with_zone_names(sample.arrivals(spark, d), sample.zones(spark, d), "inner")
    return named.groupBy("zone_id", "zone_name").agg(F.count("*").alias("n"))


@query("j4_zone_state", sql("""
    select zone_id, zone_name, capacity, occupancy, source, updated_at, confidence, utilization, available, risk from zstate""",
    FEATURES_SQL, STATE_SQL))
def _(spark, d):
    return frames.state(spark, d).select(
        "zone_id", "zone_name", "capacity", "occupancy", "source", "updated_at", "confidence", "utilization",
        "available", "risk",
    )


_PAIRS_SQL = """
pairs as (
  select a.zone_id source_zone, b.zone_id target_zone, b.available, b.utilization,
         12742 * atan2(sqrt(h), sqrt(greatest(0, 1 - h))) km
  from places a, places b,
       lateral (select power(sin(radians(b.latitude - a.latitude) / 2), 2)
         + cos(radians(a.latitude)) * cos(radians(b.latitude)) * power(sin(radians(b.longitude - a.longitude) / 2), 2) h)
  where a.zone_id <> b.zone_id and b.available > 0),
graded as (select *, round(available - utilization * 0.2::double - km * 2.5::double, 2) recommendation_score from pairs),
placed as (select *, row_number() over (partition by source_zone order by recommendation_score desc, target_zone) "rank" from graded),
options as (
  select source_zone, "rank", target_zone, round(km, 1) distance_km, greatest(2, round_even(km / 22 * 60, 0))::int drive_minutes,
         recommendation_score from placed where "rank" <= 5)
"""

_STATE_PLACES_SQL = "places as (select zone_id, latitude, longitude, available, utilization from zstate)"


@query("j7_reroute_candidates", sql("select * from options", FEATURES_SQL, STATE_SQL, _STATE_PLACES_SQL, _PAIRS_SQL))
def _(spark, d):
    return routing.reroute_candidates(frames.state(spark, d))


@query("j8_decide_reroute", sql("""
    select r.request_id, r.source_zone,
           case when z.zone_id is null then 'UNKNOWN_SOURCE' when o.target_zone is not null then 'RECORDED'
                when r.want <> '' then 'UNAVAILABLE_TARGET' else 'NO_DESTINATION' end status,
           o.target_zone, o.distance_km, o.drive_minutes
    from requests r left join places z on z.zone_id = r.source_zone
    left join options o on o.source_zone = r.source_zone
      and ((r.want = '' and o."rank" = 1) or o.target_zone = r.want)""", FEATURES_SQL, STATE_SQL, _STATE_PLACES_SQL, _PAIRS_SQL, """
    requests as (
      select session_id request_id, case when channel = 'error' then 'Z999' else 'Z' || lpad((zone_key + 1)::varchar, 3, '0') end source_zone,
             case when channel in ('view', 'click') then 'Z' || lpad((k % 25 + 1)::varchar, 3, '0') else '' end want
      from stays)"""))
def _(spark, d):
    """One request per stay: unknown sources, chosen targets, or no choice."""
    stays = sample.sessions(spark, d)
    requests = stays.select(
        F.col("session_id").alias("request_id"),
        F.when(F.col("channel") == "error", "z999").otherwise(F.lower("zone_id")).alias("source_zone"),
        F.when(F.col("channel").isin("view", "click"), F.format_string("z%03d", F.col("k") % 25 + 1)).alias("target_zone"),
    )
    state = frames.state(spark, d)
    return routing.decide_reroute(requests, state, routing.reroute_candidates(state))


@query("j9_best_overflow", sql("""
    select source_zone, rn "rank", target_zone, available from (
      select a.zone_id source_zone, b.zone_id target_zone, b.available,
             row_number() over (partition by a.zone_id order by b.available desc, b.zone_id)::int rn
      from zstate a join zstate b on a.zone_id <> b.zone_id) where rn <= 3""", FEATURES_SQL, STATE_SQL))
def _(spark, d):
    return routing.best_overflow(frames.state(spark, d))


@query("j9_best_hub", sql("""
    select zone_id, utilization, available from zstate where available > 0 order by utilization, available desc, zone_id limit 1""",
    FEATURES_SQL, STATE_SQL))
def _(spark, d):
    return routing.best_hub(frames.state(spark, d)).select("zone_id", "utilization", "available")


@query("j9_diversion_plan", sql("""
    select zone_id, zone_name, available, utilization from zstate where available > 0 and risk <> 'HIGH'
    order by available desc, zone_id limit 3""", FEATURES_SQL, STATE_SQL))
def _(spark, d):
    return routing.diversion_plan(frames.state(spark, d)).select("zone_id", "zone_name", "available", "utilization")


_NETWORK_SQL = f"""
projected as (
  select *, {ANALYTICAL.format(cap='capacity::double', occ='occupancy::double', hour='18', rain='2.5::double',
                               dwell='mean_duration_min', holiday='0')} f from zstate),
outlook as (
  select *, round_even(f, 1) forecast_occupancy_30m, round_even(greatest(0, least(100, f / capacity * 100)), 1) forecast_utilization_30m from projected)
"""


def _outlook(spark, d):
    return forecast.network_forecast(frames.state(spark, d), hour=18, rainfall=2.5)


_FORECAST_SQL = """
latest_pred as (select * from pred qualify row_number() over (partition by zone_id order by "timestamp" desc) = 1),
zforecast as (select zone_id, predicted_occupancy, capacity, predicted_occupancy / capacity * 100 forecast_utilization from latest_pred)
"""


@query("j10_risk_matrix", sql("""
    select zone_id, zone_name, round(predicted, 9) predicted, capacity, round(load, 9) projected_utilization,
           case when load >= 85 then 'CRITICAL' when load >= 60 then 'MODERATE' else 'NORMAL' end band
    from (select o.*, coalesce(z.predicted_occupancy, o.forecast_occupancy_30m, o.occupancy) predicted,
                 coalesce(z.forecast_utilization, o.forecast_utilization_30m) load
          from outlook o left join (select * from zforecast where zone_id > 'Z010') z using (zone_id))
    order by load desc, zone_id limit 10""", FEATURES_SQL, STATE_SQL, PRED_SQL, _NETWORK_SQL, _FORECAST_SQL))
def _(spark, d):
    """The first ten zones have no model forecast."""
    known = forecast.zone_forecasts(frames.pred(spark, d)).where("zone_id > 'Z010'")
    return rounded(forecast.risk_matrix(_outlook(spark, d), known))


@query("j11_weather_now", sql("""
    select round((select max(temperature) from weather where "date" = (select max("date") from weather)), 9) temperature,
           arg_max(rainfall, ("timestamp", event_id)) rainfall from ev"""))
def _(spark, d):
    """The live reading has a temperature only."""
    days = sample.weather(spark, d)
    live = days.orderBy(F.desc("date")).limit(1).select("temperature", F.lit(None).cast("double").alias("rainfall"))
    return rounded(forecast.weather_now(live, sample.events(spark, d)))


@query("ml1_build_features", sql("""
    select * replace (round(temperature, 9) as temperature, round(rainfall, 9) as rainfall) from features""", FEATURES_SQL))
def _(spark, d):
    return rounded(frames.features(spark, d))


@query("ml2_split", sql('select zone_id, "timestamp", is_validation from pred', FEATURES_SQL, PRED_SQL))
def _(spark, d):
    train, held = forecast.split(frames.features(spark, d))
    keys = ["zone_id", "timestamp"]
    return train.select(*keys, F.lit(0).alias("is_validation")).union(held.select(*keys, F.lit(1).alias("is_validation")))


@query("ml6_linear_importance", sql(f"""
    select feature, round(raw / sum(raw) over (), 9) importance from (
      {" union all ".join(f"select '{c}' feature, abs({w}::double * coalesce(stddev_pop({c}), 0)) raw from train"
                          for c, w in forecast.LINEAR_COEFFICIENTS.items())})""".replace("(hour)", '("hour")'),
    FEATURES_SQL, PRED_SQL, """
    train as (select f.* from features f join pred p on p.zone_id = f.zone_id and p."timestamp" = f."timestamp"
              where p.is_validation = 0)"""))
def _(spark, d):
    train, _held = forecast.split(frames.features(spark, d))
    return rounded(forecast.linear_importance(train))


@query("ml7_score_linear", sql(f"""
    select zone_id, "timestamp", round({LINEAR}, 9) score from features""", FEATURES_SQL))
def _(spark, d):
    return rounded(frames.features(spark, d).select("zone_id", "timestamp", forecast.score_linear().alias("score")))


@query("ml8_score_recent", sql("""
    select zone_id, "timestamp", round(linear_prediction, 1) linear_prediction, round(predicted_occupancy, 1) predicted_occupancy,
           risk_level, is_validation
    from pred where "timestamp" >= (select max("timestamp") - interval 7 day from pred)""", FEATURES_SQL, PRED_SQL))
def _(spark, d):
    """Recent rows scored by the two portable models; the trained ones are `ml8_score_recent_models`."""
    recent = last_days(frames.pred(spark, d), 7)
    return recent.select(
        "zone_id", "timestamp", F.round("linear_prediction", 1).alias("linear_prediction"),
        F.round("predicted_occupancy", 1).alias("predicted_occupancy"), "risk_level", "is_validation",
    )


@query("ml9_forecast_analytical", sql("""
    select zone_id, "timestamp", round(predicted_occupancy, 9) predicted_occupancy from pred""", FEATURES_SQL, PRED_SQL))
def _(spark, d):
    return rounded(frames.pred(spark, d).select("zone_id", "timestamp", "predicted_occupancy"))


@query("ml9_network_forecast", sql("""
    select zone_id, forecast_occupancy_30m, forecast_utilization_30m, forecast_utilization_30m >= 85 is_risk_hub from outlook""",
    FEATURES_SQL, STATE_SQL, _NETWORK_SQL))
def _(spark, d):
    return _outlook(spark, d).select("zone_id", "forecast_occupancy_30m", "forecast_utilization_30m", "is_risk_hub")


def _band_sql(points: str) -> str:
    return sql(f"""
    select zone_id, "timestamp", round(predicted_occupancy, 9) predicted_occupancy, capacity,
           round(greatest(0, least(capacity, predicted_occupancy - half)), 9) confidence_low,
           round(greatest(0, least(capacity, predicted_occupancy + half)), 9) confidence_high,
           round(greatest(0, capacity - predicted_occupancy), 9) available,
           round(predicted_occupancy - current_occupancy, 9) net_change,
           round(predicted_occupancy / capacity * 100, 9) utilization, risk_level risk
    from (select p.*, greatest(1, 1.96::double * rmse) half from {points} p join (
      select zone_id, sqrt(avg((actual_occupancy - predicted_occupancy) ** 2)) rmse from pred where is_validation = 1 group by 1) using (zone_id))""",
        FEATURES_SQL, PRED_SQL, _FORECAST_SQL)


@query("ml10_prediction_band", _band_sql("latest_pred"))
def _(spark, d):
    return rounded(forecast.prediction_band(frames.pred(spark, d)))


@query("ml10_band_envelope", _band_sql("pred"))
def _(spark, d):
    return rounded(forecast.prediction_band(frames.pred(spark, d), per_row=True))


@query("ml11_zone_forecasts", sql("""
    select zone_id, round(predicted_occupancy, 9) predicted_occupancy, capacity, round(forecast_utilization, 9) forecast_utilization
    from zforecast""", FEATURES_SQL, PRED_SQL, _FORECAST_SQL))
def _(spark, d):
    return rounded(forecast.zone_forecasts(frames.pred(spark, d)))


@query("ml12_scenarios", sql("""
    select zone_id, scenario, capacity, current_occupancy, round(analytical, 9) analytical_forecast, round(linear, 9) linear_forecast,
           case when analytical / capacity * 100 >= 85 then 'HIGH' when analytical / capacity * 100 >= 60 then 'MEDIUM' else 'LOW' end risk
    from tried""", f"""
    presets(scenario, "hour", rainfall, temperature, share, average_duration, is_holiday) as (values
      ('monsoon', 18, 42::double, 25::double, 0.72::double, 105::double, 0), ('match', 19, 0, 30, 0.82, 140, 1),
      ('festival', 20, 2, 29, 0.88, 165, 1), ('weekday', 18, 0, 31, 0.62, 80, 0)),
    inputs as (select zone_id, capacity, p.*, floor(capacity * share + 0.5) current_occupancy, 0 day_of_week, 0 is_weekend from zones, presets p),
    tried as (select *, {ANALYTICAL.format(cap='capacity::double', occ='current_occupancy', hour='"hour"', rain='rainfall',
        dwell='average_duration', holiday='case when is_holiday = 1 then 0.08::double else 0 end')} analytical,
      greatest(0, least(capacity, {LINEAR})) linear from inputs)"""))
def _(spark, d):
    return rounded(forecast.scenarios(sample.zones(spark, d)))
