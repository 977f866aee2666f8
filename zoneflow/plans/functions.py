"""Queries over scalar functions and the Bloom filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from zoneflow.functions import bloom, scalar
from zoneflow.operators import commands
from zoneflow.plans.frames import rounded
from zoneflow.plans.registry import query, sql
from zoneflow.sources import sample


@query("f1_calendar", sql("""
    select event_id, hour("timestamp")::int "hour", (isodow("timestamp") - 1)::int day_of_week, (isodow("timestamp") >= 6)::int is_weekend,
           strftime("timestamp", '%Y-%m-%d') "day", ("timestamp"::date in (date '2024-01-01', date '2024-01-26'))::int is_holiday
    from ev"""))
def _(spark, d):
    return sample.events(spark, d).select(
        "event_id", F.hour("timestamp").alias("hour"), scalar.day_of_week("timestamp").alias("day_of_week"),
        scalar.is_weekend("timestamp").alias("is_weekend"), F.date_format("timestamp", "yyyy-MM-dd").alias("day"),
        scalar.is_holiday("timestamp", sample.HOLIDAYS).alias("is_holiday"),
    )


@query("f2_parse_timestamp", sql("""
    select event_id, case channel when 'error' then null when 'signup' then null
      when 'purchase' then "timestamp" - interval 330 minute else "timestamp" end parsed from elog"""))
def _(spark, d):
    """Naive text, UTC and +05:30 offsets, unreadable text and null."""
    plain = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    channel = F.col("channel")
    text = (
        F.when(channel == "click", plain).when(channel == "view", F.concat(iso, F.lit("+00:00")))
        .when(channel == "purchase", F.concat(iso, F.lit("+05:30"))).when(channel == "signup", "not-a-time")
    )
    return sample.event_log(spark, d).select("event_id", scalar.parse_timestamp(text).alias("parsed"))


@query("f3_floor_time", sql("""
    select event_id, date_trunc('hour', "timestamp") "hour_start", date_trunc('second', "timestamp") "second_start",
           date_trunc('week', "timestamp" + interval 1 day) - interval 1 day week_start from ev"""))
def _(spark, d):
    return sample.events(spark, d).select(
        "event_id", scalar.bucket("timestamp", "hourly").alias("hour_start"),
        scalar.bucket("timestamp", "second").alias("second_start"),
        scalar.bucket("timestamp", "weekly").alias("week_start"),
    )


@query("f4_local_text", sql("""
    select event_id, strftime("timestamp" + interval 330 minute, '%Y-%m-%d %H:%M:%S') local_time from ev"""))
def _(spark, d):
    return sample.events(spark, d).select("event_id", scalar.local_text("timestamp").alias("local_time"))


@query("f5_arithmetic", sql("""
    select session_id, greatest(10, least(60, dwell_min)) clipped, abs(dwell_min - 60) distance, round(sqrt(dwell_min), 9) root,
           round(power(dwell_min / 60.0::double, 2), 9) squared, round(exp(-dwell_min / 60.0::double), 9) decay from stays"""))
def _(spark, d):
    hours = F.col("dwell_min") / 60
    return rounded(sample.sessions(spark, d).select(
        "session_id", scalar.clip("dwell_min", 10, 60).alias("clipped"), F.abs(F.col("dwell_min") - 60).alias("distance"),
        F.sqrt("dwell_min").alias("root"), F.pow(hours, 2).alias("squared"), F.exp(-hours).alias("decay"),
    ))


@query("f6_haversine", sql("""
    select event_id, round(12742 * atan2(sqrt(h), sqrt(greatest(0, 1 - h))), 9) km from (
      select event_id, power(sin(radians(latitude - 19.076::double) / 2), 2) + cos(radians(19.076::double)) * cos(radians(latitude))
             * power(sin(radians(longitude - 72.8777::double) / 2), 2) h from ev)"""))
def _(spark, d):
    km = scalar.haversine_km(F.lit(19.076), F.lit(72.8777), "latitude", "longitude")
    return rounded(sample.events(spark, d).select("event_id", km.alias("km")))


@query("f7_sessions_needed", sql("""
    select zone_id, greatest(1, round_even(peak_utilization_target * capacity / (mean_duration_min / 60)
      / (4.0::double / 39.5::double) * 30, 0))::int sessions from zones"""))
def _(spark, d):
    need = scalar.sessions_needed("capacity", "peak_utilization_target", "mean_duration_min", 30)
    return sample.zones(spark, d).select("zone_id", need.alias("sessions"))


@query("f8_session_exit", sql("select session_id, entry_ts, entry_ts + to_minutes(dwell_min) exit_ts from stays"))
def _(spark, d):
    return sample.sessions(spark, d).select("session_id", "entry_ts", "exit_ts")


@query("f9_text", sql("""
    select session_id, upper(channel) up, lower(vehicle_id) low, trim('  ' || channel || ' ') trimmed, contains(channel, 'i') has_i,
           starts_with(vehicle_id, 'V000') early, lpad(k::varchar, 4, '0') padded, channel || '-' || vehicle_id joined,
           replace(channel, 'e', '3') swapped, substr(vehicle_id, 2, 3) part from stays"""))
def _(spark, d):
    return sample.sessions(spark, d).select(
        "session_id", F.upper("channel").alias("up"), F.lower("vehicle_id").alias("low"),
        F.trim(F.concat(F.lit("  "), "channel", F.lit(" "))).alias("trimmed"), F.contains("channel", F.lit("i")).alias("has_i"),
        F.startswith("vehicle_id", F.lit("V000")).alias("early"), F.lpad(F.col("k").cast("string"), 4, "0").alias("padded"),
        F.concat_ws("-", "channel", "vehicle_id").alias("joined"), F.regexp_replace("channel", "e", "3").alias("swapped"),
        F.substring("vehicle_id", 2, 3).alias("part"),
    )


@query("f10_to_number", sql("""
    select session_id, case when channel in ('view', 'click') then k::double else 0.9 end::double "number" from stays"""))
def _(spark, d):
    text = F.when(F.col("channel") == "error", "n/a").when(F.col("channel").isin("view", "click"), F.col("k").cast("string"))
    return sample.sessions(spark, d).select("session_id", scalar.to_number(text, 0.9).alias("number"))


@query("f11_json", sql("""
    select event_id, '{"event_id":"' || event_id || '","occupancy":' || occupancy || '}' encoded, occupancy decoded from ev"""))
def _(spark, d):
    text = F.to_json(F.struct("event_id", "occupancy"))
    return sample.events(spark, d).select(
        "event_id", text.alias("encoded"), F.from_json(text, "occupancy int")["occupancy"].alias("decoded")
    )


def _position_sql(item: str, i: int, m: int) -> str:
    rest = "0"
    for start in range(1, 65, 8):
        rest = f"({rest} * 4294967296 + ('0x' || substr(sha256({item} || ':{i}'), {start}, 8))::bigint) % {m}"
    return rest


@query("f12_sha_positions", sql(f"""
    select event_id, {", ".join(f"{_position_sql('event_id', i, 50_000)} h{i}" for i in range(3))} from ev"""))
def _(spark, d):
    spots = bloom.positions(F.col("event_id"), 50_000, 3)
    return sample.events(spark, d).select("event_id", *[spots[i].alias(f"h{i}") for i in range(3)])


_BLOOM_M, _BLOOM_K = 2_000_000, 6
_BITS_SQL = f"""
hashed as (
  select distinct unnest([{", ".join(_position_sql('event_id', i, _BLOOM_M) for i in range(_BLOOM_K))}]) p
  from ev where event_type = 'ENTRY')
"""


@query("a16_bloom_build", sql("""
    select (p // 64)::bigint word, bit_or((case when p % 64 = 63 then (-9223372036854775808)::bigint else (1::bigint << (p % 64)::int) end)) bits
    from hashed group by 1""", _BITS_SQL))
def _(spark, d):
    entries = sample.events(spark, d).where("event_type = 'ENTRY'")
    return bloom.bloom_build(entries, "event_id", _BLOOM_M, _BLOOM_K)


@query("a16_bloom_contains", sql(f"""
    select event_id, {" and ".join(f"{_position_sql('event_id', i, _BLOOM_M)} in (select p from hashed)" for i in range(_BLOOM_K))} maybe_seen
    from ev""", _BITS_SQL))
def _(spark, d):
    """Entries went into the filter; exits did not."""
    ev = sample.events(spark, d)
    built = bloom.bloom_build(ev.where("event_type = 'ENTRY'"), "event_id", _BLOOM_M, _BLOOM_K)
    return bloom.bloom_contains(ev.select("event_id"), "event_id", built, _BLOOM_M, _BLOOM_K)


# A filter small enough that it also takes new ids for copies.
_SMALL_M, _SMALL_K = 120_000, 5
_SETTERS_SQL = f"""
spots as (
  select arrival, event_id, unnest([{", ".join(_position_sql('event_id', i, _SMALL_M) for i in range(_SMALL_K))}]) p
  from arrivals),
judged as (
  select a.arrival, a.event_id, not bool_and(exists_before) accepted from (
    select s.arrival, s.event_id, s.arrival > min(s.arrival) over (partition by s.p) exists_before from spots s) a
  group by 1, 2)
"""


@query("a16_add_if_new", sql("select arrival, event_id, accepted from judged", _SETTERS_SQL))
def _(spark, d):
    """Which arrivals a filter of new ids adds, in the order of delivery: replays and false positives are refused."""
    arrived = sample.arrivals(spark, d).select("arrival", "event_id")
    return bloom.bloom_add_if_new(arrived, "event_id", "arrival", _SMALL_M, _SMALL_K)


@query("a16_items_added", sql("select count_if(accepted) items_added, count_if(not accepted) refused from judged", _SETTERS_SQL))
def _(spark, d):
    arrived = sample.arrivals(spark, d).select("arrival", "event_id")
    added = bloom.bloom_add_if_new(arrived, "event_id", "arrival", _SMALL_M, _SMALL_K)
    return added.agg(F.count_if("accepted").alias("items_added"), F.count_if(~F.col("accepted")).alias("refused"))


@query("a16_bloom_stats", sql("""
    select n accepted, floor(1048576 * (1 - exp(-7 * n / 1048576::double)))::bigint bits_set,
           round(floor(1048576 * (1 - exp(-7 * n / 1048576::double))) / 1048576 * 100, 2) saturation_pct,
           round(power(1 - exp(-7 * n / 1048576::double), 7) * 100, 6) false_positive_pct, 128 memory_kb
    from (select count(distinct event_id) n from arrivals)"""))
def _(spark, d):
    n = sample.arrivals(spark, d).agg(F.count_distinct("event_id").alias("accepted"))
    return n.select("accepted", *[c.alias(k) for k, c in bloom.bloom_stats(F.col("accepted"), 1 << 20, 7).items()])


@query("f13_fnv1a", sql("""
    select vehicle_id, h "hash", lpad((h % 24 + 1)::varchar, 2, '0') node from (
      select distinct vehicle_id, list_reduce(list_prepend(2166136261::bigint,
        list_transform(string_split(vehicle_id, ''), lambda c: unicode(c)::bigint)),
        lambda a, c: (xor(a, c) * 16777619) & 4294967295) h from stays)"""))
def _(spark, d):
    vehicles = sample.sessions(spark, d).select("vehicle_id").distinct()
    return vehicles.select("vehicle_id", scalar.fnv1a("vehicle_id").alias("hash"), scalar.sensor_node("vehicle_id").alias("node"))


@query("f14_turns_per_day", sql("""
    select vehicle_id, round(case when m > 0 then 1440 / m else 0 end, 9) turns from (
      select vehicle_id, avg(dwell_min) m from stays group by 1)"""))
def _(spark, d):
    means = sample.sessions(spark, d).groupBy("vehicle_id").agg(F.avg("dwell_min").alias("m"))
    return rounded(means.select("vehicle_id", scalar.turns_per_day("m").alias("turns")))


@query("f15_is_fresh", sql("""
    select event_id, case when channel = 'error' then false
      else epoch(timestamp '2024-01-30 00:00:00') - epoch("timestamp") < 86400 end fresh from elog"""))
def _(spark, d):
    seen = F.when(F.col("channel") != "error", F.col("timestamp"))
    now = F.lit("2024-01-30 00:00:00").cast("timestamp")
    return sample.event_log(spark, d).select("event_id", scalar.is_fresh(seen, now, 86_400).alias("fresh"))


@query("f16_model_key", sql("""
    select session_id, case channel when 'view' then 'random_forest' when 'click' then 'xgboost' when 'purchase' then 'linear'
      when 'signup' then 'random_forest' end model from stays"""))
def _(spark, d):
    channel = F.col("channel")
    asked = (
        F.when(channel == "view", " RF ").when(channel == "click", "XGBoost v1.8").when(channel == "purchase", "linear-regression")
        .when(channel == "error", "oracle")
    )
    return sample.sessions(spark, d).select("session_id", scalar.model_key(asked).alias("model"))


@query("f17_export_values", sql("""
    select event_id, case when channel = 'error' then null else temperature end temperature,
           strftime("timestamp", '%Y-%m-%dT%H:%M:%S') "timestamp" from elog"""))
def _(spark, d):
    reading = F.when(F.col("channel") == "error", float("nan")).otherwise(F.col("temperature"))
    return sample.event_log(spark, d).select(
        "event_id", scalar.null_if_nan(reading).alias("temperature"), scalar.iso_text("timestamp").alias("timestamp")
    )


@query("t8_apply_observations", sql("""
    select zone_id, (acc.ok)::bigint accepted, (n - acc.ok)::bigint rejected, (acc.o)::int occupancy from (
      select zone_id, count(*) n, list_reduce(
        list_prepend({'o': 0::bigint, 'ok': 0::bigint, 's': 0::bigint, 't': null::bigint, 'c': any_value(capacity)::bigint},
          list({'o': 0::bigint, 'ok': 0::bigint, 's': shift::bigint, 't': target::bigint, 'c': capacity::bigint}
               order by "timestamp", event_id)),
        lambda a, x: {'o': case when coalesce(x.t, a.o + x.s) between 0 and x.c then coalesce(x.t, a.o + x.s) else a.o end,
                      'ok': a.ok + case when coalesce(x.t, a.o + x.s) between 0 and x.c then 1 else 0 end,
                      's': 0::bigint, 't': null::bigint, 'c': x.c}) acc
      from cmds group by 1)""", """
    cmds as (
      select event_id, "timestamp", zone_id, capacity,
             case when channel = 'signup' then 0 when event_type = 'ENTRY' then greatest(1, k % 3) else -greatest(1, k % 3) end shift,
             case when channel = 'signup' then k % 7 end target
      from elog where channel <> 'error')"""))
def _(spark, d):
    """Every event as a command; `signup` ones set the count, `error` ones name no known action."""
    channel = F.col("channel")
    action = F.when(channel == "error", "MOVE").when(channel == "signup", "SET").otherwise(F.lower("event_type"))
    rows = sample.event_log(spark, d).select(
        F.col("event_id").alias("command_id"), F.lower("zone_id").alias("zone_id"), action.alias("action"),
        (F.col("k") % 3).alias("amount"), F.when(channel == "signup", F.col("k") % 7).cast("int").alias("occupancy"),
        F.col("timestamp").alias("observed_at"),
    )
    done = commands.apply_observations(rows, sample.zones(spark, d).select("zone_id", "capacity"))
    return commands.final_state(done).drop("observed_at")
