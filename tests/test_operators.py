"""Ties, nulls, edges and skew on small frames, against plain Python."""

import datetime as dt
import hashlib
import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow import sinks
from zoneflow.functions import bloom, scalar
from zoneflow.ml import forecast, models
from zoneflow.operators import aggregates, cleaning, commands, grid, history, occupancy, ordered, paging, quality, routing, search, sketches
from zoneflow.schema import COMMAND, ZONE
from zoneflow.session import build_spark, release, shared_dir, write_table
from zoneflow.sources import files, poi

T0 = dt.datetime(2024, 1, 1)


def minute(m):
    return T0 + dt.timedelta(minutes=m)


@pytest.fixture()
def many_chunks(spark):
    """Small advisory sizes, so that small frames still split into several chunks."""
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


# Ordered operators ---------------------------------------------------------------------

def test_running_sum_splits_a_hot_key(spark, many_chunks):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.8 else f"k{rng.randrange(5)}", rng.randrange(50), i, rng.choice([-1, 1])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t int, id int, v int")
    chunks = ordered.range_chunks(df, ["k", "t", "id"])
    assert chunks.where("k = 'hot'").select(ordered.CHUNK).distinct().count() > 2
    got = {r["id"]: r["s"] for r in ordered.running_sum(df, ["k"], ["t", "id"], "v", "s").collect()}
    want, totals = {}, {}
    for k, t, i, v in sorted(rows):
        totals[k] = totals.get(k, 0) + v
        want[i] = totals[k]
    assert got == want


@pytest.mark.parametrize("hot_rows", [10, 300, 10_000])
def test_running_sum_in_time_cuts_hot_hours(spark, many_chunks, hot_rows):
    rng = random.Random(9)
    rows = [(rng.choice(["hot", "hot", "cold", None]), minute(30 if rng.random() < 0.5 else rng.randrange(600)), i, rng.choice([-1, 1, 2]))
            for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, t timestamp, id int, v int")
    out = ordered.running_sum_in_time(df, ["k"], ["t", "id"], "v", "s", hot_rows=hot_rows)
    assert out.columns == ["k", "t", "id", "v", "s"]
    want, totals = {}, {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        totals[k] = totals.get(k, 0) + v
        want[i] = totals[k]
    assert {r["id"]: r["s"] for r in out.collect()} == want


def test_dense_index_is_gapless_over_chunks(spark, many_chunks):
    values = random.Random(2).sample(range(10_000), 500)
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = {r["v"]: r["row_index"] for r in ordered.dense_index(df, ["v"]).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_exact_quantiles(spark, many_chunks, n):
    rng = random.Random(n)
    values = [float(rng.randrange(20)) for _ in range(n)]
    df = spark.createDataFrame([("a", v) for v in values] + [("a", None), ("b", 3.0)], "g string, v double")
    got = {r["g"]: r for r in ordered.exact_quantiles(df, ["g"], "v", {"med": 0.5, "p90": 0.9}).collect()}
    assert got["a"]["med"] == pytest.approx(statistics.median(values))
    pos = 0.9 * (n - 1)
    s = sorted(values)
    want = s[math.floor(pos)] + (s[math.ceil(pos)] - s[math.floor(pos)]) * (pos - math.floor(pos))
    assert got["a"]["p90"] == pytest.approx(want)
    assert (got["b"]["med"], got["b"]["p90"]) == (3.0, 3.0)
    ranked = ordered.ranked_values(df.where("g = 'a'"), ["g"], "v")
    assert ranked.groupBy("g").agg(ordered.upper_median("v").alias("m")).first()["m"] == s[n // 2]


def test_running_occupancy_clips_after_the_sum(spark):
    rows = [("Z1", minute(m), kind, f"E{i}", 2) for i, (m, kind) in enumerate(
        [(0, "ENTRY"), (1, "ENTRY"), (2, "ENTRY"), (3, "EXIT"), (4, "EXIT"), (5, "EXIT"), (6, "EXIT"), (7, "ENTRY"), (7, "EXIT")])]
    ev = spark.createDataFrame(rows, "zone_id string, timestamp timestamp, event_type string, event_id string, capacity int")
    got = [r["occupancy"] for r in occupancy.running_occupancy(ev).orderBy("timestamp", "event_type").collect()]
    # Sum is 1 2 3 2 1 0 -1 0 -1; the clip does not feed back.
    assert got == [1, 2, 2, 2, 1, 0, 0, 0, 0]


def test_event_ids_grow_past_eight_digits(spark):
    df = spark.createDataFrame([(3,), (1,)], "v int")
    assert [r["event_id"] for r in occupancy.assign_event_ids(df, ["v"]).orderBy("v").collect()] == ["E00000001", "E00000002"]


# Cleaning ------------------------------------------------------------------------------

@pytest.mark.parametrize("closed,expected", [
    ("left", ["LOW", "LOW", "MEDIUM", "MEDIUM", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "HIGH", "HIGH", None]),
    ("right", ["LOW", "LOW", "LOW", "MEDIUM", "MEDIUM", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "HIGH", None]),
])
def test_risk_thresholds(spark, closed, expected):
    pct = [0.0, 59.9, 60.0, 69.9, 70.0, 84.9, 85.0, 89.9, 90.0, 100.0, None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pct)], "i int, p double")
    rows = df.withColumn("r", scalar.risk_level(F.col("p"), closed=closed)).orderBy("i").collect()
    assert [r["r"] for r in rows] == expected
    with pytest.raises(ValueError):
        scalar.risk_level(F.col("p"), closed="both")


def test_first_copy_and_duplicate_marks(spark):
    rows = [("a", minute(2), 3), ("a", minute(1), 2), ("a", minute(1), 1), ("b", minute(0), 4)]
    df = spark.createDataFrame(rows, "event_id string, timestamp timestamp, arrival int")
    assert {r["arrival"] for r in cleaning.first_copy(df, "event_id", ["timestamp", "arrival"]).collect()} == {1, 4}
    marks = {r["arrival"]: r["status"] for r in cleaning.mark_duplicates(df, ["timestamp", "arrival"]).collect()}
    assert marks == {1: "VERIFIED", 2: "DROP", 3: "DROP", 4: "VERIFIED"}


def test_union_prefers_the_left_input(spark):
    left = spark.createDataFrame([("a", minute(0), "MANUAL")], "event_id string, timestamp timestamp, source_type string")
    right = spark.createDataFrame([("a", minute(5)), ("b", minute(1))], "event_id string, timestamp timestamp")
    got = {r["event_id"]: (r["timestamp"], r["source_type"]) for r in cleaning.union_events(left, right).collect()}
    assert got == {"a": (minute(0), "MANUAL"), "b": (minute(1), None)}
    newest = paging.recent_events(right, left, 1).collect()
    assert [r["event_id"] for r in newest] == ["b"]


def test_search_regex_literal_and_nulls(spark):
    df = spark.createDataFrame([("Axb", 1), ("a.b", 2), (None, 3)], "s string, n int")
    assert {r["n"] for r in cleaning.search_rows(df, "A.B").collect()} == {1, 2}
    assert {r["n"] for r in cleaning.search_rows(df, "A.B", regex=False).collect()} == {2}
    assert {r["n"] for r in cleaning.search_rows(df, "^3$").collect()} == {3}


def test_zone_filter_and_days(spark):
    df = spark.createDataFrame([("Z1",), ("z2",)], "zone_id string")
    assert cleaning.filter_zones(df, ["ALL"]).count() == cleaning.filter_zones(df, []).count() == 2
    assert cleaning.filter_zones(df, ["Z2"]).count() == 0
    assert cleaning.filter_zones(df, ["Z2"], ignore_case=True).count() == 1
    assert [cleaning.clamp_days(d) for d in (0, 7, 999)] == [1, 7, 120]


def test_range_report_covers_and_truncates(spark):
    ev = spark.createDataFrame([(T0,), (T0 + dt.timedelta(days=10),)], "timestamp timestamp")
    short, long = cleaning.range_report(ev, 7).first(), cleaning.range_report(ev, 30).first()
    assert (short["coverage_days"], short["truncated"], long["coverage_days"], long["truncated"]) == (0.0, False, 10.0, True)
    assert cleaning.last_days(ev, 7).count() <= cleaning.last_days(ev, 30).count()


def test_constraints_follow_sql_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, -1), (None, 2)], "zone_id string, capacity int")
    got = {r["constraint"]: r["violations"] for r in quality.check_constraints(df, quality.ZONE_TABLE).collect()}
    assert got == {"not_null(zone_id)": 2, "not_null(capacity)": 1, "check(capacity_positive)": 1, "unique(zone_id)": 1}


def test_quality_scores_report_missing_fields(spark):
    df = spark.createDataFrame([("a", T0, 3, 2), ("a", None, 1, 2)], "event_id string, timestamp timestamp, occupancy int, capacity int")
    row = quality.quality_scores(df).first()
    assert (row["timestamp_completeness"], row["record_uniqueness"], row["range_validity"]) == (50.0, 50.0, 50.0)
    assert row["schema_compliance"] == round(4 / 7 * 100, 2)


def test_schema_ddl_catalog(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 1.5, True, T0), (None, 2, 2.5, False, T0)], "s string, n int, d double, b boolean, t timestamp")
    assert quality.ddl_for(df, "demo").first()["ddl"] == (
        'CREATE TABLE demo (\n    "s" VARCHAR,\n    "n" BIGINT NOT NULL,\n    "d" DOUBLE PRECISION NOT NULL,\n'
        '    "b" BOOLEAN NOT NULL,\n    "t" TIMESTAMP NOT NULL\n);\n')
    df.coalesce(1).write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    row = quality.catalog({"demo": stored}, with_bytes=True).first()
    assert (row["rows"], row["columns"]) == (2, 5) and row["bytes"] > 0
    assert quality.newest_files(stored).count() == 1


# Aggregates and history ----------------------------------------------------------------

def test_peak_hour_tie_takes_the_earlier(spark):
    rows = [("Z1", T0.replace(hour=h), 4) for h in (9, 7)]
    ev = spark.createDataFrame(rows, "zone_id string, timestamp timestamp, occupancy int")
    assert aggregates.peak_hour_per_zone(ev).first()["hour"] == 7


def test_sunday_weeks(spark):
    days = [dt.datetime(2024, 1, 6, 23, 59, 59), dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 13, 23, 59, 59)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp").withColumn("w", scalar.sunday_week("t"))
    assert [r["w"].day for r in df.orderBy("t").collect()] == [31, 7, 7]


def test_mixed_timestamps_become_utc(spark):
    texts = ["2026-01-01 10:00:00", "2026-01-01T10:01:00+00:00", "2026-01-01T15:32:00+05:30", "not-a-time", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = [r["t"] for r in df.select("i", scalar.parse_timestamp("s").alias("t")).orderBy("i").collect()]
    assert got == [dt.datetime(2026, 1, 1, 10, m) for m in (0, 1, 2)] + [None, None]


def test_downsample_keeps_the_last_point(spark):
    df = spark.createDataFrame([("Z1", i, float(i)) for i in range(10)], "zone_id string, bucket int, value double")
    assert [r["bucket"] for r in history.downsample(df, 4).orderBy("bucket").collect()] == [0, 3, 6, 9]
    assert [r["bucket"] for r in history.downsample(df, 5).orderBy("bucket").collect()] == [0, 2, 4, 6, 8, 9]


def test_live_flow_of_nothing_and_of_one_second(spark):
    schema = "event_id string, timestamp timestamp, event_type string, parking_duration int, temperature double, rainfall double"
    rows = [(f"E{i}", T0, "ENTRY", 0, 20.0, 0.0) for i in range(3)] + [("E9", minute(-5), "EXIT", 30, 19.0, 1.0)]
    row = aggregates.live_flow(spark.createDataFrame(rows, schema)).first()
    assert (row["entries"], row["exits"], row["peak_events_per_second"], row["events_per_second"]) == (3, 0, 3, 2.0)
    assert (row["median_dwell"], row["temperature"]) == (0.0, 20.0)
    empty = aggregates.live_flow(spark.createDataFrame([], schema)).first()
    assert (empty["entries"], empty["peak_events_per_second"], empty["median_dwell"]) == (0, 0, 0.0)


def test_offset_lines(spark):
    df = spark.createDataFrame([("topic:0:7513",), ("a:b:1:2",), ("bad",), ("topic:x:1",)], "value string")
    got = {(r["topic"], r["partition"], r["offset"], r["lag"]) for r in aggregates.offset_digest(df).collect()}
    assert got == {("topic", 0, 7513, 0), ("a:b", 1, 2, 0)}


def test_metrics_use_validation_rows_when_there_are_any(spark):
    rows = [("Z1", 1.0, 2.0, 1), ("Z1", 3.0, 3.0, 1), ("Z1", 9.0, 0.0, 0), ("Z2", 4.0, 4.0, 0)]
    df = spark.createDataFrame(rows, "zone_id string, actual_occupancy double, p double, is_validation int")
    row = aggregates.regression_metrics(df, ["p"]).first()
    assert (row["samples"], row["mae"], row["rmse"], row["r2"]) == (2, 0.5, pytest.approx(0.5 ** 0.5), 0.5)
    by_zone = {r["zone_id"]: r for r in aggregates.regression_metrics(df, ["p"], by_zone=True).collect()}
    assert by_zone["Z2"]["samples"] == 1 and by_zone["Z2"]["r2"] == 1.0


# Grid ----------------------------------------------------------------------------------

def test_asof_ties_gaps_and_silent_zones(spark):
    ev = spark.createDataFrame(
        [("Z1", minute(40), "ENTRY", "E2", 5), ("Z1", minute(40), "ENTRY", "E1", 4), ("Z1", minute(60), "EXIT", "E3", 1)],
        "zone_id string, timestamp timestamp, event_type string, event_id string, occupancy int")
    zones = spark.createDataFrame([("Z1", 9), ("Z2", 9)], "zone_id string, capacity int")
    start, end = F.lit(T0), F.lit(minute(120))
    out = grid.resample_asof(ev, grid.time_grid(zones, start, end), start)
    got = {z: [r["current_occupancy"] for r in out.where(F.col("zone_id") == z).orderBy("timestamp").collect()] for z in ("Z1", "Z2")}
    assert got == {"Z1": [0.0, 0.0, 1.0, 1.0, 1.0], "Z2": [0.0] * 5}
    shifted = grid.resample_asof(ev, grid.time_grid(zones, F.lit(minute(45)), F.lit(minute(75))), F.lit(minute(45)))
    assert [r["current_occupancy"] for r in shifted.where("zone_id = 'Z1'").orderBy("timestamp").collect()] == [5.0, 1.0]
    ahead = grid.future_target(out).where("zone_id = 'Z1'").orderBy("timestamp").collect()
    assert [r["future_occupancy"] for r in ahead] == [0.0, 1.0, 1.0, 1.0]


# Routing -------------------------------------------------------------------------------

def _arc_km(a, b):
    """Arc over the chord between two unit vectors."""
    def unit(place):
        lat, lon = map(math.radians, place)
        return math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)

    return 2 * 6371 * math.asin(min(1.0, math.dist(unit(a), unit(b)) / 2))


@pytest.mark.parametrize("spread,bays,n", [(0.05, 150, 120), (5.0, 150, 150), (60.0, 3, 150), (0.0, 20, 40), (1.0, 0, 10), (20.0, 900, 4)])
def test_reroute_candidates_match_all_pairs(spark, spread, bays, n):
    rng = random.Random(n + bays)
    rows = []
    for i in range(n):
        free, load = rng.randint(0, bays), round(rng.uniform(0, 100), 1)
        lon = 179.9 + rng.uniform(-spread, spread)
        rows.append((f"Z{i:03d}", f"N{i}", rng.uniform(-spread, spread), (lon + 180) % 360 - 180, 200, 0, free, load))
    state = spark.createDataFrame(rows, "zone_id string, zone_name string, latitude double, longitude double, "
                                        "capacity int, occupancy int, available int, utilization double")
    got = {}
    for r in routing.reroute_candidates(state).collect():
        got.setdefault(r["source_zone"], {})[r["rank"]] = (r["target_zone"], r["recommendation_score"])
    for s in rows:
        scored = []
        for c in rows:
            if c[0] != s[0] and c[6] > 0:
                scored.append((-(c[6] - c[7] * 0.2 - _arc_km(s[2:4], c[2:4]) * 2.5), c[0]))
        scored.sort()
        mine = got.get(s[0], {})
        assert len(mine) == min(5, len(scored))
        for rank, (value, zone) in enumerate(scored[:5], 1):
            assert mine[rank][1] == pytest.approx(-value, abs=0.006)


def test_reroute_plan_has_no_pairing_of_all_zones(spark, sf_dir):
    from zoneflow.plans import frames
    plan = routing.reroute_candidates(frames.state(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("n", [1, 40, 700, 5000])
def test_newest_events_need_the_end_of_the_log_alone(spark, n):
    """The same rows in the same order with and without the look-up by time: copies at other times, nulls, one busy second."""
    rng = random.Random(n)
    log = [(f"E{rng.randrange(900):04d}" if i % 50 else None, None if i % 97 == 0 else minute(min(4000, i) // 3 if i < 1200 else 400), i % 9) for i in range(1500)]
    mine = [(f"E{rng.randrange(900):04d}", minute(rng.randrange(600)), 100 + i) for i in range(60)]
    stored, manual = (spark.createDataFrame(r, "event_id string, timestamp timestamp, occupancy int") for r in (log, mine))

    def key(df):
        return [(r["event_id"], r["timestamp"]) for r in df.collect()]

    assert key(paging.recent_events(stored, manual, n, index_from=0)) == key(paging.recent_events(stored, manual, n, index_from=10**9))
    empty = stored.where("false")
    assert paging.recent_events(empty, empty, n, index_from=0).count() == 0


def test_the_end_of_the_log_is_as_short_as_it_can_be(spark):
    times = spark.range(100_000).select(F.timestamp_seconds(1_704_067_200 + F.col("id") * 7).alias("timestamp"))
    for wanted in (1, 500, 99_999):
        start = paging.newest_since(times, "timestamp", wanted)
        assert times.where(F.col("timestamp") >= F.lit(start)).count() == wanted
    assert paging.newest_since(times, "timestamp", 100_001) is None


def test_sketches_merge_within_their_errors(spark):
    """Days joined to weeks and zones to a whole keep to the stated errors; nulls and groups without values have defined answers."""
    n = 60_000
    ev = spark.range(n).select(
        (F.col("id") % 3).cast("string").alias("zone_id"), F.timestamp_seconds(1_704_067_200 + F.col("id") * 20).alias("timestamp"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(9000)).cast("string")).alias("vehicle_id"),
        F.when(F.col("id") % 3 < 2, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000))).cast("int").alias("occupancy"))
    days = sketches.day_sketches(ev).cache()
    assert days.count() == 3 * ev.select(F.to_date("timestamp")).distinct().count()
    probs = {"q10": 0.1, "q50": 0.5, "q99": 0.99}
    for by in (["zone_id"], []):
        got = sketches.read_sketches(sketches.merge_sketches(days, *by), probs).collect()
        exact = ev.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct("vehicle_id").alias("d"), F.sort_array(F.collect_list("occupancy")).alias("v")).collect()
        want = {r["zone_id"] if by else None: r for r in exact}
        for r in got:
            e = want[r["zone_id"] if by else None]
            assert r["events"] == e["n"] and abs(r["distinct_ids"] - e["d"]) <= sketches.DISTINCT_ERROR * e["d"]
            for name, p in probs.items():
                if not e["v"]:
                    assert r[name] is None
                    continue
                below, upto = (sum(test(x) for x in e["v"]) / len(e["v"]) for test in (lambda x: x < r[name], lambda x: x <= r[name]))
                assert below <= p + sketches.RANK_ERROR and upto >= p - sketches.RANK_ERROR
    # Merging in two steps says the same of distinct ids.
    twice = sketches.merge_sketches(sketches.merge_sketches(days, "zone_id"))
    once = sketches.merge_sketches(days)
    assert sketches.read_sketches(twice, {}).first()["distinct_ids"] == sketches.read_sketches(once, {}).first()["distinct_ids"]


def test_indexed_search_finds_what_a_search_of_all_rows_finds(spark):
    """Literals and patterns with and without trigrams, over nulls, repeated keys, short texts and letters of any case."""
    rng = random.Random(3)
    words = ["Gate", "gate-12", "north", "NORTH lot", "a.b", "x+y", "ab", "Z001", "zone [3]", "Über Park", "12.50", "aaa", "caab"]
    data = [(i % 250, " ".join(rng.choices(words, k=rng.randrange(0, 4))) if i % 17 else None, rng.choice(words), rng.randrange(1000)) for i in range(300)] + [(None, "north", "gate", 1)]
    df = spark.createDataFrame(data, "k int, one string, two string, n int").cache()
    index = search.search_index(df, "k").cache()
    patterns = ["gate", "GATE-1", "north lot", "nor.h", "a.b", "aa+b", "ca*b", "(gate)+-12", "gate|lot", "z0{2}1", r"12\.50", r"zone \[3\]", r"\d{3}", "[gG]ate-1", "^north$", "über", "x", "", "nothing here",
                "ab?c", "(north )?lot", r"\bpark", "gate.*12", "[^a]ate", "no(rt)h"]
    for pattern in patterns:
        for regex in (True, False):
            want = sorted(map(str, cleaning.search_rows(df, pattern, regex).collect()))
            assert sorted(map(str, search.search_indexed(df, index, "k", pattern, regex).collect())) == want, (pattern, regex)


@pytest.mark.parametrize(("pattern", "texts"), [
    ("gate-12", ["gate-12"]), ("ab+cd", ["ab", "cd"]), ("ab?cd", ["a", "cd"]), ("(abc)?def", ["def"]), ("abc|def", []), (r"a\.bc", ["a.bc"]),
    (r"abc\dxyz", ["abc"]), ("a{2}bcd", ["bcd"]), ("^abc.def$", ["abc", "def"]), ("x[abc]yz", ["x", "yz"]), ("(?i)abc", []), ("ab{", [])])
def test_demanded_texts(pattern, texts):
    assert search.demanded(pattern) == texts


# Commands ------------------------------------------------------------------------------

def test_command_fold_matches_sequential_over_chunks(spark, many_chunks):
    rng = random.Random(5)
    zones = spark.createDataFrame([("Z1", 6, 3), ("Z2", 40, 50), ("Z3", 0, 0)], "zone_id string, capacity int, occupancy int")
    rows = []
    for i in range(1500):
        action = rng.choice(["ENTRY", "exit", "SET", "ENTRY", "EXIT", "JUMP", None])
        rows.append((f"C{i:05d}", rng.choice(["Z1"] * 6 + ["z2", "Z3", "Z9"]), action, rng.choice([None, 0, 1, 2, 500]),
                     rng.choice([None, 2, 9]) if action in ("SET", None) else None, None, None, None, minute(i // 3)))
    out = commands.apply_observations(spark.createDataFrame(rows, COMMAND), zones)
    got = {r["command_id"]: (r["status"], r["occupancy"]) for r in out.collect()}
    current, want = {"Z1": 3, "Z2": 40}, {}
    caps = {"Z1": 6, "Z2": 40, "Z3": 0}
    for cid, zone, action, amount, target, *_rest in sorted(rows, key=lambda r: (r[8], r[0])):
        zone, action = zone.upper(), (action or "SET").upper()
        if caps.get(zone, 0) <= 0:
            want[cid] = ("UNKNOWN_ZONE", None)
        elif action not in ("ENTRY", "EXIT", "SET"):
            want[cid] = ("UNKNOWN_ACTION", None)
        else:
            n = max(1, min(100, amount or 1))
            new = {"ENTRY": current[zone] + n, "EXIT": current[zone] - n, "SET": current[zone] if target is None else target}[action]
            ok = 0 <= new <= caps[zone]
            current[zone] = new if ok else current[zone]
            want[cid] = ("ACCEPTED" if ok else "OUT_OF_RANGE", current[zone])
    assert got == want


def folded(shift, target, capacity, start):
    """States and acceptance of commands, one after the other."""
    state, states, accepted = start, [], []
    for s, t in zip(shift, target, strict=True):
        wanted = state + int(s) if math.isnan(t) else int(t)
        ok = 0 <= wanted <= capacity
        state = wanted if ok else state
        states.append(state)
        accepted.append(ok)
    return states, accepted


@pytest.mark.parametrize("sets", [0.0, 0.01, 0.3])
@pytest.mark.parametrize("capacity", [0, 1, 5, 400, 30_000])
def test_lanes_equal_a_fold(capacity, sets):
    """Zones of any length side by side, from any start, with targets out of bounds, in lanes of one command and more."""
    rng = np.random.default_rng(capacity + int(100 * sets))
    for length in (None, 1, 7, 10_000):
        sizes = [1, 2, 300, 50, 1]
        zone = np.repeat(np.arange(len(sizes)), sizes)
        shift = rng.integers(1, 101, len(zone)) * rng.choice([-1, 1], len(zone)) if capacity > 5 else rng.integers(-3, 4, len(zone))
        target = np.where(rng.random(len(zone)) < sets, rng.integers(-2, capacity + 3, len(zone)), np.nan)
        lanes = commands.Lanes(zone, shift, target, np.full(len(zone), capacity), length)
        begin = rng.integers(0, capacity + 1, len(sizes))
        occupancy, accepted = lanes.replay(begin[lanes.zone])
        for z, start in enumerate(begin):
            own = zone == z
            assert (occupancy[own].tolist(), accepted[own].tolist()) == folded(shift[own], target[own], capacity, int(start))


@pytest.mark.parametrize("capacity", [0, 3, 500])
def test_tables_equal_a_fold(monkeypatch, capacity):
    rng = np.random.default_rng(capacity)
    shift = rng.integers(-5, 6, 200)
    target = np.where(rng.random(200) < 0.01, rng.integers(-2, capacity + 3, 200), np.nan)
    want = [folded(shift, target, capacity, s)[0][-1] for s in range(capacity + 1)]
    for cells in (1, 1 << 22):
        monkeypatch.setattr(commands, "TABLE_CELLS", cells)
        assert commands.tabulate(shift, target, capacity).tolist() == want


# Bloom ---------------------------------------------------------------------------------

def test_bloom_positions_and_no_false_negatives(spark, monkeypatch):
    members, strangers = {f"gate-{i * 37}" for i in range(1500)}, {f"door-{i}" for i in range(2000)}
    df = spark.createDataFrame([(i,) for i in sorted(members)], "event_id string")
    m, k = 40_009, 5
    row = df.where("event_id = 'gate-74'").select(bloom.positions(F.col("event_id"), m, k).alias("p")).first()
    assert row["p"] == [int.from_bytes(hashlib.sha256(b"gate-74:%d" % i).digest()) % m for i in range(k)]
    built = bloom.bloom_build(df, "event_id", m, k)
    both = df.union(spark.createDataFrame([(i,) for i in sorted(strangers)], "event_id string"))

    def passed():
        return {r["event_id"] for r in bloom.bloom_contains(both, "event_id", built, m, k).where("maybe_seen").collect()}

    looked_up = passed()
    assert looked_up >= members and len(looked_up & strangers) < 20
    monkeypatch.setattr(bloom, "MAX_LOOKUP_BITS", 0)
    assert passed() == looked_up
    with pytest.raises(ValueError):
        bloom.positions(F.col("event_id"), 1 << 31, 2)


@pytest.mark.parametrize("m", [64, 1_000_003, (1 << 31) - 1])
def test_bloom_position_widths(spark, m):
    df = spark.createDataFrame([("abc",)], "s string")
    got = df.select(bloom.positions(F.col("s"), m, 2).alias("p")).first()["p"]
    assert got == [int(hashlib.sha256(f"abc:{i}".encode()).hexdigest(), 16) % m for i in range(2)]


def test_bloom_rate_bound(spark):
    stats = bloom.bloom_stats(F.lit(1000), 1_000_000, 5)
    assert spark.range(1).select(stats["false_positive_pct"].alias("p")).first()["p"] < 0.1


def test_bloom_flag_of_a_null_id_is_null_either_way(spark, monkeypatch):
    df = spark.createDataFrame([("a",), (None,)], "event_id string")
    built = bloom.bloom_build(df.na.drop(), "event_id", 4096, 3)
    for bits in (1 << 26, 0):
        monkeypatch.setattr(bloom, "MAX_LOOKUP_BITS", bits)
        got = {r["event_id"]: r["maybe_seen"] for r in bloom.bloom_contains(df, "event_id", built, 4096, 3).collect()}
        assert got == {"a": True, None: None}


def added_in_turn(ids, m, k, bits=None):
    """Flags of a filter that is asked and filled one id after the other, and its bits after them."""
    bits, flags = set(bits or ()), []
    for i in ids:
        spots = {int.from_bytes(hashlib.sha256(f"{i}:{turn}".encode()).digest()) % m for turn in range(k)}
        flags.append(not spots <= bits)
        bits |= spots
    return flags, bits


@pytest.mark.parametrize(("m", "k"), [(1_000_003, 5), (900, 3), (40, 2)])
def test_add_if_new_equals_a_filter_filled_in_turn(spark, m, k):
    """Empty to full filters; repeated ids, false positives, and arrivals that a stored filter has seen parts of."""
    ids = [f"gate-{(i * 7919) % 260}" for i in range(700)]
    half = 300
    rows = spark.createDataFrame([(n, i) for n, i in enumerate(ids)], "arrival long, event_id string").repartition(5, "event_id")
    first, bits = added_in_turn(ids[:half], m, k)
    later, all_bits = added_in_turn(ids[half:], m, k, bits)

    def flags(df):
        return [r["accepted"] for r in df.orderBy("arrival").collect()]

    assert flags(bloom.bloom_add_if_new(rows, "event_id", "arrival", m, k)) == first + later
    one = bloom.bloom_add_if_new(rows.where(f"arrival < {half}"), "event_id", "arrival", m, k)
    held = bloom.bloom_build(one.where("accepted"), "event_id", m, k)
    two = bloom.bloom_add_if_new(rows.where(f"arrival >= {half}"), "event_id", "arrival", m, k, held)
    assert flags(two) == later
    merged = bloom.merge_blooms(held, bloom.bloom_build(two.where("accepted"), "event_id", m, k))
    assert {64 * r["word"] + b for r in merged.collect() for b in range(64) if r["bits"] >> b & 1} == all_bits


def test_add_if_new_of_nulls_and_no_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, "a"), (3, "a")], "arrival long, event_id string")
    got = Counter((r["arrival"], r["event_id"], r["accepted"]) for r in bloom.bloom_add_if_new(rows, "event_id", "arrival", 4096, 3).collect())
    assert got == Counter([(1, "a", True), (2, None, None), (None, "a", None), (3, "a", False)])
    assert bloom.bloom_add_if_new(rows.where("false"), "event_id", "arrival", 64, 2).count() == 0
    assert bloom.bloom_build(rows.where("event_id IS NULL"), "event_id", 64, 2).count() == 0


# Scalars, sources, sinks, models -------------------------------------------------------

def test_fnv_handles_wide_characters(spark):
    def plain(text, salt=0):
        h = 2166136261 ^ salt
        for c in text:
            unit = ord(c) if ord(c) < 0x10000 else 0xD800 + ((ord(c) - 0x10000) >> 10)
            h = ((h ^ unit) * 16777619) & 0xFFFFFFFF
        return h
    texts = ["", "Z001", "é€", "a😀b"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for salt in (0, 3):
        got = {r["s"]: r["h"] for r in df.select("s", scalar.fnv1a("s", salt).alias("h")).collect()}
        assert got == {t: plain(t, salt) for t in texts}


def test_poi_document(spark):
    doc = """{"elements": [
      {"type": "node", "id": 1, "lat": 19.123456789, "lon": 72.8, "tags": {"name": "A", "capacity": "1,200", "fee": "yes"}},
      {"type": "way", "id": 2, "center": {"lat": 19.5, "lon": 72.9}, "tags": {"operator": "Op", "capacity": "many"}},
      {"type": "node", "id": 3, "tags": {"name": "nowhere"}}, {"id": 4, "lat": 1.0, "lon": 2.0}]}"""
    rows = poi.flatten_poi(spark.createDataFrame([(doc,)], "value string")).orderBy("poi_id").collect()
    assert [(r["poi_id"], r["name"], r["capacity"], r["fee"], r["access"]) for r in rows] == [
        ("node/1", "A", 1200, "yes", "unknown"), ("node/4", poi.UNNAMED, None, "unknown", "unknown"),
        ("way/2", "Op", None, "unknown", "unknown")]
    assert rows[0]["latitude"] == 19.1234568 and rows[2]["longitude"] == 72.9


def test_exports_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("Z1", "One", 3, 19.0, 72.5), ("Z2", "Two", 4, 19.1, 72.6)],
                               "zone_id string, zone_name string, capacity int, latitude double, longitude double")
    for fmt in ("csv", "json", "parquet", "geojson"):
        sinks.export(df, fmt, str(tmp_path / fmt), zone="z2")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()["zone_name"] == "Two"
    assert spark.read.json(str(tmp_path / "json")).count() == 1
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 1
    assert '"coordinates":[72.6,19.1]' in spark.read.text(str(tmp_path / "geojson")).first()["value"]
    with pytest.raises(ValueError):
        sinks.export(df, "xml", str(tmp_path / "x"))
    sinks.write_csv(df, str(tmp_path / "report"), single_file=True)
    assert len(list((tmp_path / "report").glob("*.csv"))) == 1
    zones = files.read_csv(spark, str(tmp_path / "report"), T.StructType([f for f in ZONE if f.name in df.columns]))
    assert zones.count() == 2
    sinks.write_parquet(df, str(tmp_path / "by_zone"), ("zone_id",))
    assert (tmp_path / "by_zone" / "zone_id=Z1").exists()
    sinks.write_predictions(df, str(tmp_path / "pred"))
    assert spark.read.parquet(str(tmp_path / "pred")).count() == 2


def test_deep_page_equals_top_k_page(spark, many_chunks):
    df = spark.createDataFrame([(i, i % 7) for i in range(300)], "id int, g int")
    for order in (["g", "id"], ["-g", "-id"]):
        near = paging.page(df, 5, 20, order).collect()
        assert sorted(near) == sorted(paging.deep_page(df, 80, 20, order).collect())
    assert paging.page(df, 99, 50, ["id"]).count() == 50
    assert paging.page(df, 99, 50, ["id"], clamp=False).count() == 0
    mixed = [tuple(r) for r in paging.deep_page(df, 40, 10, ["g", "-id"]).collect()]
    assert mixed == sorted(((i, i % 7) for i in range(300)), key=lambda r: (r[1], -r[0]))[40:50]
    assert [tuple(r) for r in paging.page(df, 5, 10, ["g", "-id"]).collect()] == mixed
    assert [r["id"] for r in paging.last_points(df, 3, ["id"]).collect()] == [297, 298, 299]


def test_ids_of_long_numbers_stay_whole(spark):
    from zoneflow.operators.occupancy import sessions_to_events
    df = spark.createDataFrame([(5_000_000_000, T0, minute(1), 1), (5_000_000_001, T0, minute(1), 1), (7, T0, minute(1), 1)],
                               "session_id long, entry_ts timestamp, exit_ts timestamp, dwell_min int")
    got = {r["event_id"] for r in sessions_to_events(df).collect()}
    assert got == {"E10000000000", "E10000000001", "E10000000002", "E10000000003", "E000000014", "E000000015"}


def test_state_precedence(spark):
    zones = spark.createDataFrame([(f"Z{i}", f"N{i}", 10) for i in range(1, 6)], "zone_id string, zone_name string, capacity int")
    snap = spark.createDataFrame([(f"Z{i}", 10 if i != 4 else 11, 2.0) for i in range(1, 6)], "zone_id string, capacity int, occupancy double")
    live = spark.createDataFrame([("Z1", 10, 5, minute(0)), ("Z2", 10, 5, minute(0)), ("Z3", 99, 5, minute(0))],
                                 "zone_id string, capacity int, occupancy int, timestamp timestamp")
    manual = spark.createDataFrame([("Z1", 10, 60, minute(1), "GATE", 0.8)],
                                   "zone_id string, capacity int, occupancy int, timestamp timestamp, source_type string, confidence double")
    got = {r["zone_id"]: (r["occupancy"], r["source"], r["confidence"]) for r in occupancy.zone_state(zones, snap, live, manual).collect()}
    assert got == {"Z1": (10, "GATE", 0.8), "Z2": (5, "LIVE_EVENT", 0.9), "Z3": (2, "STORED_SNAPSHOT", 0.65),
                   "Z4": (0, "STORED_SNAPSHOT", 0.65), "Z5": (2, "STORED_SNAPSHOT", 0.65)}
    state = occupancy.zone_state(zones, snap, live, manual)
    kpi = aggregates.network_kpis(state).first()
    assert kpi["capacity"] == kpi["occupied"] + kpi["available"]
    assert state.where("occupancy NOT BETWEEN 0 AND capacity OR utilization NOT BETWEEN 0 AND 100").count() == 0


def test_models_recover_a_line_and_beat_the_mean(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        occ, hour = rng.uniform(0, 50), i % 24
        rows.append((minute(30 * i), f"Z{i % 5}", hour, i % 7, int(i % 7 >= 5), 0, 25.0, None, occ, 60, 45.0, 0.9 * occ + 0.2 * hour + 1))
    df = spark.createDataFrame(rows, "timestamp timestamp, zone_id string, hour int, day_of_week int, is_weekend int, is_holiday int, "
                                     "temperature double, rainfall double, current_occupancy double, capacity int, "
                                     "average_duration double, future_occupancy double")
    train, held = forecast.split(df)
    linear = models.fit_linear(train)
    intercept, weights = models.linear_coefficients(linear)
    assert weights["current_occupancy"] == pytest.approx(0.9, abs=1e-6) and weights["hour"] == pytest.approx(0.2, abs=1e-6)
    forest = models.fit_forest(train, numTrees=10, maxDepth=8)
    boosted = models.fit_boosted(train, maxIter=15, stepSize=0.3, maxDepth=4)
    for model in (linear, forest, boosted):
        scored = model.transform(models.complete(held))
        row = aggregates.regression_metrics(scored, [model.stages[-1].getPredictionCol()], actual="future_occupancy").first()
        assert row["r2"] > 0.9
        shares = [r["importance"] for r in models.importance(model, train, "m").collect()]
        assert sum(shares) == pytest.approx(1.0) and shares == sorted(shares, reverse=True)
    recent = models.score_recent({"f": forest, "b": boosted, "l": linear}, df)
    assert recent.where("predicted_occupancy NOT BETWEEN 0 AND capacity").count() == 0
    assert {"random_forest_prediction", "xgboost_prediction", "linear_prediction"} <= set(recent.columns)
    band = forecast.prediction_band(recent)
    assert band.where("predicted_occupancy NOT BETWEEN confidence_low AND confidence_high").count() == 0


def test_stored_tables_live_under_the_shared_folder(spark):
    stored = write_table(spark.range(3).toDF("n"), "demo")
    assert shared_dir(spark) in stored.inputFiles()[0]
    assert build_spark().sparkContext.applicationId == spark.sparkContext.applicationId
    assert callable(release)


def test_running_sum_keeps_rows_of_a_null_key(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, 2, 3), ("a", 1, 5)], "k string, t int, v int")
    got = sorted((r["k"] or "", r["t"], r["s"]) for r in ordered.running_sum(df, ["k"], ["t"], "v", "s").collect())
    assert got == [("", 1, 2), ("", 2, 5), ("a", 1, 5)]
    assert ordered.exact_quantiles(df, ["k"], "v", {"m": 0.5}).count() == 2


def test_queries_run_again_after_a_release(spark, sf_dir):
    from zoneflow.session import release
    from zoneflow.sources import sample
    before = sample.events(spark, sf_dir).count()
    release(spark)
    assert sample.events(spark, sf_dir).count() == before


def test_cadence_of_known_gaps(spark):
    times = [minute(0) + dt.timedelta(seconds=s) for s in (0, 2, 6, 106, 107)]
    files = spark.createDataFrame([(t,) for t in times], "file_modification_time timestamp")
    row = aggregates.batch_cadence(files).first()
    assert (row["micro_batch_seconds"], row["samples"]) == (2.33, 3)


def test_importance_table(spark, tmp_path):
    one = spark.createDataFrame([("a", "x", 0.25), ("a", "y", 0.75)], "model string, feature string, importance double")
    two = spark.createDataFrame([("b", "x", 1.0)], "model string, feature string, importance double")
    sinks.write_importance([two, one], str(tmp_path / "importance"))
    stored = spark.read.option("header", True).csv(str(tmp_path / "importance"))
    assert [tuple(r) for r in stored.collect()] == [("a", "y", "0.75"), ("a", "x", "0.25"), ("b", "x", "1.0")]


def test_one_outstanding_zone_reaches_all_and_opens_no_other_pairs(spark):
    rng = random.Random(4)
    rows = [(f"Z{i:04d}", f"N{i}", rng.uniform(-40, 40), rng.uniform(-150, 150), 60, 0, rng.randint(1, 40), 20.0) for i in range(300)]
    rows[7] = (*rows[7][:4], 10_000, 0, 10_000, 0.0)
    names = "zone_id string, zone_name string, latitude double, longitude double, capacity int, occupancy int, available int, utilization double"
    best = routing.reroute_candidates(spark.createDataFrame(rows, names)).collect()
    got = {(r["source_zone"], r["rank"]): r["target_zone"] for r in best}
    for s in rows:
        scored = sorted((-(c[6] - c[7] * 0.2 - _arc_km(s[2:4], c[2:4]) * 2.5), c[0]) for c in rows if c[0] != s[0])
        assert [got[s[0], r] for r in range(1, 6)] == [z for _, z in scored[:5]]


def test_index_lists_runs_of_rows_and_cuts_long_ones(spark):
    """A trigram has one list a run, not a row for each key; runs of long texts are cut and none is lost."""
    df = spark.range(3000).select("id", F.concat(F.lit("lot-"), F.col("id").cast("string")).alias("name")).coalesce(1)
    index = search.search_index(df, "id")
    assert index.where(F.col("gram") == search.text_grams("lot")[0]).count() < 10
    assert index.columns == ["gram", "run", "keys"]
    long = spark.range(6).select("id", F.concat(F.repeat(F.lit("ab"), 1_000_000), F.lit("-end"), F.col("id").cast("string")).alias("name")).coalesce(1)
    index = search.search_index(long, "id")
    assert index.select("run").distinct().count() > 1
    assert [r["id"] for r in search.search_indexed(long, index, "id", "END4").select("id").collect()] == [4]
