"""Stream results against batch results, replays, late rows and keyed state."""

import datetime as dt
import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.operators.aggregates import batch_cadence, flat_window, silver_latest, zone_window_metrics
from zoneflow.operators.commands import apply_observations, prepare
from zoneflow.schema import COMMAND, EVENT
from zoneflow.sources.files import output_files, read_bronze
from zoneflow.sources.stream import RAW, parse_events, read_event_stream
from zoneflow.streaming.commands import apply_observations_stream
from zoneflow.streaming.dedup import Generations, dedup_stream
from zoneflow.streaming.windows import (
    FILES_PER_DAY, StreamConfig, compact_bronze, read_silver, run_stream, source_options, stream_metrics, write_bronze, write_silver,
)

START = dt.datetime(2024, 1, 1)


def event(i, minute, zone="Z001", occupancy=3, capacity=5, **extra):
    return {
        "event_id": f"E{i:04d}", "timestamp": (START + dt.timedelta(minutes=minute)).isoformat(" "),
        "vehicle_id": f"V{i}", "zone_id": zone, "event_type": "ENTRY", "parking_duration": 0,
        "occupancy": occupancy, "capacity": capacity, "latitude": 19.0, "longitude": 72.8,
        "temperature": 25.0, "rainfall": 0.0, **extra,
    }


def drop(folder, name, events):
    """One source file of JSON messages, one per line; written aside first."""
    folder.mkdir(exist_ok=True)
    path = folder / f".{name}.tmp"
    path.write_text("".join(json.dumps({"value": e if isinstance(e, str) else json.dumps(e)}) + "\n" for e in events))
    path.rename(folder / f"{name}.json")


def config(tmp_path, **kw):
    return StreamConfig(
        bronze=str(tmp_path / "bronze"), silver=str(tmp_path / "silver"), checkpoints=str(tmp_path / "ckpt"),
        source_format="json", source_path=str(tmp_path / "in"), every=None, **kw,
    )


def ids(df):
    return Counter(r["event_id"] for r in df.select("event_id").collect())


def test_stream_equals_batch_over_several_runs(spark, tmp_path):
    one = [event(i, i % 20, zone=f"Z00{i % 3 + 1}", occupancy=i % 6) for i in range(60)]
    two = [event(100 + i, 15 + i % 20, zone=f"Z00{i % 3 + 1}", occupancy=i % 6) for i in range(60)]
    bad = ["{broken", json.dumps(event(900, 16, capacity=0)), json.dumps(event(901, 16, occupancy=-1)),
           json.dumps({**event(902, 16), "timestamp": "never"})]
    drop(tmp_path / "in", "a", one)
    cfg = config(tmp_path)
    run_stream(spark, cfg)
    drop(tmp_path / "in", "b", two + one[:5] + bad)
    run_stream(spark, cfg)

    bronze = read_bronze(spark, cfg.bronze)
    assert ids(bronze) == Counter(e["event_id"] for e in one + two)

    latest = silver_latest(read_silver(spark, cfg.silver))
    batch = flat_window(zone_window_metrics(spark.createDataFrame(
        [{**e, "timestamp": dt.datetime.fromisoformat(e["timestamp"])} for e in one + two], EVENT)))
    columns = ["window_start", "window_end", "zone_id", "avg_occupancy", "max_occupancy", "event_count", "utilization_pct"]
    assert set(map(tuple, latest.select(columns).collect())) == set(map(tuple, batch.select(columns).collect()))


def test_bronze_is_partitioned_and_pruned(spark, tmp_path):
    drop(tmp_path / "in", "a", [event(i, i, zone=f"Z00{i % 2 + 1}") for i in range(10)])
    cfg = config(tmp_path)
    run_stream(spark, cfg)
    stored = spark.read.parquet(cfg.bronze).where("event_date = '2024-01-01'")
    assert stored.count() == 10
    assert "PartitionFilters: [isnotnull(event_date" in stored._jdf.queryExecution().toString()
    assert output_files(spark, cfg.bronze).count() <= FILES_PER_DAY
    drop(tmp_path / "in", "b", [event(20, 5)])
    run_stream(spark, cfg)
    assert read_bronze(spark, cfg.bronze, max_files=1).count() == 1
    assert read_bronze(spark, cfg.bronze, max_files=50).count() == 11
    assert batch_cadence(output_files(spark, cfg.bronze)).first()["micro_batch_seconds"] > 0


def test_unreadable_file_is_skipped(spark, tmp_path):
    spark.createDataFrame([(1,)], "capacity int").write.parquet(str(tmp_path / "b"))
    (tmp_path / "b" / "broken.parquet").write_bytes(b"not parquet at all")
    assert read_bronze(spark, str(tmp_path / "b")).count() == 1
    assert read_bronze(spark, str(tmp_path / "b"), max_files=5).count() == 1


def test_silver_batch_run_twice_leaves_one_copy(spark, tmp_path):
    from zoneflow.streaming.windows import silver_writer
    ev = spark.createDataFrame([{**event(1, 1), "timestamp": START}], EVENT)
    metrics = zone_window_metrics(ev)
    write = silver_writer(str(tmp_path / "silver"))
    write(metrics, 0)
    write(metrics, 0)
    write(metrics.limit(0), 1)
    assert read_silver(spark, str(tmp_path / "silver")).count() == 1


def test_late_rows_are_dropped_and_append_waits(spark, tmp_path):
    drop(tmp_path / "in", "a", [event(1, 0), event(2, 30)])
    source = read_event_stream(spark, "json", str(tmp_path / "in"))

    def run():
        query = (
            flat_window(stream_metrics(parse_events(source))).writeStream.format("parquet").outputMode("append")
            .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query

    run()
    drop(tmp_path / "in", "b", [event(3, 26), event(4, 1), event(5, 60)])
    query = run()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    rows = {r["window_start"].minute: r["event_count"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # Minute 26 came 4 minutes late and counts; minute 1 was 29 late; minute 60 stays open.
    assert rows == {0: 1, 25: 1, 30: 1}


def _run_dedup(spark, tmp_path, mode):
    source = read_event_stream(spark, "json", str(tmp_path / "in"))
    out = dedup_stream(parse_events(source), "5 minutes", mode)
    query = (
        out.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    query.awaitTermination()


@pytest.mark.parametrize("mode", ["exact", "bloom"])
def test_replays_across_batches_are_suppressed(spark, tmp_path, mode):
    events = [event(i, i % 4) for i in range(50)]
    drop(tmp_path / "in", "a", events + events[:10])
    _run_dedup(spark, tmp_path, mode)
    drop(tmp_path / "in", "b", events[20:30] + [event(200, 5)])
    _run_dedup(spark, tmp_path, mode)
    assert ids(spark.read.parquet(str(tmp_path / "out"))) == Counter([e["event_id"] for e in events] + ["E0200"])


def test_bloom_stream_publishes_closed_windows(spark, tmp_path):
    events = [event(i, i % 10) for i in range(30)]
    drop(tmp_path / "in", "a", events + events[:5])
    cfg = config(tmp_path, dedup="bloom")
    run_stream(spark, cfg)
    drop(tmp_path / "in", "b", events[25:] + [event(90, 40)])
    run_stream(spark, cfg)
    assert ids(read_bronze(spark, cfg.bronze)) == Counter([e["event_id"] for e in events] + ["E0090"])
    closed = {r["window_start"].minute: r["event_count"] for r in silver_latest(read_silver(spark, cfg.silver)).collect()}
    assert closed == {0: 15, 5: 15}


@pytest.mark.parametrize("mode", ["exact", "bloom"])
def test_bronze_keeps_late_events(spark, tmp_path, mode):
    cfg = config(tmp_path, dedup=mode)
    drop(tmp_path / "in", "a", [event(1, 0), event(2, 30)])
    run_stream(spark, cfg)
    drop(tmp_path / "in", "b", [event(3, 26), event(4, 1), event(5, 60), event(1, 0)])
    run_stream(spark, cfg)
    assert ids(read_bronze(spark, cfg.bronze)) == Counter(f"E{i:04d}" for i in range(1, 6))
    compact_bronze(spark, cfg.bronze, str(tmp_path / "compact"), files_per_day=1)
    assert ids(read_bronze(spark, str(tmp_path / "compact"))) == Counter(f"E{i:04d}" for i in range(1, 6))
    assert output_files(spark, str(tmp_path / "compact")).count() == 1


def test_bronze_batch_run_twice_leaves_one_copy(spark, tmp_path):
    from zoneflow.streaming.windows import bronze_writer
    rows = spark.createDataFrame([{**event(i, i), "timestamp": START} for i in range(5)], EVENT)
    write = bronze_writer(str(tmp_path / "bronze"))
    for batch_id in (0, 0, 1):
        write(rows, batch_id)
    assert read_bronze(spark, str(tmp_path / "bronze")).count() == 5


def test_bloom_generations_stay_below_the_rate():
    rng, m, k, rate = np.random.default_rng(1), 1 << 14, 6, 1e-3
    arrays, lost = Generations(m, k, rate), 0
    for _ in range(60):
        new, old, count = arrays.packed()
        arrays = Generations(m, k, rate, new, old, count)
        lost += int((~arrays.add(rng.integers(0, m, (50_000, k)))).sum())
    assert lost <= 2 * rate * 3_000_000
    again = rng.integers(0, m, (100, k))
    assert arrays.add(again).sum() >= 99 and not arrays.add(again).any()


def test_rate_bound_reaches_the_reader():
    cfg = StreamConfig("b", "s", "c", max_per_trigger=500)
    assert source_options(cfg) == {"maxOffsetsPerTrigger": "500"}
    assert source_options(StreamConfig("b", "s", "c", source_format="json", max_per_trigger=5)) == {"maxFilesPerTrigger": "5"}


def test_unknown_dedup_mode(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError):
        dedup_stream(parse_events(read_event_stream(spark, "json", str(tmp_path / "in"))), mode="guess")


def test_sinks_can_run_on_their_own(spark, tmp_path):
    drop(tmp_path / "in", "a", [event(i, i) for i in range(6)])
    events = parse_events(read_event_stream(spark, "json", str(tmp_path / "in")))
    write_bronze(events, str(tmp_path / "b"), str(tmp_path / "c1"), every=None).awaitTermination()
    write_silver(stream_metrics(events), str(tmp_path / "s"), str(tmp_path / "c2"), every=None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "b")).count() == 6
    assert silver_latest(read_silver(spark, str(tmp_path / "s"))).agg(F.sum("event_count")).first()[0] == 6


def test_timed_run_stops_both_queries(spark, tmp_path):
    drop(tmp_path / "in", "a", [event(1, 1)])
    cfg = config(tmp_path)
    cfg.every, cfg.run_seconds = "1 second", 6
    queries = run_stream(spark, cfg)
    assert not any(q.isActive for q in queries.values())
    with pytest.raises(ValueError):
        cfg.run_seconds = -1
        run_stream(spark, cfg)


def test_command_stream_keeps_state_between_batches(spark, tmp_path):
    zones = spark.createDataFrame([("Z1", 5, 2), ("Z2", 3, 0)], "zone_id string, capacity int, occupancy int")

    def command(i, zone, action, amount=1, target=None):
        return (f"C{i:02d}", zone, action, amount, target, None, None, None, START + dt.timedelta(minutes=i))

    first = [command(1, "Z1", "ENTRY", 2), command(2, "Z1", "ENTRY", 9), command(3, "Z2", "EXIT")]
    second = [command(4, "Z1", "exit", 3), command(5, "Z2", "SET", target=3), command(6, "Z1", "PARK"), command(7, "Z9", "ENTRY")]
    for name, rows in (("a", first), ("b", second)):
        spark.createDataFrame(rows, COMMAND).coalesce(1).write.parquet(str(tmp_path / "in" / name))
        source = spark.readStream.schema(COMMAND).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        (
            apply_observations_stream(source, zones).writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination()
        )
    got = {r["command_id"]: (r["status"], r["occupancy"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {
        "C01": ("ACCEPTED", 4), "C02": ("OUT_OF_RANGE", 4), "C03": ("OUT_OF_RANGE", 0),
        "C04": ("ACCEPTED", 1), "C05": ("ACCEPTED", 3), "C06": ("UNKNOWN_ACTION", None), "C07": ("UNKNOWN_ZONE", None),
    }
    batch = apply_observations(spark.createDataFrame(first + second, COMMAND), zones)
    assert {r["command_id"]: (r["status"], r["occupancy"]) for r in batch.collect()} == got
    assert prepare(spark.createDataFrame(first, COMMAND), zones).count() == 3


def test_messages_parse_or_become_null(spark):
    rows = [("{broken",), (json.dumps(event(1, 1, confidence=0.5, source_type="x")),),
            (json.dumps({"event_id": "E9", "occupancy": "many"}),)]
    got = parse_events(spark.createDataFrame(rows, RAW)).collect()
    assert got[0]["event_id"] is None and got[0]["timestamp"] is None
    assert got[1]["event_id"] == "E0001" and got[1]["timestamp"] == START + dt.timedelta(minutes=1)
    assert got[2]["occupancy"] is None
    assert got[0].asDict().keys() == set(EVENT.fieldNames())
