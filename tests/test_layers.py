"""Bronze and Silver as stored layers: replays after compaction, readers beside it, what a batch reads, files that stay few."""

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from zoneflow.operators.aggregates import silver_latest, zone_window_metrics
from zoneflow.schema import EVENT
from zoneflow.sources import live
from zoneflow.sources.files import footer_bounds, output_files, read_bronze
from zoneflow.streaming import bronze, silver
from zoneflow.streaming.windows import StreamConfig, run_stream

DAY = dt.datetime(2024, 1, 1)


def rows(spark, numbered, zone="Z001"):
    """Events by (id, minute of the first day)."""
    return spark.createDataFrame(
        [(f"E{i:05d}", DAY + dt.timedelta(minutes=m), f"V{i}", zone, "ENTRY", 0, 3, 5, 19.0, 72.8, 25.0, 0.0) for i, m in numbered], EVENT)


def ids(df):
    return Counter(r["event_id"] for r in df.select("event_id").collect())


def batches_of(spark):
    """25 events in three batches over two days; the last two bring copies of earlier ones."""
    return [rows(spark, [(i, 60 * i) for i in range(10)]), rows(spark, [(i, 60 * i) for i in range(5, 18)]),
            rows(spark, [(i, 60 * i) for i in range(15, 25)])]


def all_ids(n=25):
    return Counter(f"E{i:05d}" for i in range(n))


@pytest.mark.parametrize("in_place", [True, False])
def test_replayed_batches_meet_the_compacted_log(spark, tmp_path, in_place):
    source = path = str(tmp_path / "bronze")
    batches = batches_of(spark)
    for n, batch in enumerate(batches):
        bronze.bronze_writer(source)(batch, n)
    if in_place:
        bronze.compact_bronze(spark, source)
    else:
        path = str(tmp_path / "copy")
        bronze.compact_bronze(spark, source, path)
    assert ids(read_bronze(spark, path)) == all_ids()
    # The stream restarts on the compacted log: its last batch runs again, and new ones follow.
    for n, batch in ((2, batches[2]), (2, batches[2]), (3, rows(spark, [(24, 1440), (25, 1500), (3, 180)])), (3, rows(spark, [(24, 1440), (25, 1500), (3, 180)]))):
        bronze.bronze_writer(path)(batch, n)
        assert ids(read_bronze(spark, path)) >= all_ids()
    assert ids(read_bronze(spark, path)) == all_ids(26)


def test_readers_beside_a_compaction_see_each_event_once(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "bronze"), []
    for n, batch in enumerate(batches_of(spark)):
        bronze.bronze_writer(path)(batch, n)
    before, publish = read_bronze(spark, path), live.publish

    def between(*args):
        seen.append(ids(read_bronze(spark, path)))
        publish(*args)
        seen.append(ids(read_bronze(spark, path)))

    monkeypatch.setattr(live, "publish", between)
    bronze.compact_bronze(spark, path)
    bronze.bronze_writer(path)(rows(spark, [(25, 10)]), 3)
    bronze.compact_bronze(spark, path)
    assert seen == [all_ids(), all_ids(), all_ids(26), all_ids(26)]
    # A plan made before still finds its files, until they expire.
    assert ids(before) == all_ids()
    assert live.expire(spark, path) > 0 and live.expire(spark, path) == 0
    assert ids(read_bronze(spark, path)) == all_ids(26)
    assert read_bronze(spark, path, max_files=100).count() == 26


def test_two_publishers_cannot_take_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    live.publish(spark, path, ["_merged/event_date=2024-01-01/batch_id=-1"], "_new-1")
    monkeypatch.setattr(live, "version", lambda *_: 0)
    with pytest.raises(RuntimeError):
        live.publish(spark, path, [], "_new-1")
    monkeypatch.undo()
    assert live.folders(spark, path) == (["_merged/event_date=2024-01-01/batch_id=-1"], "_new-1")


def test_only_touched_days_are_compacted(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze.bronze_writer(path)(rows(spark, [(i, 360 * i) for i in range(12)]), 0)
    bronze.compact_bronze(spark, path)
    first = live.folders(spark, path)[0]
    bronze.bronze_writer(path)(rows(spark, [(20, 1441)]), 1)
    bronze.compact_bronze(spark, path)
    second = live.folders(spark, path)[0]
    assert len(first) == len(second) == 3 and len(set(first) & set(second)) == 2
    bronze.compact_bronze(spark, path)
    assert live.folders(spark, path)[0] == second


def scanned(df):
    """Rows that the scans of a plan put out, after files and pages are skipped."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(found)


@pytest.mark.parametrize("compacted", [False, True])
def test_a_batch_reads_its_own_span_of_time(spark, tmp_path, monkeypatch, compacted):
    """What the look-up of a batch reads stays flat while the day grows tenfold."""
    monkeypatch.setattr(bronze, "PAGE_ROWS", 500)
    path, read = str(tmp_path / "bronze"), []
    write = bronze.bronze_writer(path, files_per_day=24)

    def grow(first, last):
        write(rows(spark, [(n, n / 10) for n in range(600 * first, 600 * last)]), last)
        if compacted:
            bronze.compact_bronze(spark, path, files_per_day=24)
        batch = rows(spark, [(90_000 + n, 60 * last + n / 100) for n in range(50)] + [(600 * last - 1, 60 * last - 0.1)])
        ranges = bronze.time_ranges(batch.withColumn("event_date", F.to_date("timestamp")))
        held = bronze.held_events(spark, path, ranges, 99)
        read.append(scanned(held))
        assert held.where(f"event_id = 'E{600 * last - 1:05d}'").count() == 1

    for hour in range(2, 21, 2):
        grow(hour - 2, hour)
    assert read_bronze(spark, path).count() == 600 * 20
    # A page is the least that a look-up reads.
    assert max(read) <= 1200 if not compacted else max(read) <= 2 * bronze.PAGE_ROWS


def test_many_late_hours_become_ranges_of_days(spark):
    dated = rows(spark, [(i, 61 * i) for i in range(60)]).withColumn("event_date", F.to_date("timestamp"))
    assert len(bronze.time_ranges(dated)) == 60
    assert len(bronze.time_ranges(dated, most=10)) == 3


def test_the_sink_compacts_between_its_batches(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write = bronze.bronze_writer(path, files_per_day=1, compact_every=2)
    for n in range(9):
        write(rows(spark, [(i, i) for i in range(n, n + 3)]), n)
    assert ids(read_bronze(spark, path)) == all_ids(11)
    live.expire(spark, path)
    assert output_files(spark, path).where("file_path LIKE '%event_date%'").count() <= 2
    write(rows(spark, []), 9)
    assert ids(read_bronze(spark, path)) == all_ids(11)


def test_silver_keeps_few_files_and_every_window(spark, tmp_path):
    path, events = str(tmp_path / "silver"), []
    write = silver.silver_writer(path, compact_every=5)
    files = []
    for n in range(20):
        events += [(100 * n + i, (n * 7 + i) % 1500) for i in range(4)]
        write(zone_window_metrics(rows(spark, events)), n)
        live.expire(spark, path)
        files.append(output_files(spark, path).where("file_path LIKE '%batch_id=%' OR file_path LIKE '%window_date=%'").count())
    assert max(files[10:]) <= max(files[:10]) + 2
    want = zone_window_metrics(rows(spark, events)).select("window.start", "zone_id", "event_count")
    got = silver_latest(silver.read_silver(spark, path)).select("window_start", "zone_id", "event_count")
    assert set(map(tuple, got.collect())) == set(map(tuple, want.collect()))
    merged, current = live.folders(spark, path)
    assert len({re.search("window_date=([^/]+)", f)[1] for f in merged}) == len(merged) and current.startswith("_new-")
    silver.compact_silver(spark, path)
    assert live.folders(spark, path) == (merged, current)


def test_a_whole_stream_compacts_itself(spark, tmp_path):
    import json

    (tmp_path / "in").mkdir()
    cfg = StreamConfig(bronze=str(tmp_path / "b"), silver=str(tmp_path / "s"), checkpoints=str(tmp_path / "c"), source_format="json",
                       source_path=str(tmp_path / "in"), every=None, compact_every=1)
    for n in range(3):
        own = rows(spark, [(i, i) for i in range(10 * n, 10 * n + 12)]).collect()
        (tmp_path / "in" / f"{n}.json").write_text("".join(json.dumps({"value": json.dumps(r.asDict(), default=str)}) + "\n" for r in own))
        run_stream(spark, cfg)
    assert ids(read_bronze(spark, cfg.bronze)) == all_ids(32)
    assert silver_latest(silver.read_silver(spark, cfg.silver)).agg(F.sum("event_count")).first()[0] == 32
    assert live.version(spark, cfg.bronze) == 3


def test_run_metrics_tell_late_copied_and_unreadable_rows(spark, tmp_path):
    import json

    from zoneflow.streaming.metrics import run_report

    (tmp_path / "in").mkdir()
    cfg = StreamConfig(bronze=str(tmp_path / "b"), silver=str(tmp_path / "s"), checkpoints=str(tmp_path / "c"), source_format="json",
                       source_path=str(tmp_path / "in"), every=None, metrics=str(tmp_path / "m"))

    def drop(name, frame, *broken):
        lines = [json.dumps({"value": json.dumps(r.asDict(), default=str)}) for r in frame.collect()] + [json.dumps({"value": b}) for b in broken]
        (tmp_path / "in" / f"{name}.json").write_text("\n".join(lines))

    # Ten events, two of them again, one message that is none; then one far too late, one copy, and one in time.
    drop("a", rows(spark, [(i, 60 + i) for i in range(10)] + [(1, 61), (2, 62)]), "{broken")
    run_stream(spark, cfg)
    drop("b", rows(spark, [(50, 0), (9, 69), (51, 70)]))
    run_stream(spark, cfg)
    metrics = spark.read.parquet(cfg.metrics)
    seen = metrics.where("input_rows > 0").groupBy("query").agg(*[F.sum(c).alias(c) for c in ("input_rows", "parsed_rows", "unreadable_rows", "late_rows", "copies")]).collect()
    assert len(seen) == 2
    assert {(r["input_rows"], r["parsed_rows"], r["unreadable_rows"]) for r in seen} == {(16, 16, 1)}
    # Bronze keeps no state; the windows drop the late event and three copies.
    assert sorted((r["late_rows"], r["copies"]) for r in seen) == [(0, 0), (1, 3)]
    report = run_report(metrics.union(metrics)).collect()
    assert {r["input_rows"] for r in report} == {16} and all(r["seconds"] > 0 and r["batches"] >= 2 for r in report)


def test_the_state_of_a_command_stream_is_a_table(spark, tmp_path):
    """Zone state takes it for operator observations, and another stream goes on from it."""
    from zoneflow.operators.commands import apply_observations
    from zoneflow.operators.occupancy import zone_state
    from zoneflow.schema import COMMAND
    from zoneflow.streaming.commands import apply_observations_stream, command_state

    zones = spark.createDataFrame([("Z1", 50, 0), ("Z2", 3, 1), ("Z3", 9, 4)], "zone_id string, capacity int, occupancy int")

    def command(i, zone, action, amount=1, target=None):
        return (f"C{i:03d}", zone, action, amount, target, None, None, None, DAY + dt.timedelta(minutes=i))

    first = [command(i, ["Z1", "Z2"][i % 2], ["ENTRY", "ENTRY", "EXIT"][i % 3], 1 + i % 4) for i in range(60)]
    second = [command(100 + i, ["Z1", "Z2", "Z3"][i % 3], ["ENTRY", "EXIT", "SET"][i % 3], 1 + i % 2, 5) for i in range(30)]

    def run(name, rows_, start=None):
        spark.createDataFrame(rows_, COMMAND).coalesce(1).write.parquet(str(tmp_path / f"in{name}" / "a"))
        source = spark.readStream.schema(COMMAND).option("recursiveFileLookup", True).parquet(str(tmp_path / f"in{name}"))
        apply_observations_stream(source, zones, start).writeStream.format("parquet").option("path", str(tmp_path / f"out{name}")).option(
            "checkpointLocation", str(tmp_path / f"c{name}")).trigger(availableNow=True).start().awaitTermination()
        return {r["command_id"]: (r["status"], r["occupancy"]) for r in spark.read.parquet(str(tmp_path / f"out{name}")).collect()}

    done = run(1, first)
    state = command_state(spark, str(tmp_path / "c1"))
    held = {r["zone_id"]: (r["occupancy"], r["capacity"], r["timestamp"]) for r in state.collect()}
    assert held == {"Z1": (done["C058"][1], 50, DAY + dt.timedelta(minutes=58)), "Z2": (done["C059"][1], 3, DAY + dt.timedelta(minutes=59))}

    snapshot = zones.select("zone_id", "capacity", "occupancy")
    now = {r["zone_id"]: (r["occupancy"], r["source"]) for r in zone_state(zones.drop("occupancy"), snapshot, manual=state).collect()}
    assert now == {"Z1": (held["Z1"][0], "MANUAL_GATE"), "Z2": (held["Z2"][0], "MANUAL_GATE"), "Z3": (4, "STORED_SNAPSHOT")}

    more = run(2, second, state.withColumnRenamed("timestamp", "observed_at"))
    batch = {r["command_id"]: (r["status"], r["occupancy"]) for r in apply_observations(spark.createDataFrame(first + second, COMMAND), zones).collect()}
    assert done | more == batch


def test_bounds_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "numbers")
    schema = "id long, `a.b` double, day date, word string, none int"
    numbers = [(i, i / 2 if i % 3 else None, dt.date(2024, 1, 1 + i % 9), f"w{i:03d}", None) for i in range(100)]
    spark.createDataFrame(numbers, schema).repartition(4).write.parquet(path)
    found = footer_bounds(spark, path, ["id", "a.b", "day", "none"])
    assert tuple(found.first()) == (100, 0, 99, 0.5, 49.0, dt.date(2024, 1, 1), dt.date(2024, 1, 9), None, None)
    # Answered before it is asked: the plan holds the one row, and no scan of the files.
    pushed = footer_bounds(spark, path, ["id", "day"])
    assert tuple(pushed.first()) == (100, 0, 99, dt.date(2024, 1, 1), dt.date(2024, 1, 9))
    assert "FileScan" not in pushed._jdf.queryExecution().executedPlan().toString()
    odd = f"{path}-nan"
    spark.createDataFrame([(1.0,), (float("nan"),)], "x double").write.parquet(odd)
    assert str(footer_bounds(spark, odd, ["x"]).first().max_x) == "nan"
    assert tuple(footer_bounds(spark, path, ["word"]).first()) == (100, "w000", "w099")
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    spark.createDataFrame([], schema).write.parquet(f"{path}-empty")
    assert tuple(footer_bounds(spark, f"{path}-empty", ["id"]).first()) == (0, None, None)
