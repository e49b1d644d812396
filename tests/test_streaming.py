"""Bronze, silver and incidents over files, with availableNow triggers."""

import json
import threading
import types
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarryline.operators.enrich import latest_and_copies, latest_by_key
from quarryline.plans import runner
from quarryline.plans.parallel import run_graph
from quarryline.plans.runner import FACTS, build, daily_run, source_project
from quarryline.sources.catalog import DIMENSIONS, bootstrap, seed_dimensions, views
from quarryline.sources.lake import Lake
from quarryline.sources.simulator import SimulatedTelemetry, produce
from quarryline.streaming import jobs
from quarryline.streaming.metrics import PROGRESS, ProgressLog, alerts, health, partition_lag
from quarryline.verify import verify

AS_OF = datetime(2026, 3, 11)


def _record(n, **change):
    body = {"event_id": f"e{n}", "vehicle_id": "V1", "driver_id": "D1", "trip_id": "T1", "route_id": None, "event_time": f"2026-03-10T10:{n % 60:02d}:00.000Z", "latitude": 48.1, "longitude": 11.5, "speed": 70.0, "fuel_level": 55.0, "engine_temperature": 80.0, "battery_level": 90.0, "odometer_km": 1000.0 + n, "schema_version": "1.0"} | change
    return {"key": "V1", "value": json.dumps(body), "topic": "telemetry", "partition": 0, "offset": n, "timestamp": "2026-03-10T11:00:00.000Z"}


def _write(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(map(json.dumps, records)))


@pytest.fixture
def lake(spark):
    name = f"lake_{uuid.uuid4().hex[:8]}"
    yield Lake(spark, name, buckets=4)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _dimensions(spark, store):
    store.overwrite("dim_vehicle", spark.createDataFrame([("V1", "van", "M", "X", "north", "o", 60.0)], "vehicle_id string, vehicle_type string, manufacturer string, model string, region string, fleet_owner string, max_speed_kmh double"))
    store.overwrite("dim_driver", spark.createDataFrame([("D1", "Kim", "local")], "driver_id string, driver_name string, driver_category string"))


def test_bronze_to_silver_and_replay(spark, tmp_path, lake):
    good = [_record(n) for n in range(20)]
    bad = [_record(30, speed="fast"), _record(31, vehicle_id=None), _record(32, fuel_level=130.0)]
    _write(tmp_path / "in/a.json", [*good, *good[:5], *bad, _record(40, speed=None), _record(41, schema_version="9.9")])
    bronze_dir = f"{tmp_path}/bronze"
    records = jobs.file_records(spark, f"{tmp_path}/in")
    jobs.start_bronze(jobs.to_bronze(records, "r1", datetime(2026, 3, 10, 12)), bronze_dir, f"{tmp_path}/c1", None).awaitTermination()
    bronze = spark.read.parquet(bronze_dir)
    assert bronze.count() == 30 and bronze.select("event_date").distinct().count() == 1

    store = lake
    _dimensions(spark, store)
    source = jobs.bronze_stream(spark, bronze_dir, bronze.schema).drop("event_date")
    jobs.start_silver(source, store, f"{tmp_path}/c2", "s1", None, as_of=AS_OF).awaitTermination()
    silver = store.read("silver")
    assert silver.count() == 22 and silver.select("event_id").distinct().count() == 22
    assert silver.where("is_overspeed").count() == 21 and silver.where("is_overspeed IS NULL").count() == 1
    rules = {r["rule_name"] for r in store.read("quarantine").collect()}
    assert rules == {"speed_type_valid", "vehicle_id_not_null", "fuel_level_range"}
    ledger = store.read("reconciliation").collect()
    assert sum(r["output_count"] for r in ledger) == 22
    assert all(r["source_count"] - r["duplicate_count"] - r["rejected_count"] == r["output_count"] for r in ledger)

    before = store.read("silver").count(), store.read("quarantine").count()
    out = jobs.write_silver_batch(bronze.drop("event_date"), 77, store, "replay", as_of=AS_OF)
    assert (store.read("silver").count(), store.read("quarantine").count()) == before
    assert out["duplicates"] == 5 and out["rejected"] == 3


def test_late_rows_keep_their_day_without_watermark(spark, tmp_path, lake):
    schema = jobs.to_bronze(spark.createDataFrame([], jobs.RECORD), "r", AS_OF).schema
    store = lake
    _dimensions(spark, store)
    for n, day in enumerate(("2026-03-10", "2026-03-09")):
        rows = spark.createDataFrame([_record(n, event_time=f"{day}T10:00:00.000Z")], "key string, value string, topic string, partition int, offset bigint, timestamp string").withColumn("timestamp", F.to_timestamp("timestamp"))
        jobs.to_bronze(rows, "r", AS_OF).write.mode("append").parquet(f"{tmp_path}/b")
        source = jobs.bronze_stream(spark, f"{tmp_path}/b", schema)
        jobs.start_silver(source, store, f"{tmp_path}/c", "s", None, batch_only=True, as_of=AS_OF).awaitTermination()
    assert {str(r["event_date"]) for r in store.read("silver").collect()} == {"2026-03-10", "2026-03-09"}


def test_incidents(spark, tmp_path):
    _write(tmp_path / "in/a.json", [_record(1, engine_temperature=120.0), _record(2), _record(3, fuel_level=5.0)])
    jobs.start_incidents(jobs.file_records(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/c", None).awaitTermination()
    found = {json.loads(r["value"])["incident_type"] for r in spark.read.json(f"{tmp_path}/out").collect()}
    assert found == {"engine_critical_overheat", "low_fuel"}


def test_options_of_sources_and_sinks_and_checkpoints():
    assert jobs.source_options("b:9092", "t") == {"kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "200000"}
    assert jobs.source_options("b:9092", "t", "latest", None, False) == {"kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "latest", "failOnDataLoss": "false"}
    assert jobs.sink_of("alerts", "b:9092") == ("kafka", {"kafka.bootstrap.servers": "b:9092", "topic": "alerts"}) and jobs.sink_of("/x") == ("json", {"path": "/x"})
    assert jobs.checkpoint("s3://lake/", "silver") == "s3://lake/checkpoints/silver"
    with pytest.raises(ValueError):
        jobs.checkpoint("r", "../x")


def test_progress_is_kept_in_a_table_and_feeds_panels_and_alerts(spark, tmp_path, lake):
    schema = jobs.to_bronze(spark.createDataFrame([], jobs.RECORD), "r", AS_OF).schema
    for n, time in enumerate(("10:00", "12:00", "10:05")):  # the last is older than the watermark after the second
        log = ProgressLog(lake, every_seconds=0.2)  # a driver of its own each time
        with log.listening():
            _bronze(spark, [_record(n, event_time=f"2026-03-10T{time}:00.000Z")], AS_OF).write.mode("append").parquet(f"{tmp_path}/b")
            source = jobs.deduplicated(jobs.bronze_stream(spark, f"{tmp_path}/b", schema))
            source.writeStream.queryName("dedup").format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", jobs.checkpoint(f"{tmp_path}", "dedup")).trigger(availableNow=True).start().awaitTermination()
        assert log.lost == 0
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    progress = lake.read(ProgressLog.TABLE)
    found = health(progress).collect()
    assert len(found) == 1 and found[0]["query"] == "dedup" and found[0]["input_rows"] == 3 and found[0]["dropped_late"] == 1 and found[0]["state_rows"] >= 0
    assert "late rows dropped" in {r["alert"] for r in alerts(progress.where("input_rows > 0")).collect()}


def test_a_full_queue_and_a_failing_table_hold_nothing_up(spark, lake, monkeypatch):
    log = ProgressLog(lake, most=3)
    told = {"name": "q", "batchId": 1, "timestamp": "2026-03-10T10:00:00.000Z"}
    event = types.SimpleNamespace(progress=types.SimpleNamespace(json=json.dumps(told)))
    for _ in range(5):
        log.onQueryProgress(event)
    assert log.lost == 2
    with monkeypatch.context() as m:
        m.setattr(Lake, "append", lambda *a: 1 / 0)
        assert log.flush() == 0 and len(log.failed) == 3
    log.onQueryProgress(event)
    assert log.flush() == 4 and log.lost == 2 and lake.read(ProgressLog.TABLE).count() == 4


def test_alerts_fire_only_after_their_time(spark):
    t = datetime(2026, 1, 1)
    row = lambda q, k, ms=100, rows=1, behind=0: (q, k, t.replace(minute=k), rows, 1.0, 1.0, ms, 0, 0, behind)
    rows = [row("all", k, 31_000, 0, 600_000 * (k + 1)) for k in range(17)]
    rows += [row("brief", k, 31_000, 0, 600_000 * (k + 1)) for k in range(10)]
    rows += [row("mended", k, 31_000 if k != 12 else 10) for k in range(17)] + [row("fine", k, behind=100 - k) for k in range(17)]
    rows += [row("lately", k, 31_000 if k > 3 else 10) for k in range(17)]
    found = {(r["query"], r["alert"]): round(r["held_minutes"]) for r in alerts(spark.createDataFrame(rows, PROGRESS)).collect()}
    assert found == {("all", "slow batches"): 16, ("all", "high lag"): 16, ("all", "nothing arrives"): 16, ("all", "lag grows"): 15, ("lately", "slow batches"): 12}
    offsets = spark.createDataFrame([(p, 1000 if p else 90_000, 0) for p in range(12)], "kafka_partition int, latest long, committed long")
    assert [r["kafka_partition"] for r in partition_lag(offsets).where("skewed").collect()] == [0]


def test_runner_incremental_facts_and_verification(spark, tmp_path, lake):
    manifest = produce(f"{tmp_path}/in", {"vehicles": 4, "ticks": 700, "hot": "V9999", "hot_factor": 3, "duplicates": 0.02, "late": 0.05, "start": "2026-03-09T23:00:00"})
    assert manifest["clean"] == 7 * 700 and manifest["produced"] == manifest["clean"] + manifest["duplicates"] and manifest["late"] > 100 and manifest["hot"] == 2100
    records = jobs.file_records(spark, f"{tmp_path}/in")
    jobs.start_bronze(jobs.to_bronze(records, "r1", datetime(2026, 3, 10, 1)), f"{tmp_path}/bronze", f"{tmp_path}/c1", None).awaitTermination()
    bronze = spark.read.parquet(f"{tmp_path}/bronze")
    store = lake
    names = [f"V{1000 + i}" for i in range(4)] + ["V9999"]
    made = seed_dimensions(store, {"dim_vehicle": [(n, "van", "M", "X", "north", "o", 90.0, 60.0, 10.0, 100.0, False) for n in names], "dim_driver": [(f"D{i}", f"N{i}", "local", "B", 1.0) for i in range(40)], "dim_route": [(f"R{i:03d}", f"r{i}", 80.0, 2, 1.0, 1.0, 2.0, 2.0) for i in range(12)]})
    assert made == {"dim_vehicle": 5, "dim_driver": 40, "dim_route": 12}
    as_of = datetime(2026, 3, 10, 2)
    first, second = bronze.where("event_time < '2026-03-10'"), bronze.where("event_time >= '2026-03-10'")
    jobs.write_silver_batch(first.drop("event_date"), 0, store, "s", as_of=as_of)
    assert [s.passed for s in daily_run(store, as_of)] == [True] * 5
    jobs.write_silver_batch(second.drop("event_date"), 1, store, "s", as_of=as_of)
    jobs.write_silver_batch(second.drop("event_date"), 1, store, "s", as_of=as_of)
    assert [s.name for s in daily_run(store, as_of) if s.passed] == ["freshness", "reconciliation", "build", "test", "report"]
    whole = source_project(store, as_of)
    for name, (key, _) in FACTS.items():
        stored, want = store.read(name), whole[name]
        assert sorted(map(str, stored.select(sorted(want.columns)).collect())) == sorted(map(str, want.select(sorted(want.columns)).collect())), (name, key)
    report = {line.name: line.status for line in verify(store, bronze, manifest=manifest, with_replay=True, as_of=as_of)}
    assert report["replay changes nothing"] == report["late readings keep their day"] == report["all that was sent came in"] == "PASS" and "FAIL" not in report.values()
    with views(store, ["silver"], "v_") as (name,):
        assert spark.sql(f"SELECT count(*) AS n FROM {name}").first()["n"] == manifest["clean"]
    assert not spark.catalog.tableExists("v_silver")
    assert not daily_run(store, datetime(2026, 3, 20))[-1].passed


def _all_dimensions(spark, lake):
    lake.overwrite("dim_route", spark.createDataFrame([("R1", "r", 80.0, 2, 1.0, 1.0, 2.0, 2.0)], DIMENSIONS["dim_route"]))
    lake.overwrite("dim_vehicle", spark.createDataFrame([("V1", "van", "M", "X", "north", "o", 60.0, 60.0, 10.0, 100.0, False)], DIMENSIONS["dim_vehicle"]))
    lake.overwrite("dim_driver", spark.createDataFrame([("D1", "Kim", "local", "B", 1.0)], DIMENSIONS["dim_driver"]))


def _bronze(spark, records, at):
    rows = spark.createDataFrame(records, "key string, value string, topic string, partition int, offset bigint, timestamp string").withColumn("timestamp", F.to_timestamp("timestamp"))
    return jobs.to_bronze(rows, "r", at)


def _facts_are_whole(lake, as_of):
    whole = source_project(lake, as_of)
    for name in FACTS:
        stored, want = lake.read(name), whole[name]
        show = lambda df: sorted(map(str, df.select([F.round(c, 6).alias(c) if k == "double" else c for c, k in sorted(want.dtypes)]).collect()))
        assert show(stored) == show(want), name


def test_a_batch_is_read_once_and_ledger_counts_it(spark, lake):
    _dimensions(spark, lake)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    records = [_record(n) for n in range(9)] + [_record(3), _record(4), _record(20, speed="fast"), _record(21, vehicle_id=None)]
    bronze = _bronze(spark, records, AS_OF)
    for n in range(2):
        got = jobs.write_silver_batch(bronze.mapInArrow(seen, bronze.schema), 5, lake, "s", as_of=AS_OF)
        assert got == {"source": 13, "duplicates": 2, "rejected": 2, "output": 9} and read.value == 13 * (n + 1)
    line = lake.read("reconciliation").collect()
    assert len(line) == 1 and (line[0]["source_count"], line[0]["duplicate_count"], line[0]["rejected_count"], line[0]["output_count"]) == (13, 2, 2, 9)
    assert lake.read("silver").count() == 9 and lake.read("quarantine").count() == 2
    assert jobs.write_silver_batch(bronze.limit(0), 6, lake, "s", as_of=AS_OF)["source"] == 0


def test_duplicates_are_counted_by_themselves_so_a_ledger_can_fail(spark, lake):
    _dimensions(spark, lake)
    assert jobs.write_silver_batch(_bronze(spark, [_record(1, speed="fast"), _record(2, vehicle_id=None)], AS_OF), 0, lake, "s", as_of=AS_OF) == {"source": 2, "duplicates": 0, "rejected": 2, "output": 0}
    records = [_record(n) for n in (1, 1, 1, 2, 3, 3)]
    assert jobs.write_silver_batch(_bronze(spark, records, AS_OF), 1, lake, "s", as_of=AS_OF) == {"source": 6, "duplicates": 3, "rejected": 0, "output": 3}
    assert [s.passed for s in daily_run(lake, AS_OF)][:2] == [True, True]
    # A vehicle that stands twice in its dimension multiplies readings: the run must stop at its reconciliation.
    lake.overwrite("dim_vehicle", lake.read("dim_vehicle").union(lake.read("dim_vehicle")))
    got = jobs.write_silver_batch(_bronze(spark, records, AS_OF), 2, lake, "s", as_of=AS_OF)
    assert got["output"] == 6 and got["source"] - got["duplicates"] - got["rejected"] != got["output"]
    run = daily_run(lake, AS_OF)
    assert (run[-1].name, run[-1].passed) == ("reconciliation", False) and run[-1].detail.startswith("1 of 3")


@pytest.mark.parametrize("null_at", [True, False])
def test_latest_and_copies_is_latest_by_key_with_a_count(spark, null_at):
    rows = [(k, None if null_at and v == 9 else v, f"{k}{v}") for k in ("a", "b", None) for v in (3, 9, 5)] + [("c", None, "c")]
    df = spark.createDataFrame(rows, "k string, v long, row string")
    got = latest_and_copies(df, "k", "v", copies="n")
    assert got.columns == ["k", "v", "row", "n"] and {r["n"] for r in got.where("k = 'c'").collect()} == {1}
    assert sorted(map(str, got.drop("n").collect())) == sorted(map(str, latest_by_key(df, "k", "v").collect())) and got.agg(F.sum("n")).first()[0] == len(rows)


def test_a_corrected_time_leaves_one_reading(spark, lake):
    _dimensions(spark, lake)
    jobs.write_silver_batch(_bronze(spark, [_record(1), _record(2)], datetime(2026, 3, 10, 12)), 0, lake, "s", as_of=AS_OF)
    jobs.write_silver_batch(_bronze(spark, [_record(1, event_time="2026-03-07T10:00:00.000Z")], datetime(2026, 3, 10, 13)), 1, lake, "s", as_of=AS_OF)
    assert sorted((r["event_id"], str(r["event_date"])) for r in lake.read("silver").collect()) == [("e1", "2026-03-07"), ("e2", "2026-03-10")]


def test_a_reading_ten_days_late_and_a_corrected_one_change_all_facts(spark, lake):
    _all_dimensions(spark, lake)
    day = lambda n, d, **more: _record(n, event_time=f"2026-03-{d:02d}T10:{n:02d}:00.000Z", trip_id=f"T{d}", route_id="R1", **more)
    first = [day(n, d) for n, d in enumerate([1, 1, 1, 11, 11, 11, 12, 12])] + [_record(8, event_time="2026-03-13T00:05:00.000Z", trip_id="T12", route_id="R1")]
    at = [datetime(2026, 3, 13, h) for h in range(4)]
    jobs.write_silver_batch(_bronze(spark, first, at[0]), 0, lake, "s", as_of=at[0])
    assert {o for o, _ in build(lake, at[0]).values()} == {"done"}
    _facts_are_whole(lake, at[0])
    before = {name: lake.read(name).count() for name in FACTS}
    # Of day 1: a new reading that is an incident; of day 11: one that moves to day 5, one that is cooler no more.
    late = [day(30, 1, engine_temperature=120.0), _record(3, event_time="2026-03-05T09:00:00.000Z", trip_id="T5", route_id="R1"), day(4, 11, engine_temperature=130.0)]
    jobs.write_silver_batch(_bronze(spark, late, at[1]), 1, lake, "s", as_of=at[1])
    outcome = build(lake, at[1])
    assert {o for o, _ in outcome.values()} == {"done"}
    _facts_are_whole(lake, at[1])
    after = {name: lake.read(name).count() for name in FACTS}
    assert after == {"fact_telemetry": before["fact_telemetry"] + 1, "fact_driver_incident": before["fact_driver_incident"] + 1, "fact_vehicle_daily": before["fact_vehicle_daily"] + 1, "fact_trip": before["fact_trip"] + 1}
    # A reading that is no incident any more takes its incident with it.
    jobs.write_silver_batch(_bronze(spark, [day(4, 11, speed=10.0)], at[2]), 2, lake, "s", as_of=at[2])
    build(lake, at[2])
    _facts_are_whole(lake, at[2])
    assert not lake.read("fact_driver_incident").where("event_id = 'e4'").count() and lake.read("route_performance").count() == 1
    assert lake.mark(runner.MARK) == at[2]


def test_a_failing_fact_cuts_off_its_reports_only(spark, lake, monkeypatch):
    _all_dimensions(spark, lake)
    jobs.write_silver_batch(_bronze(spark, [_record(n) for n in range(4)], AS_OF), 0, lake, "s", as_of=AS_OF)
    with monkeypatch.context() as m:
        own = Lake.overwrite

        def overwrite(self, table, *args):
            if table == "fact_trip":
                raise OSError("disk")
            return own(self, table, *args)

        m.setattr(Lake, "overwrite", overwrite)
        got = build(lake, AS_OF)
    assert got["fact_trip"] == ("failed", "OSError: disk") and {n: got[n][0] for n in ("route_daily", "route_performance", "driver_performance")} == dict.fromkeys(("route_daily", "route_performance", "driver_performance"), "skipped")
    assert got["fleet_distincts"][0] == got["fact_telemetry"][0] == "done" and lake.mark(runner.MARK) is None


def test_steps_run_side_by_side_in_pools_of_their_own(spark):
    both = threading.Barrier(2, timeout=60)
    pools = {}

    def step(name):
        both.wait()
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    got = run_graph(spark, {"a": lambda: step("a"), "b": lambda: step("b"), "c": lambda: "after both"}, {"c": {"a", "b"}})
    assert got == {"a": ("done", ""), "b": ("done", ""), "c": ("done", "after both")} and pools == {"a": "a", "b": "b"}


def test_bootstrap_lists_tables_and_proves_a_round_trip(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lake LOCATION '{tmp_path}/lake'")
    assert bootstrap(spark, "lake") == bootstrap(spark, "lake") == ["bronze_telemetry", "quarantine", "reconciliation", "silver_telemetry"]
    spark.sql("DROP DATABASE lake CASCADE")


def test_simulator_as_a_stream_equals_the_batch(spark, tmp_path):
    spark.dataSource.register(SimulatedTelemetry)
    options = {"vehicles": 3, "ticks": 45, "ticks_per_batch": 10, "hot": "V9999", "hot_factor": 4}
    spark.readStream.format("simulated_telemetry").options(**options).load().writeStream.format("parquet").option("path", f"{tmp_path}/o").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="0 seconds").start().processAllAvailable()
    for q in spark.streams.active:
        q.stop()
    want = spark.read.format("simulated_telemetry").options(**options).load()
    got = spark.read.schema(want.schema).parquet(f"{tmp_path}/o")
    assert got.count() == want.count() == 7 * 45 and not got.exceptAll(want).count()
