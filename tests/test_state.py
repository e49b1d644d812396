"""State on RocksDB with the session's settings, restarts, the state as a table, and late readings."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarryline.session import SETTINGS
from quarryline.streaming import jobs, late, state

AS_OF = datetime(2026, 3, 11)


@pytest.fixture
def own(spark):
    """A session with the engine's settings."""
    session = spark.newSession()
    for k, v in SETTINGS.items():
        session.conf.set(k, v)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return session


def write(spark, path, readings, at):
    records = [("V1", json.dumps({"event_id": e, "vehicle_id": "V1", "trip_id": "T", "event_time": f"2026-03-10T{time}:00.000Z"}), "t", 0, n, datetime(2026, 3, 10, 12)) for n, (e, time) in enumerate(readings)]
    jobs.to_bronze(spark.createDataFrame(records, jobs.RECORD), "r", at).coalesce(1).write.mode("append").parquet(path)


def run(spark, source, tmp_path, name):
    query = source.writeStream.queryName(name).format("parquet").option("path", f"{tmp_path}/{name}-out").option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_dedup_state_lives_in_rocksdb_survives_a_restart_and_is_a_table(own, tmp_path):
    schema = jobs.to_bronze(own.createDataFrame([], jobs.RECORD), "r", AS_OF).schema
    for n, readings in enumerate(([("a", "10:00"), ("b", "10:01"), ("a", "10:00")], [("b", "10:01"), ("c", "10:04")])):
        write(own, f"{tmp_path}/in", readings, AS_OF)
        query = run(own, jobs.deduplicated(jobs.bronze_stream(own, f"{tmp_path}/in", schema)), tmp_path, "dedup")
        told = [s for p in query.recentProgress for s in p["stateOperators"]]
        assert any("rocksdbCommitFileSyncLatencyMs" in s["customMetrics"] or any("rocksdb" in k for k in s["customMetrics"]) for s in told)
        assert state.sizes(own, f"{tmp_path}/dedup").agg(F.sum("keys")).first()[0] == (2, 3)[n]
    assert sorted(r["event_id"] for r in own.read.parquet(f"{tmp_path}/dedup-out").collect()) == ["a", "b", "c"]
    shown = state.operators(own, f"{tmp_path}/dedup").collect()
    assert [(r["name"], r["partitions"]) for r in shown] == [("dedupeWithinWatermark", 2)]
    assert {r["key"]["event_id"] for r in state.entries(own, f"{tmp_path}/dedup").collect()} == {"a", "b", "c"}
    first = state.entries(own, f"{tmp_path}/dedup", batch=shown[0]["first_batch"]).collect()
    assert {r["key"]["event_id"] for r in first} == {"a", "b"}


def test_late_readings_are_put_out_and_everything_is_accounted_for(own, tmp_path):
    schema = jobs.to_bronze(own.createDataFrame([], jobs.RECORD), "r", AS_OF).schema
    sent = []
    batches = [[("a", "10:00"), ("a", "10:00"), ("b", "10:05")], [("c", "12:00"), ("b", "10:05")], [("d", "10:10"), ("e", "11:55"), ("a", "10:00"), ("d", "10:10")], [("d", "10:10"), ("f", "12:01")]]
    for n, readings in enumerate(batches):  # each run begins anew from the checkpoint
        write(own, f"{tmp_path}/in", readings, datetime(2026, 3, 11, n))
        sent += readings
        run(own, late.judged(jobs.bronze_stream(own, f"{tmp_path}/in", schema)), tmp_path, "late")
    out = own.read.parquet(f"{tmp_path}/late-out")
    found = sorted((r["event_id"], r["arrival"]) for r in out.collect())
    assert found == sorted([("a", "accepted"), ("a", "repeated"), ("a", "repeated"), ("b", "accepted"), ("b", "repeated"), ("c", "accepted"), ("d", "late"), ("d", "repeated"), ("d", "repeated"), ("e", "accepted"), ("f", "accepted")])
    assert len(found) == len(sent) and out.columns[:-1] == schema.names
    assert {r["key"]["event_id"] for r in state.entries(own, f"{tmp_path}/late").collect()} == set("abcdef")


def test_a_key_is_forgotten_in_time(own, tmp_path):
    schema = jobs.to_bronze(own.createDataFrame([], jobs.RECORD), "r", AS_OF).schema
    for key in "aba":
        write(own, f"{tmp_path}/in", [(key, "10:00")], AS_OF)
        run(own, late.judged(jobs.bronze_stream(own, f"{tmp_path}/in", schema), forget_ms=1), tmp_path, "forget")
    assert [r["arrival"] for r in own.read.parquet(f"{tmp_path}/forget-out").collect()] == ["accepted"] * 3
