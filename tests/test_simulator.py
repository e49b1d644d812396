"""The simulated source: determinism, physics, skew, batch against stream."""

from datetime import datetime

from pyspark.sql import functions as F

from quarryline.sources.simulator import Delivery, SimulatedTelemetry, Vehicle
from quarryline.sources.lake import Lake
from quarryline.verify import verify


def test_vehicles_are_deterministic_and_physical():
    a, b = (list(Vehicle("V1", 3, datetime(2026, 1, 1)).run(500, 1)) for _ in range(2))
    assert a == b and a != list(Vehicle("V2", 3, datetime(2026, 1, 1)).run(500, 1))
    assert all(x["odometer_km"] <= y["odometer_km"] for x, y in zip(a, a[1:], strict=False))
    assert all(0 <= x["speed"] <= 200 and 0 <= x["fuel_level"] <= 100 and abs(x["latitude"]) <= 90 for x in a)
    assert len({x["event_id"] for x in a}) == 500


def test_batch_source_and_hot_vehicle(spark):
    spark.dataSource.register(SimulatedTelemetry)
    df = spark.read.format("simulated_telemetry").option("vehicles", 3).option("ticks", 20).option("hot", "V9999").option("hot_factor", 5).load()
    counts = {r["vehicle_id"]: r["count"] for r in df.groupBy("vehicle_id").count().collect()}
    assert counts == {"V1000": 20, "V1001": 20, "V1002": 20, "V9999": 100}
    assert df.agg(F.count_distinct("event_id")).first()[0] == 160


def test_verification_of_an_empty_store(spark, tmp_path):
    report = verify(Lake(spark, "empty_lake"))
    assert report and {line.status for line in report} == {"SKIP"}


def test_fuel_rises_only_between_trips_and_parked_vehicles_stand():
    rows = list(Vehicle("V7", 11, datetime(2026, 1, 1)).run(12_000, 1))
    assert all(b["fuel_level"] <= a["fuel_level"] for a, b in zip(rows, rows[1:], strict=False) if a["trip_id"] == b["trip_id"])
    assert any(b["fuel_level"] > a["fuel_level"] for a, b in zip(rows, rows[1:], strict=False)) and sum(r["speed"] == 0 for r in rows) > 100 and len({r["event_id"] for r in rows}) == 12_000


def test_late_readings_are_held_back_and_released_in_order():
    delivery = Delivery(duplicates=0.1, late=0.2)
    rows = list(Vehicle("V7", 11, datetime(2026, 1, 1)).run(3_000, 1))
    sent = [(n, r) for n, made in enumerate(rows) for r in delivery.pass_on(made)]
    held = len(delivery.waiting)
    sent += [(len(rows), r) for r in delivery.flush()]
    assert held and not delivery.waiting and {r["event_id"] for _, r in sent} == {r["event_id"] for r in rows}
    assert delivery.counts["clean"] == 3_000 and delivery.counts["produced"] == len(sent) == 3_000 + delivery.counts["duplicates"]
    waits = [(rows[n]["event_time"] - r["event_time"]).total_seconds() for n, r in sent if n < len(rows) and rows[n] is not r]
    assert 400 < delivery.counts["late"] < 800 and min(w for w in waits if w) >= 300 and max(waits) <= 1_206
