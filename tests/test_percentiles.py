"""Percentiles of routes and distinct counts of days, beyond what a sketch holds exactly."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quarryline.plans.models import Project
from quarryline.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _at(values, percent):
    """quantile_disc in whole numbers."""
    return sorted(values)[-(-len(values) * percent // 100) - 1]


@pytest.fixture(scope="module")
def project(spark):
    """Route a has 30,000 trips of different lengths on one day, b some on two days, c two of which the spread is a tie."""
    many = [("a", date(2024, 1, 1), (i * 7919) % 1_000_003) for i in range(30_000)]
    some = [("b", date(2024, 1, 1 + i % 2), (i * 13) % 400) for i in range(100)]
    rows = [*many, *some, ("c", date(2024, 1, 2), 9940), ("c", date(2024, 1, 2), 24883)]
    trips = spark.createDataFrame(rows, "route_id string, trip_start_date date, duration_seconds long")
    same = {c: F.lit(1.0) for c in ("distance_km", "avg_speed_kmh", "fuel_consumed_l")} | {c: F.lit(0).cast("long") for c in ("overspeed_event_count", "overheating_event_count")}
    trips = trips.withColumns(same | {"is_complete": F.lit(True), "vehicle_id": F.lit("v"), "driver_id": F.lit("d")})
    routes = spark.createDataFrame([(r, f"Route {r}", 100.0, "medium_haul") for r in "abc"], "route_id string, route_name string, planned_distance_km double, haul_type string")
    of = {}
    for route, day, seconds in rows:
        of.setdefault(route, []).append(seconds)
        of.setdefault((route, day), []).append(seconds)
    return Project(spark, SF, sources={"fact_trip": trips, "dim_route": routes}), of


def test_percentiles_of_a_route_are_exact_whatever_the_number_of_trips(project):
    p, of = project
    got = {r["route_id"]: r for r in p["route_performance"].collect()}
    assert set(got) == set("abc")
    for route, r in got.items():
        assert (r["total_trips"], r["median_duration_minutes"], r["p95_duration_minutes"]) == (len(of[route]), round(_at(of[route], 50) / 60, 1), round(_at(of[route], 95) / 60, 1))
    assert got["c"]["duration_spread_minutes"] == 249.1


def test_percentiles_of_a_day_are_exact_whatever_the_number_of_trips(project, monkeypatch):
    p, of = project
    monkeypatch.setattr("quarryline.plans.queries.Project", lambda spark, sf_dir: p)
    got = {(r["route_id"], r["trip_start_date"]): r for r in QUERIES["route_daily"](p.spark, SF).collect()}
    assert set(got) == {k for k in of if isinstance(k, tuple)}
    for k, r in got.items():
        assert (r["trip_count"], r["sketched"], r["sum_seconds"], r["median_seconds"], r["p95_seconds"]) == (len(of[k]), len(of[k]), sum(of[k]), _at(of[k], 50), _at(of[k], 95))


def test_distinct_counts_stay_within_their_bound_where_a_small_sketch_misses_it(spark, monkeypatch):
    """A day's vehicles repeated 60 times with shifted keys: their 80,000 trips are 4.9 % off and more in a sketch of 4,096."""
    day = "2024-01-16"
    users = spark.read.parquet("/root/testdata/sf0.1/events.parquet").where(F.to_date("ts") == day).select("user_id").distinct().crossJoin(spark.range(60))
    vehicle = (F.col("user_id") + F.col("id") * 1500).cast("string")
    readings = users.select(vehicle.alias("vehicle_id"), (F.col("user_id") % 13).cast("string").alias("driver_id"), F.concat_ws("-", vehicle, F.lit(day)).alias("trip_id"), F.lit(day).cast("date").alias("event_date"), F.timestamp_add("MINUTE", (F.col("user_id") % 1440).cast("int"), F.lit(day).cast("timestamp")).alias("event_time"))
    p = Project(spark, SF, sources={"stg_telemetry": readings})
    monkeypatch.setattr("quarryline.plans.queries.Project", lambda spark, sf_dir: p)
    got = QUERIES["distinct_sketches"](spark, SF).first()
    told = p["fleet_distincts"].first()
    assert got["within_error"] and got["n_trips"] == readings.count() and got["n_drivers"] == round(told["drivers"]) == 13
    assert abs(told["trips"] - got["n_trips"]) < 0.02 * got["n_trips"] and told["minutes"] == got["n_minutes"]
