"""The catalog's databases and tables, dimension seeds, and views of a lake."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from quarryline.contract import RECONCILIATION, bronze_ddl, create_table_sql, ddl, silver_ddl
from quarryline.sources.lake import Lake

#: Columns of the dimensions.
DIMENSIONS = {
    "dim_vehicle": "vehicle_id string, vehicle_type string, manufacturer string, model string, region string, fleet_owner string, max_speed_kmh double, fuel_capacity_l double, consumption_l_per_100km double, overheat_threshold_c double, has_faulty_cooling boolean",
    "dim_driver": "driver_id string, driver_name string, driver_category string, license_type string, aggression_index double",
    "dim_route": "route_id string, route_name string, distance_km double, waypoint_count int, origin_latitude double, origin_longitude double, destination_latitude double, destination_longitude double",
}


def tables() -> dict[str, tuple[str, str]]:
    """Columns and partition column of each table."""
    quarantine = "quarantine_id string, event_id string, vehicle_id string, event_time timestamp, rule_name string, rule_severity string, failure_reason string, raw_payload string, quarantined_at timestamp, run_id string, event_date date"
    return {
        "bronze_telemetry": (f"{bronze_ddl()}, event_date date", "event_date"),
        "silver_telemetry": (f"{silver_ddl()}, event_date date", "event_date"),
        "quarantine": (quarantine, "event_date"),
        "reconciliation": (ddl(RECONCILIATION), "stage"),
    }


def bootstrap(spark: SparkSession, database: str) -> list[str]:
    """Creates the database and its tables where they lack, proves that a row comes back, and lists the tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (columns, partition) in tables().items():
        spark.sql(create_table_sql(f"{database}.{name}", columns, partition))
    probe = f"{database}._probe"
    spark.sql(f"DROP TABLE IF EXISTS {probe}")
    spark.sql(f"CREATE TABLE {probe} (n INT) USING parquet")
    try:
        spark.sql(f"INSERT INTO {probe} VALUES (1)")
        if [r["n"] for r in spark.table(probe).collect()] != [1]:
            raise RuntimeError(f"{database}: a written row didn't come back")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {probe}")
    return listed(spark, database)


def listed(spark: SparkSession, database: str) -> list[str]:
    return sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect() if not r["isTemporary"])


def seed_dimensions(lake: Lake, rows: dict[str, list[tuple]]) -> dict[str, int]:
    """Replaces each dimension by its rows, typed by its DDL; the number of rows of each."""
    unknown = rows.keys() - DIMENSIONS.keys()
    if unknown:
        raise ValueError(f"no such dimensions: {sorted(unknown)}")
    for name, own in rows.items():
        lake.overwrite(name, lake.spark.createDataFrame(own, DIMENSIONS[name]))
    return {name: len(own) for name, own in rows.items()}


@contextmanager
def views(lake: Lake, names: list[str] | None = None, prefix: str = "") -> Iterator[list[str]]:
    """Temporary views of a lake's tables for SQL, dropped at the end."""
    made = []
    try:
        for name in names or lake.tables():
            lake.read(name).createOrReplaceTempView(f"{prefix}{name}")
            made.append(f"{prefix}{name}")
        yield made
    finally:
        for name in made:
            lake.spark.catalog.dropTempView(name)
