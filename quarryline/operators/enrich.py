"""Enrichment, deduplication and incident classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarryline.functions.columns import flag, unused

#: The limits of flags and incidents.
OVERHEAT_C = 100.0
CRITICAL_OVERHEAT_C = 115.0
SEVERE_OVERSPEED_KMH = 140.0
LOW_FUEL_PCT = 15.0
STREAM_LOW_FUEL_PCT = 10.0
STREAM_LOW_BATTERY_PCT = 20.0


def enrich(readings: DataFrame, vehicles: DataFrame, drivers: DataFrame, per_vehicle_heat: bool = False) -> DataFrame:
    """Readings with reference data and flags; a reading without its vehicle or driver stays.

    Dimensions are joined as they come: Spark broadcasts one whose size it knows to be small (its own threshold), and
    shuffles both sides otherwise, so a dimension that grows is no hazard.
    """
    heat = ["overheat_threshold_c"] if per_vehicle_heat else []
    dim = vehicles.select("vehicle_id", "vehicle_type", "manufacturer", "model", "region", "fleet_owner", "max_speed_kmh", *heat)
    who = drivers.select("driver_id", "driver_name", "driver_category")
    joined = readings.join(dim, "vehicle_id", "left").join(who, "driver_id", "left")
    limit = F.col("overheat_threshold_c") if per_vehicle_heat else F.lit(OVERHEAT_C)
    speed, temperature, fuel = F.col("speed"), F.col("engine_temperature"), F.col("fuel_level")
    return joined.withColumns(
        {
            "is_overspeed": F.when(speed.isNotNull() & F.col("max_speed_kmh").isNotNull(), speed > F.col("max_speed_kmh")),
            "is_overheating": flag(temperature, temperature > limit),
            "is_low_fuel": flag(fuel, fuel < LOW_FUEL_PCT),
        }
    ).drop("max_speed_kmh", *heat)


def latest_by_key(df: DataFrame, key: str | list[str], *newest_first: str) -> DataFrame:
    """One row for each key: the greatest by the columns named, in order."""
    keys = [key] if isinstance(key, str) else key
    order = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in newest_first])
    rank = unused("rank", df)
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank)


def latest_and_copies(df: DataFrame, key: str, *newest_first: str, copies: str) -> DataFrame:
    """latest_by_key, and in `copies` how many rows its key had. Rows are combined before the shuffle, so a key that repeats
    without end sends one row of each task."""
    row = unused("row", df)
    kept = F.max_by(F.struct(*[c for c in df.columns if c != key]), F.struct(*newest_first)).alias(row)
    counted = df.groupBy(key).agg(kept, F.count("*").alias(copies))
    return counted.select(*[c if c == key else F.col(f"{row}.{c}") for c in df.columns], copies)


def detect_incidents(readings: DataFrame) -> DataFrame:
    """The low-latency classification: readings that breach a limit, by priority."""
    temperature = F.col("engine_temperature")
    kind = (
        F.when(temperature > CRITICAL_OVERHEAT_C, "engine_critical_overheat")
        .when(temperature > OVERHEAT_C, "engine_overheat")
        .when(F.col("speed") > SEVERE_OVERSPEED_KMH, "severe_overspeed")
        .when(F.col("fuel_level") < STREAM_LOW_FUEL_PCT, "low_fuel")
        .when(F.col("battery_level") < STREAM_LOW_BATTERY_PCT, "low_battery")
    )
    found = readings.withColumn("incident_type", kind).where("incident_type IS NOT NULL")
    high = F.col("incident_type").isin("engine_overheat", "severe_overspeed")
    return found.withColumn("severity", F.when(F.col("incident_type") == "engine_critical_overheat", "critical").when(high, "high").otherwise("medium"))


#: Fields of an incident message, in order.
INCIDENT_FIELDS = ("event_id", "vehicle_id", "driver_id", "trip_id", "event_time", "incident_type", "severity", "speed", "engine_temperature", "fuel_level", "battery_level", "latitude", "longitude")


def incident_messages(incidents: DataFrame) -> DataFrame:
    """key and JSON value of each incident, keyed by vehicle; with the time of detection where the frame has it."""
    fields = [c for c in (*INCIDENT_FIELDS, "detected_at") if c in incidents.columns]
    return incidents.select(F.col("vehicle_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))
