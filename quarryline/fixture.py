"""Telemetry, dimensions and ledgers derived from the bundled star-schema tables, in plain arithmetic.

A reading comes from a row of `events`; vehicles from customers, drivers from suppliers, routes from event types. Re-sent,
late and corrupted records are derived by the event's number, so every derived table is the same in each run.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 1, 31)
RUN_ID = "run-1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as they were sent: the contract's fields, provenance and the raw payload."""
    k = F.get_json_object("props", "$.k").cast("int")
    number, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        number.cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("vehicle_id"),
        (F.col("user_id") % 13).cast("string").alias("driver_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("trip_id"),
        F.col("event_type").alias("route_id"),
        ts.alias("event_time"),
        (F.col("value") % 90.0).alias("latitude"),
        (F.col("value") % 179.0).alias("longitude"),
        (F.col("value") - 2.0).alias("speed"),
        (k * F.lit(1.02)).alias("fuel_level"),
        (F.lit(60.0) + k * F.lit(0.6) + F.col("value") * F.lit(0.2)).alias("engine_temperature"),
        (F.lit(100.0) - k * F.lit(0.9)).alias("battery_level"),
        (number * F.lit(0.05)).alias("odometer_km"),
        F.when(number % 97 == 0, "0.9").otherwise("1.0").alias("schema_version"),
        F.timestamp_add("SECOND", (number % 1800).cast("int"), ts).alias("ingestion_time"),
        F.lit("telemetry").alias("kafka_topic"),
        (F.col("user_id") % 12).cast("int").alias("kafka_partition"),
        number.cast("long").alias("kafka_offset"),
        ts.alias("kafka_timestamp"),
        F.col("props").alias("raw_payload"),
        F.lit(RUN_ID).alias("ingest_run_id"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings and, of every fiftieth, a repeat that arrived a minute later."""
    sent = telemetry(spark, sf_dir)
    again = sent.where(F.col("kafka_offset") % 50 == 0).withColumns({"ingestion_time": F.timestamp_add("SECOND", F.lit(60), "ingestion_time"), "kafka_offset": F.col("kafka_offset") + 1_000_000_000})
    return sent.unionByName(again)


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    key = F.col("c_custkey")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.select(
        key.cast("string").alias("vehicle_id"),
        F.col("c_mktsegment").alias("vehicle_type"),
        F.col("n_name").alias("manufacturer"),
        F.col("c_name").alias("model"),
        F.col("r_name").alias("region"),
        F.concat(F.lit("owner-"), F.col("c_nationkey").cast("string")).alias("fleet_owner"),
        ((key % 7) * F.lit(10.0) + 60.0).alias("max_speed_kmh"),
        ((key % 5) * F.lit(20.0) + 40.0).alias("fuel_capacity_l"),
        ((key % 9) * F.lit(2.5) + 8.0).alias("consumption_l_per_100km"),
        ((key % 3) * F.lit(5.0) + 100.0).alias("overheat_threshold_c"),
        (key % 11 == 0).alias("has_faulty_cooling"),
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    kinds = F.array(F.lit("local"), F.lit("regional"), F.lit("long_distance"))
    return table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("driver_id"),
        F.col("s_name").alias("driver_name"),
        F.element_at(kinds, (F.col("s_nationkey") % 3 + 1).cast("int")).alias("driver_category"),
        F.when(key % 2 == 0, "C").otherwise("CE").alias("license_type"),
        ((key % 10) * F.lit(0.1) + 0.5).alias("aggression_index"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("event_type")
    return table(spark, sf_dir, "events").select("event_type").distinct().select(
        F.col("event_type").alias("route_id"),
        F.concat(F.lit("Route "), F.col("event_type")).alias("route_name"),
        (n * F.lit(45.0) - 160.0).alias("distance_km"),
        (n + 2).cast("int").alias("waypoint_count"),
        (n * F.lit(1.5)).alias("origin_latitude"),
        (n * F.lit(2.5)).alias("origin_longitude"),
        (n * F.lit(3.5)).alias("destination_latitude"),
        (n * F.lit(4.5)).alias("destination_longitude"),
    )


#: The kinds of broken records, each with the rule that it must break.
CORRUPTIONS = {
    "null_vehicle_id": "vehicle_id_not_null",
    "negative_speed": "speed_non_negative",
    "fuel_out_of_range": "fuel_level_range",
    "latitude_out_of_range": "latitude_range",
    "longitude_out_of_range": "longitude_range",
    "battery_out_of_range": "battery_level_range",
    "missing_event_time": "event_time_not_null",
    "absurd_engine_temperature": "engine_temperature_range",
    "unparseable_speed": "speed_type_valid",
}


def corrupt(df: DataFrame, kind: Column) -> DataFrame:
    """df with each row broken in the way that `kind` names, or left alone where it is null."""

    def broken(name: str, value: Column, column: str) -> Column:
        return F.when(kind == name, value).otherwise(F.col(column))

    none = F.lit(None)
    return df.withColumns(
        {
            "vehicle_id": broken("null_vehicle_id", none, "vehicle_id"),
            "speed": F.when(kind == "negative_speed", -1 - F.abs(F.coalesce("speed", F.lit(0.0)))).when(kind == "unparseable_speed", none).otherwise(F.col("speed")),
            "fuel_level": broken("fuel_out_of_range", F.lit(160.0), "fuel_level"),
            "latitude": broken("latitude_out_of_range", F.lit(123.0), "latitude"),
            "longitude": broken("longitude_out_of_range", F.lit(-200.5), "longitude"),
            "battery_level": broken("battery_out_of_range", F.lit(-3.0), "battery_level"),
            "event_time": broken("missing_event_time", none, "event_time"),
            "engine_temperature": broken("absurd_engine_temperature", F.lit(500.0), "engine_temperature"),
            "raw_payload": broken("unparseable_speed", F.lit('{"speed": "fast"}'), "raw_payload"),
        }
    )


def injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound readings, every two hundredth broken; `injection` names the way."""
    sound = telemetry(spark, sf_dir).withColumns({"speed": F.least(F.greatest("speed", F.lit(0.0)), F.lit(190.0)), "fuel_level": F.least("fuel_level", F.lit(99.0)), "engine_temperature": F.least("engine_temperature", F.lit(190.0))})
    kinds = F.array(*[F.lit(k) for k in CORRUPTIONS])
    number = F.col("kafka_offset")
    kind = F.when(number % 200 == 3, F.element_at(kinds, (F.floor(number / 200) % len(CORRUPTIONS) + 1).cast("int")))
    return corrupt(sound.withColumn("injection", kind), F.col("injection"))
