"""The telemetry contract: one list of fields from which schemas, table DDL and the producers' JSON Schema follow."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import StructType

SCHEMA_VERSION = "1.0"


class Field(NamedTuple):
    name: str
    kind: str
    required: bool
    about: str


#: The names and types of a telemetry record.
TELEMETRY = (
    Field("event_id", "string", True, "deterministic key of the reading"),
    Field("vehicle_id", "string", True, "reporting vehicle"),
    Field("driver_id", "string", True, "driver on duty"),
    Field("trip_id", "string", True, "trip of the reading"),
    Field("route_id", "string", False, "planned route"),
    Field("event_time", "timestamp", True, "when it was measured"),
    Field("latitude", "double", False, "degrees"),
    Field("longitude", "double", False, "degrees"),
    Field("speed", "double", False, "km/h"),
    Field("fuel_level", "double", False, "percent"),
    Field("engine_temperature", "double", False, "degrees Celsius"),
    Field("battery_level", "double", False, "percent"),
    Field("odometer_km", "double", False, "lifetime distance"),
    Field("schema_version", "string", True, "contract version"),
)
PROVENANCE = (
    Field("ingestion_time", "timestamp", True, "when it was ingested"),
    Field("kafka_topic", "string", True, "source topic"),
    Field("kafka_partition", "int", True, "source partition"),
    Field("kafka_offset", "bigint", True, "offset in the partition"),
    Field("kafka_timestamp", "timestamp", False, "broker time"),
    Field("raw_payload", "string", True, "the record as received"),
    Field("ingest_run_id", "string", True, "run that ingested it"),
)
RECONCILIATION = (
    Field("run_id", "string", True, "run"),
    Field("stage", "string", True, "stage"),
    Field("batch_id", "bigint", True, "micro-batch"),
    Field("source_count", "bigint", True, "rows read"),
    Field("duplicate_count", "bigint", True, "rows dropped as repeats"),
    Field("rejected_count", "bigint", True, "rows quarantined"),
    Field("output_count", "bigint", True, "rows written"),
    Field("recorded_at", "timestamp", True, "when it was recorded"),
)
QUARANTINE_COLUMNS = ("quarantine_id", "event_id", "vehicle_id", "event_time", "rule_name", "rule_severity", "failure_reason", "raw_payload", "quarantined_at", "run_id")
SILVER_EXTRA = ("vehicle_type string", "manufacturer string", "model string", "region string", "fleet_owner string", "driver_name string", "driver_category string", "is_overspeed boolean", "is_overheating boolean", "is_low_fuel boolean", "processed_at timestamp", "silver_run_id string")


def ddl(fields: tuple[Field, ...]) -> str:
    return ", ".join(f"{f.name} {f.kind}" for f in fields)


def parse_schema() -> StructType:
    """All fields nullable: a record that breaks the contract must survive parsing to be quarantined."""
    return StructType.fromDDL(ddl(TELEMETRY))


def bronze_ddl() -> str:
    return ddl(TELEMETRY + PROVENANCE)


def silver_ddl() -> str:
    kept = TELEMETRY + tuple(f for f in PROVENANCE if f.name != "raw_payload")
    return ", ".join([ddl(kept), *SILVER_EXTRA])


def create_table_sql(table: str, columns: str, partition_by: str) -> str:
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({partition_by})"


def json_schema() -> dict:
    """JSON Schema (draft 2020-12) of one record."""
    kinds = {"string": "string", "double": "number", "timestamp": "string"}
    properties = {}
    for f in TELEMETRY:
        properties[f.name] = {"type": kinds[f.kind] if f.required else [kinds[f.kind], "null"], "description": f.about}
        if f.kind == "timestamp":
            properties[f.name]["format"] = "date-time"
    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "type": "object", "properties": properties, "required": [f.name for f in TELEMETRY if f.required], "additionalProperties": False}
