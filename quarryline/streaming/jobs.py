"""The streaming jobs: bronze append, silver upserts, incidents. Sources and sinks are passed in.

A Kafka source and sink are used where servers are named, which needs Spark's Kafka connector; files stand in for them
otherwise, with the same columns.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarryline.contract import QUARANTINE_COLUMNS, RECONCILIATION, parse_schema, silver_ddl
from quarryline.functions.columns import quarantine_key, unused
from quarryline.operators.enrich import detect_incidents, enrich, incident_messages, latest_and_copies
from quarryline.rules import Rules, annotate, explain_failures
from quarryline.sources.lake import Lake, staging

WATERMARK = "10 minutes"
#: What a record source must have; the columns of a Kafka source.
RECORD = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def source_options(servers: str, topic: str, starting: str = "earliest", per_trigger: int | None = 200_000, fail_on_loss: bool = True) -> dict[str, str]:
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": str(fail_on_loss).lower()}
    return out | ({"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {})


def live_edge(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Records from now on, for incidents: what a restart misses is history by then."""
    return kafka_records(spark, servers, topic, "latest", None, False)


def checkpoint(root: str, job: str) -> str:
    """The checkpoint folder of a job under the one root."""
    if not job.replace("_", "").isalnum():
        raise ValueError(f"not a job's name: {job!r}")
    return f"{root.rstrip('/')}/checkpoints/{job}"


def kafka_records(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", per_trigger: int | None = 200_000, fail_on_loss: bool = True) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**source_options(servers, topic, starting, per_trigger, fail_on_loss))
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset", "timestamp")


def file_records(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    """Records from JSON lines files with the record columns."""
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def to_bronze(records: DataFrame, run_id: str, ingested_at: datetime | None = None) -> DataFrame:
    """Parsed fields beside the raw payload; nothing is validated or dropped."""
    clock = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    parsed = records.withColumn("parsed", F.from_json("value", parse_schema()))
    return parsed.select("parsed.*", clock.alias("ingestion_time"), F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), F.col("timestamp").alias("kafka_timestamp"), F.col("value").alias("raw_payload"), F.lit(run_id).alias("ingest_run_id"))


def _trigger(writer, interval: str | None):
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def start_bronze(bronze: DataFrame, folder: str, checkpoint: str, interval: str | None = "30 seconds") -> StreamingQuery:
    """Appends to Parquet, partitioned by the day of the event."""
    dated = bronze.withColumn("event_date", F.to_date("event_time"))
    return _trigger(dated.writeStream.format("parquet").partitionBy("event_date").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append"), interval).start()


def bronze_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def deduplicated(bronze: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """One row for each key within the watermark. Later first-time rows are dropped by it and show in the query's
    numRowsDroppedByWatermark; batch_only in start_silver avoids that loss."""
    return bronze.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])


def write_silver_batch(batch: DataFrame, batch_id: int, lake: Lake, run_id: str, rules: Rules | None = None, as_of: datetime | None = None) -> dict[str, int]:
    """Splits, enriches, upserts and accounts for one micro-batch, which is read once: the judged rows are staged, and the
    counters of the ledger are observed while they and the rows of silver are written. Each is a count of its own, duplicates
    too, so rows that are lost or multiplied on the way leave a line that doesn't balance. The last two are observed in the
    stage that writes, where a task that runs again is counted once.

    Every write is by key, so a batch that comes again, under its own number or another, changes rows in place. The ledger
    has one line for each run, stage and batch."""
    spark = batch.sparkSession
    inner = lake.within(spark)
    clock = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    seen, kept = Observation(), Observation()
    with staging(spark) as work:
        judged = work.save(annotate(batch, rules, as_of).observe(seen, F.count(F.lit(1)).alias("source"), F.count_if(~F.col("dq_valid")).alias("rejected")), partition_by="dq_valid")
        counts = seen.get
        if not counts["source"]:
            return {"source": 0, "duplicates": 0, "rejected": 0, "output": 0}
        if counts["rejected"]:
            failed = explain_failures(judged.where("NOT dq_valid"), rules).withColumns({"quarantine_id": quarantine_key("event_id", "rule_name", "raw_payload"), "quarantined_at": clock, "run_id": F.lit(run_id)})
            dated = failed.select(*QUARANTINE_COLUMNS, F.col("ingestion_time").alias("seen_at"), F.to_date("event_time").alias("event_date"))
            inner.upsert("quarantine", dated, "quarantine_id", ("seen_at",), "event_date")
        good = judged.where("dq_valid").drop("dq_failed", "dq_warnings", "dq_valid")
        copies = unused("copies", good)
        rich = enrich(latest_and_copies(good, "event_id", "ingestion_time", "kafka_offset", copies=copies), inner.read("dim_vehicle"), inner.read("dim_driver"))
        columns = [c.split()[0] for c in silver_ddl().split(", ")]
        ready = rich.withColumns({"processed_at": clock, "silver_run_id": F.lit(run_id)}).select(*columns, F.to_date("event_time").alias("event_date"), copies)
        counted = ready.observe(kept, F.count(F.lit(1)).alias("output"), F.coalesce(F.sum(F.col(copies) - 1), F.lit(0)).alias("duplicates"))
        # A reading whose time was corrected moves to its new day: the key alone tells what it replaces.
        inner.replace("silver", counted.drop(copies), "event_id", "event_date")
        out = {"source": counts["source"], "duplicates": kept.get["duplicates"], "rejected": counts["rejected"], "output": kept.get["output"]}
    line = spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit("silver").alias("stage"), F.lit(batch_id).cast("long").alias("batch_id"), *[F.lit(out[k]).cast("long").alias(c) for k, c in (("source", "source_count"), ("duplicates", "duplicate_count"), ("rejected", "rejected_count"), ("output", "output_count"))], clock.alias("recorded_at"))
    if not inner.exists("reconciliation") or not inner.read("reconciliation").where((F.col("run_id") == run_id) & (F.col("stage") == "silver") & (F.col("batch_id") == batch_id)).limit(1).count():
        inner.append("reconciliation", line.select([f.name for f in RECONCILIATION]), "stage")
    return out


def start_silver(bronze: DataFrame, lake: Lake, checkpoint: str, run_id: str, interval: str | None = "60 seconds", batch_only: bool = False, as_of: datetime | None = None) -> StreamingQuery:
    """Upserts each micro-batch. batch_only leaves out the watermark's dedup: the upsert alone removes repeats, with no
    late row lost."""
    source = bronze if batch_only else deduplicated(bronze)
    writer = source.writeStream.foreachBatch(lambda df, n: write_silver_batch(df, n, lake, run_id, as_of=as_of) and None).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def start_incidents(records: DataFrame, target: str, checkpoint: str, interval: str | None = "5 seconds", kafka_servers: str | None = None) -> StreamingQuery:
    """Incident messages, keyed by vehicle: no state, no validation. target: a topic where kafka_servers are given, else a
    folder of JSON lines."""
    parsed = records.select(F.from_json("value", parse_schema()).alias("t")).select("t.*")
    messages = incident_messages(detect_incidents(parsed).withColumn("detected_at", F.current_timestamp()))
    sink, options = sink_of(target, kafka_servers)
    return _trigger(messages.writeStream.format(sink).options(**options).option("checkpointLocation", checkpoint), interval).start()


def sink_of(target: str, kafka_servers: str | None = None) -> tuple[str, dict[str, str]]:
    """Format and options of the incident sink."""
    return ("kafka", {"kafka.bootstrap.servers": kafka_servers, "topic": target}) if kafka_servers else ("json", {"path": target})
