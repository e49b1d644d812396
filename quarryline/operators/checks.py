"""Checks as queries: each returns the rows that break it, or the counts that show it holds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions.columns import unused


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """Frames of one row each as one row (joined by a constant, as each has a single row)."""
    one = unused("one", *one_row)
    out = one_row[0].withColumn(one, F.lit(1))
    for df in one_row[1:]:
        out = out.join(df.withColumn(one, F.lit(1)), one)
    return out.drop(one)


def row_conservation(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Distinct records that came in, and those that are in the table, in quarantine or missing."""
    rejected = quarantine.where("rule_severity = 'critical'")
    counts = side_by_side(bronze.agg(F.count_distinct("event_id").alias("records")), silver.agg(F.count("*").alias("stored")), rejected.agg(F.count_distinct(F.coalesce("event_id", "quarantine_id")).alias("rejected")))
    return counts.withColumn("missing", F.col("records") - F.col("stored") - F.col("rejected"))


def leaked(silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Stored rows whose key is in quarantine for a critical rule."""
    bad = quarantine.where("rule_severity = 'critical' AND event_id IS NOT NULL").select("event_id")
    return silver.join(bad, "event_id", "left_semi")


def altered_times(silver: DataFrame, bronze: DataFrame) -> DataFrame:
    first = bronze.groupBy("event_id").agg(F.min("event_time").alias("sent_at"))
    return silver.join(first, "event_id").where("event_time <> sent_at")


def reconciliation_balance(ledger: DataFrame) -> DataFrame:
    uneven = F.col("source_count") - F.col("duplicate_count") - F.col("rejected_count") != F.col("output_count")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return ledger.agg(F.count("*").alias("batches"), F.count_if(uneven).alias("unbalanced"), total("source_count").alias("total_source"), total("rejected_count").alias("total_rejected"), total("output_count").alias("total_output"))


def freshness(df: DataFrame, written: str, happened: str, as_of: datetime, warn_minutes: int = 30, error_minutes: int = 120) -> DataFrame:
    age = F.timestamp_diff("MINUTE", F.max(written), F.lit(as_of).cast("timestamp"))
    out = df.agg(F.max(happened).alias("latest_event"), F.max(written).alias("latest_written"), F.count("*").alias("row_count"), age.alias("age_minutes"))
    return out.withColumn("status", F.when(F.col("age_minutes") > error_minutes, "error").when(F.col("age_minutes") > warn_minutes, "warn").otherwise("fresh"))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child whose key is not null and has no row in parent."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def unexpected(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(~F.col(column).isin(values))


def nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls of each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def partition_skew(df: DataFrame, partition: str, limit: float = 5.0) -> DataFrame:
    """The fullest partition against the mean."""
    sizes = df.groupBy(partition).agg(F.count("*").alias("n"))
    out = sizes.agg(F.max("n").alias("largest"), F.avg("n").alias("mean"))
    return out.withColumns({"skew": F.col("largest") / F.col("mean"), "alert": F.col("largest") > limit * F.col("mean")})
