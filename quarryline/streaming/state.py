"""The state of streaming queries as tables, read from their checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operator, name, store, partitions, first and last batch of each stateful operator of a query."""
    told = spark.read.format("state-metadata").load(checkpoint)
    return told.select(F.col("operatorId").alias("operator"), F.col("operatorName").alias("name"), F.col("stateStoreName").alias("store"), F.col("numPartitions").alias("partitions"), F.col("minBatchId").alias("first_batch"), F.col("maxBatchId").alias("last_batch"))


def entries(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None, variable: str | None = None) -> DataFrame:
    """Keys, values and partition of an operator's state after a batch (the last one, where none is named)."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    for name, value in (("batchId", batch), ("stateVarName", variable)):
        if value is not None:
            reader = reader.option(name, value)
    return reader.load(checkpoint)


def sizes(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None, variable: str | None = None) -> DataFrame:
    """How many keys each partition of an operator's state holds: uneven ones show hot keys or stale state."""
    return entries(spark, checkpoint, operator, batch, variable).groupBy("partition_id").agg(F.count("*").alias("keys"))
