"""Session settings of the engine."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution re-plans shuffles by their measured size, so the number of partitions is an upper bound.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A commit writes what changed since the last one, and whole snapshots only now and then.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.metricsEnabled": "true",
}


def build_session(name: str = "quarryline", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
