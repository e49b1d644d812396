"""Spark-native telemetry analytics: ingest, rules, models, streaming and maintenance."""
