"""The merge of updates into a target, as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarryline.operators.enrich import latest_by_key


def merged(target: DataFrame, updates: DataFrame, key: str, *newest_first: str) -> DataFrame:
    """target with rows of equal key replaced and new keys added; of updates with one key, the newest holds."""
    staged = latest_by_key(updates, key, *newest_first).select(target.columns)
    return target.join(staged.select(key), key, "left_anti").select(target.columns).unionByName(staged)
