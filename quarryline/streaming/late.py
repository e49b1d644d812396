"""Deduplication with an explicit output for late readings.

A watermark dedup drops what comes in late. Here every reading of a stream is judged by its key's state and the watermark of
the query: the first of a key is accepted, or late where its time lies below the watermark, and every other one is repeated.
All are passed on with their judgement, so accepted + late + repeated = input, and what to do with late ones is the caller's
choice. State and watermark are part of the checkpoint, so a batch that runs again after a restart is judged alike.

The timeout counts processing time: under an event-time timeout Spark would drop late rows before they are judged. With it
Spark asks for another batch forever: a job that ends (availableNow) must set
spark.sql.streaming.noDataMicroBatches.enabled to false.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

ARRIVAL = "arrival"
ACCEPTED, LATE, REPEATED = "accepted", "late", "repeated"


def judged(readings: DataFrame, key: str = "event_id", time: str = "event_time", delay: str = "10 minutes", forget_ms: int = 86_400_000, order: tuple[str, ...] = ("ingestion_time", "kafka_offset")) -> DataFrame:
    """`readings` with the column arrival: accepted, late or repeated.

    A key's state, one flag, is kept for forget_ms of processing time after the key was last seen, and goes with the next
    batch that lacks the key, so the state is bounded; a key that comes again after that counts as new. Of readings of one key in one batch the first by `order` comes first.
    """
    columns = readings.columns

    def judge(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        group = pd.concat(list(frames), ignore_index=True).sort_values(list(order), kind="stable", na_position="last")
        group[ARRIVAL] = REPEATED
        if not state.exists:
            # The watermark counts in milliseconds; none has passed while it is 0.
            is_late = int(group[time].iloc[0].timestamp() * 1000) < state.getCurrentWatermarkMs()
            group.iloc[0, group.columns.get_loc(ARRIVAL)] = LATE if is_late else ACCEPTED
        state.update((True,))
        state.setTimeoutDuration(forget_ms)
        yield group[[*columns, ARRIVAL]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in readings.schema) + f", {ARRIVAL} string"
    return readings.withWatermark(time, delay).groupBy(key).applyInPandasWithState(judge, schema, "flag boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)
