"""Progress of streaming queries as rows, and what the health panels and alerts read from them."""

from __future__ import annotations

import json
import queue
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from quarryline.sources.lake import Lake

PROGRESS = "query string, batch_id long, at timestamp, input_rows long, input_per_second double, processed_per_second double, batch_ms long, state_rows long, dropped_late long, behind long"
#: The condition of each alert and for how many minutes it must hold; the lag's skew.
ALERTS = {
    "lag grows": ("lag_per_second > 0", 10),
    "high lag": ("behind > 500000", 15),
    "nothing arrives": ("input_rows = 0", 10),
    "slow batches": ("batch_ms > 30000", 10),
    "late rows dropped": ("dropped_late > 0", 0),
}
SKEW = 5.0


def progress_row(progress: dict) -> tuple:
    """One row of PROGRESS from a query's progress report. behind: records of the source that wait, where it tells."""
    states = progress.get("stateOperators") or []
    behind = [int(float(s["metrics"][k])) for s in progress.get("sources") or [] for k in ("maxOffsetsBehindLatest", "numFilesOutstanding") if k in (s.get("metrics") or {})]
    number = lambda x: float(x) if x is not None and x == x else 0.0
    return (
        progress.get("name") or str(progress.get("id")), int(progress["batchId"]), datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")), int(progress.get("numInputRows") or 0), number(progress.get("inputRowsPerSecond")), number(progress.get("processedRowsPerSecond")),
        int((progress.get("durationMs") or {}).get("triggerExecution", 0)), sum(int(s.get("numRowsTotal", 0)) for s in states), sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in states), sum(behind),
    )


class ProgressLog(StreamingQueryListener):
    """Appends the progress of all queries to a table of the lake, from a thread of its own: `listening` starts and ends it.

    Progress waits in a queue of at most `most` rows, so a table that can't be written doesn't hold up the queries; what
    finds the queue full is counted in `lost`, and rows whose append failed are tried again with the next ones. Rows that
    were written outlive the driver; a restarted one goes on with the same table.
    """

    TABLE = "stream_progress"

    def __init__(self, lake: Lake, most: int = 10_000, every_seconds: float = 60.0):
        self.lake, self.every = lake, every_seconds
        self.waiting: queue.Queue[tuple] = queue.Queue(most)
        self.failed: list[tuple] = []
        self.lost = 0
        self.ended = threading.Event()
        self.thread = threading.Thread(target=self._work, name="progress-log", daemon=True)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        try:
            self.waiting.put_nowait(progress_row(json.loads(event.progress.json)))
        except queue.Full:
            self.lost += 1

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def _work(self) -> None:
        while not self.ended.wait(self.every):
            self.flush()

    def flush(self) -> int:
        """Appends what waits; the number of rows. A row goes to the day that it is of."""
        rows, self.failed = self.failed, []
        while len(rows) < self.waiting.maxsize + 1 and not self.waiting.empty():
            rows.append(self.waiting.get_nowait())
        if not rows:
            return 0
        try:
            self.lake.append(self.TABLE, self.lake.spark.createDataFrame(rows, PROGRESS).withColumn("day", F.to_date("at")).coalesce(1), "day")
        except Exception:  # noqa: BLE001  the queries go on; the rows are kept for the next time, as many as the queue holds
            self.failed = rows[-self.waiting.maxsize :]
            self.lost += len(rows) - len(self.failed)
            return 0
        return len(rows)

    @contextmanager
    def listening(self) -> Iterator[ProgressLog]:
        spark = self.lake.spark
        spark.streams.addListener(self)
        self.thread.start()
        try:
            yield self
        finally:
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
            spark.streams.removeListener(self)
            self.ended.set()
            self.thread.join()
            self.flush()


def health(progress: DataFrame) -> DataFrame:
    """Per query: rows, rates, latency, state, late rows, what waits and how fast that grows."""
    by = W.partitionBy("query").orderBy("batch_id")
    seconds = F.unix_micros("at") / 1e6
    change = (F.col("behind") - F.lag("behind").over(by)) / (seconds - F.lag(seconds).over(by))
    last = lambda c: F.max_by(c, "batch_id").alias(c)
    return progress.withColumn("lag_per_second", change).groupBy("query").agg(F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows"), F.avg("input_per_second").alias("input_per_second"), F.avg("processed_per_second").alias("processed_per_second"), F.max("batch_ms").alias("slowest_batch_ms"), last("state_rows"), F.sum("dropped_late").alias("dropped_late"), last("behind"), F.avg("lag_per_second").alias("lag_per_second"))


def alerts(progress: DataFrame) -> DataFrame:
    """query, alert, since, held_minutes of everything that has been out of bounds without a break, up to the last progress of
    its query, for as long as its alert asks."""
    seconds = lambda c: F.unix_micros(c) / 1e6
    by = W.partitionBy("query")
    rate = (F.col("behind") - F.lag("behind").over(by.orderBy("batch_id"))) / (seconds("at") - seconds(F.lag("at").over(by.orderBy("batch_id"))))
    each = F.array(*[F.struct(F.lit(name).alias("alert"), F.lit(minutes).alias("minutes"), F.coalesce(F.expr(condition), F.lit(False)).alias("out")) for name, (condition, minutes) in ALERTS.items()])
    told = progress.withColumn("lag_per_second", rate).select("query", "at", F.inline(each))
    good = F.max(F.when(~F.col("out"), F.col("at"))).over(W.partitionBy("query", "alert"))
    run = told.withColumn("good", good).where("out AND (good IS NULL OR at > good)").groupBy("query", "alert", "minutes").agg(F.min("at").alias("since"), F.max("at").alias("last"))
    held = (seconds("last") - seconds("since")) / 60
    return run.withColumn("held_minutes", held).where(F.col("held_minutes") >= F.col("minutes")).select("query", "alert", "since", "held_minutes")


def partition_lag(offsets: DataFrame, skew: float = SKEW) -> DataFrame:
    """kafka_partition, behind and whether it has `skew` times the mean, from (kafka_partition, latest, committed)."""
    each = offsets.groupBy("kafka_partition").agg(F.sum(F.col("latest") - F.col("committed")).alias("behind"))
    # The window holds a row for each partition of the topic.
    return each.select("kafka_partition", "behind", (F.col("behind") > skew * F.avg("behind").over(W.partitionBy(F.lit(1)))).alias("skewed"))
