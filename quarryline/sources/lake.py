"""Tables of Spark's catalog, changed by key: Spark's own inserts and dynamic partition overwrites, found through a key index.

Each keyed table is partitioned by a day and has an index table beside it, `<table>__keys`: (key_hash, day) in buckets of the
hash, sorted. A key may have several days in it; the index names every day that may hold the key, so a hash that two keys
share, or an entry whose row has moved on, only costs a day that is read in vain.

`replace` removes all rows of some keys, wherever they are, and adds new ones:

1. the new rows and the keys are written to a staging folder, so that what follows can be repeated;
2. the index tells the keys' days (only the buckets of these keys are read);
3. the new rows' days are added to the index, before any row is;
4. the days that may hold one of the keys are written anew without them (dynamic overwrite of these partitions alone), new
   rows of these days included; a day that is left empty is dropped;
5. new rows of all other days are appended: keys that were never seen rewrite nothing.

If a writer dies in between, the index already names every day that a row may have come to, so the same call again gives the
right rows: it is idempotent. A table may have one writer at a time. While partitions are overwritten a reader may find a day
missing; a catalog with snapshots runs the same statements atomically.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarryline.operators.enrich import latest_by_key


def staging_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; without one a temporary folder, in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quarryline-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Staging:
    """Frames written to a folder and reread; `drop` removes them all."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n = spark, f"{staging_root(spark)}/staging-{uuid.uuid4().hex}", 0

    def save(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        self.n += 1
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{self.root}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{self.n}").select(df.columns)

    def drop(self) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Staging]:
    own = Staging(spark)
    try:
        yield own
    finally:
        own.drop()


def key_hash(key: Column | str) -> Column:
    return F.xxhash64(key)


class Lake:
    """The tables of one database."""

    def __init__(self, spark: SparkSession, database: str, buckets: int = 16, location: str | None = None):
        self.spark, self.database, self.buckets = spark, database, buckets
        # Catalog inserts take the mode from the session alone; one session has one mode, so that threads can share it.
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))

    def within(self, spark: SparkSession) -> Lake:
        """The same tables from another session of the application (that of a micro-batch)."""
        return Lake(spark, self.database, self.buckets)

    def _name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self._name(table))

    def tables(self) -> list[str]:
        names = [r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN {self.database}").collect() if not r["isTemporary"]]
        return sorted(n for n in names if not n.endswith("__keys") and not n.startswith("_"))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self._name(table))

    def partition_of(self, table: str) -> str | None:
        return next((c.name for c in self.spark.catalog.listColumns(self._name(table)) if c.isPartition), None)

    def create(self, table: str, schema: StructType, partition_by: str | None = None) -> None:
        if not self.exists(table):
            writer = self.spark.createDataFrame([], schema).write.format("parquet").option("compression", "zstd")
            (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(self._name(table))

    def append(self, table: str, df: DataFrame, partition_by: str | None = None) -> None:
        self.create(table, df.schema, partition_by)
        df.select(self.read(table).columns).write.mode("append").insertInto(self._name(table))

    def overwrite(self, table: str, df: DataFrame, partition_by: str | None = None, key: str | None = None) -> None:
        """Replaces the table, and its index where a key is named. The rows are staged: they may be read from the table."""
        with staging(self.spark) as work:
            rows = work.save(df)
            for name in (table, f"{table}__keys"):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._name(name)}")
            self.create(table, rows.schema, partition_by)
            if key:
                self._index(table, self._entries(rows, key, partition_by))
                self._set_key(table, key)
            self.append(table, rows)

    def overwrite_partitions(self, table: str, df: DataFrame) -> None:
        """Spark's dynamic overwrite: the partitions that df has rows of."""
        df.select(self.read(table).columns).write.mode("overwrite").insertInto(self._name(table))

    # keyed changes

    def _entries(self, rows: DataFrame, key: str, day: str) -> DataFrame:
        h = key_hash(key)
        return rows.select(h.alias("key_hash"), F.col(day).alias("day"), F.pmod(h, F.lit(self.buckets)).cast("int").alias("bucket")).distinct()

    def _index(self, table: str, entries: DataFrame) -> None:
        self.append(f"{table}__keys", entries.repartition("bucket").sortWithinPartitions("bucket", "key_hash"), "bucket")

    def days_of(self, table: str, keys: DataFrame) -> DataFrame:
        """key_hash, day of everything that may hold a row of `keys` (one column)."""
        hashes = keys.select(key_hash(keys.columns[0]).alias("key_hash")).distinct().withColumn("bucket", F.pmod("key_hash", F.lit(self.buckets)).cast("int"))
        used = [r["bucket"] for r in hashes.select("bucket").distinct().collect()]  # at most `buckets` numbers
        index = self.read(f"{table}__keys").where(F.col("bucket").isin(used))
        return index.join(hashes.select("key_hash"), "key_hash", "left_semi").select("key_hash", "day").distinct()

    def compact_keys(self, table: str) -> None:
        """Writes each bucket of the index anew as one sorted file, entries of days that no longer hold the key left out."""
        key = self._key_of(table)
        day = self.partition_of(table)
        with staging(self.spark) as work:
            live = work.save(self._entries(self.read(table), key, day).repartition("bucket").sortWithinPartitions("bucket", "key_hash"))
            self.overwrite_partitions(f"{table}__keys", live.repartition("bucket").sortWithinPartitions("bucket", "key_hash"))

    def _set_key(self, table: str, key: str) -> None:
        self.spark.sql(f"ALTER TABLE {self._name(table)} SET TBLPROPERTIES ('quarryline.key' = '{key}')")

    def _key_of(self, table: str) -> str:
        return self.spark.sql(f"SHOW TBLPROPERTIES {self._name(table)}('quarryline.key')").first()["value"]

    def replace(self, table: str, rows: DataFrame, key: str, day: str, gone: DataFrame | None = None) -> list[str]:
        """All rows whose key is in `rows` or in `gone` (one column) go, and `rows` come; the days that were written anew. A
        table that isn't there is made. `rows` is evaluated once."""
        if not self.exists(table):
            self.create(table, rows.schema, day)
            self._index(table, self._entries(self.spark.createDataFrame([], rows.schema), key, day))
            self._set_key(table, key)
        with staging(self.spark) as work:
            new = work.save(rows.select(self.read(table).columns))
            keys = new.select(key) if gone is None else work.save(new.select(key).union(gone.select(F.col(gone.columns[0]).alias(key))).distinct())
            known = work.save(self.days_of(table, keys))
            entries = self._entries(new, key, day).alias("e")
            fresh = entries.join(known.alias("k"), (F.col("e.key_hash") == F.col("k.key_hash")) & F.col("e.day").eqNullSafe(F.col("k.day")), "left_anti")
            self._index(table, work.save(fresh))
            days = [r["day"] for r in known.select("day").distinct().collect()]  # calendar days
            here = self._in(day, days)
            if days:
                stay = self.read(table).where(here).join(keys, key, "left_anti").select(new.columns)
                anew = work.save(stay.unionByName(new.where(here)))
                self.overwrite_partitions(table, anew)
                for left in set(days) - {r[day] for r in anew.select(day).distinct().collect()}:
                    self.spark.sql(f"ALTER TABLE {self._name(table)} DROP IF EXISTS PARTITION ({day} = {'NULL' if left is None else repr(str(left))})")
            self.append(table, new.where(~here))
        return sorted(map(str, days))

    @staticmethod
    def _in(day: str, days: list) -> Column:
        some = F.col(day).isin([d for d in days if d is not None])
        return F.coalesce(some, F.lit(False)) | (F.col(day).isNull() & F.lit(None in days))

    def upsert(self, table: str, updates: DataFrame, key: str, newest_first: tuple[str, ...], day: str) -> list[str]:
        """Rows of updates replace rows of equal key, whatever their day; of updates with one key the newest holds."""
        return self.replace(table, latest_by_key(updates, key, *newest_first), key, day)

    # marks

    def mark(self, name: str):
        """The last value that `set_mark` kept under this name."""
        if not self.exists("_marks"):
            return None
        row = self.read("_marks").where(F.col("name") == name).first()
        return row and row["at"]

    def set_mark(self, name: str, at) -> None:
        row = self.spark.createDataFrame([(at, name)], "at timestamp, name string")
        self.create("_marks", row.schema, "name")
        self.overwrite_partitions("_marks", row)
