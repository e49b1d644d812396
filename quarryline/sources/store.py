"""A versioned table store on plain Parquet: append, overwrite, idempotent upsert, compaction, expiry, orphan removal.

A table is a folder of data files and of commits. A commit is a small JSON file, named by its number, that lists the data
folders of each partition; the newest commit is the table. A commit file is written under a temporary name and then given its
own, in one step that fails where the name exists, so one of two writers of the same number loses and nothing is half visible:
by a hard link on local disks, by a rename without overwriting elsewhere. HDFS does that in one step; object stores don't, so
there a table may have one writer only. Readers take the files of one commit, in one scan. All paths go through Hadoop's file
systems.

Upserts rewrite only the partitions that hold a touched key or receive a new row; others keep their folders. Where the key
fixes the partition (`pruned`), only the partitions of the updates are read; else the keys of the whole table are.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarryline.operators.enrich import latest_by_key


class CommitConflict(RuntimeError):
    """Another writer made the same commit."""


@dataclass
class Commit:
    number: int
    schema: str
    folders: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    at: float = 0.0


def _schema(commit: Commit) -> StructType:
    return StructType.fromJson(json.loads(commit.schema))


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # files

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _list(self, name: str) -> list:
        path, fs = self._path(name)
        return list(fs.listStatus(path)) if fs.exists(path) else []

    def _read(self, name: str) -> str:
        path, fs = self._path(name)
        stream = fs.open(path)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> None:
        temporary, fs = self._path(f"{name}.{uuid.uuid4().hex}.tmp")
        out = fs.create(temporary, False)
        out.write(bytearray(text, "utf-8"))
        out.close()
        target, _ = self._path(name)
        jvm = self.spark.sparkContext._jvm
        try:
            if fs.getUri().getScheme() == "file":
                paths = jvm.java.nio.file.Paths
                jvm.java.nio.file.Files.createLink(paths.get(target.toUri().getPath(), self._names()), paths.get(temporary.toUri().getPath(), self._names()))
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
                context.rename(temporary, target, self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Exception as error:
            if fs.exists(target):
                raise CommitConflict(name) from error
            raise
        finally:
            fs.delete(temporary, False)

    def _names(self):
        return self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.java.lang.String, 0)

    def _delete(self, name: str) -> None:
        path, fs = self._path(name)
        fs.delete(path, True)

    # commits

    def commits(self, table: str) -> list[int]:
        names = [s.getPath().getName() for s in self._list(f"{self.root}/{table}/_commits")]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def commit(self, table: str, number: int | None = None) -> Commit | None:
        known = self.commits(table)
        if not known:
            return None
        return Commit(**json.loads(self._read(f"{self.root}/{table}/_commits/{known[-1] if number is None else number:012d}.json")))

    def _save(self, table: str, made: Commit) -> Commit:
        made.at = time.time()
        self._create(f"{self.root}/{table}/_commits/{made.number:012d}.json", json.dumps(made.__dict__))
        return made

    def _write(self, table: str, df: DataFrame, partition_by: str | None) -> dict[str, list[str]]:
        """Data folders of df by partition value."""
        folder = f"data/load={uuid.uuid4().hex}"  # a partition of its own, so that all loads are one scan
        writer = df.write.option("compression", "zstd")
        if partition_by is None:
            writer.parquet(f"{self.root}/{table}/{folder}")
            return {"": [folder]}
        writer.partitionBy(partition_by).parquet(f"{self.root}/{table}/{folder}")
        names = [s.getPath().getName() for s in self._list(f"{self.root}/{table}/{folder}")]
        return {n: [f"{folder}/{n}"] for n in names if n.startswith(f"{partition_by}=")}

    # reading

    def exists(self, table: str) -> bool:
        return bool(self.commits(table))

    def read(self, table: str, number: int | None = None, partitions: list[str] | None = None) -> DataFrame:
        """The table, or some of its partitions (`column=value`), as of a commit."""
        found = self.commit(table, number)
        if found is None:
            raise ValueError(f"no table {table}")
        schema = _schema(found)
        frames = []
        for partition, folders in sorted(found.folders.items()):
            if partitions is None or partition in partitions:
                frames += [f"{self.root}/{table}/{f}" for f in folders]
        if not frames:
            return self.spark.createDataFrame([], schema)
        # The names of folders are data: `load` is found as a partition column beside the table's own and not selected.
        out = self.spark.read.option("basePath", f"{self.root}/{table}/data").schema(schema).parquet(*frames)
        return out.select(schema.fieldNames())

    # writing

    def overwrite(self, table: str, df: DataFrame, partition_by: str | None = None) -> Commit:
        """Replaces the table's rows and schema. Batches that were committed stay known, so a replay of one is skipped."""
        now = self.commit(table) or Commit(0, "")
        return self._save(table, Commit(now.number + 1, df.schema.json(), self._write(table, df, partition_by), now.batches))

    def append(self, table: str, df: DataFrame, partition_by: str | None = None, batch: tuple[str, int] | None = None) -> Commit:
        now = self.commit(table)
        if now is None:
            now = Commit(0, df.schema.json())
        if batch and now.batches.get(batch[0], -1) >= batch[1]:
            return now
        folders = {k: list(v) for k, v in now.folders.items()}
        for k, v in self._write(table, df.select(_schema(now).fieldNames()), partition_by).items():
            folders.setdefault(k, []).extend(v)
        return self._save(table, Commit(now.number + 1, now.schema, folders, now.batches | ({batch[0]: batch[1]} if batch else {})))

    def upsert(self, table: str, updates: DataFrame, key: str, newest_first: tuple[str, ...], partition_by: str | None = None, batch: tuple[str, int] | None = None, pruned: bool = False) -> Commit:
        """Rows of updates replace rows of equal key, wherever those are, and new keys are added. A batch that was
        committed before is skipped, so a replay changes nothing. pruned declares that rows of equal key have equal
        partitions, so that no other partition need be searched for them."""
        now = self.commit(table)
        if now is None:
            now = Commit(0, updates.schema.json())
        if batch and now.batches.get(batch[0], -1) >= batch[1]:
            return now
        columns = _schema(now).fieldNames()
        staged = latest_by_key(updates, key, *newest_first).select(columns).persist()
        try:
            if partition_by is None:
                touched = [""] if now.folders else []
            else:
                value = F.coalesce(F.col(partition_by).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
                held = self.read(table, now.number).join(staged.select(key), key, "left_semi") if now.folders and not pruned else staged.limit(0)
                names = held.select(value.alias("v")).union(staged.select(value.alias("v"))).distinct().collect()
                touched = [f"{partition_by}={r['v']}" for r in names]
            old = [t for t in touched if t in now.folders]
            rest = self.read(table, now.number, old).join(staged.select(key), key, "left_anti") if old else None
            written = self._write(table, rest.unionByName(staged) if rest is not None else staged, partition_by)
        finally:
            staged.unpersist()
        folders = {k: v for k, v in now.folders.items() if k not in touched} | written
        return self._save(table, Commit(now.number + 1, now.schema, folders, now.batches | ({batch[0]: batch[1]} if batch else {})))

    # maintenance

    def files(self, table: str, number: int | None = None) -> list[tuple[str, int, int]]:
        """(partition, files, bytes) of a commit."""
        found = self.commit(table, number)
        out = []
        for partition, folders in sorted((found.folders if found else {}).items()):
            sizes = [s.getLen() for f in folders for s in self._list(f"{self.root}/{table}/{f}") if s.getPath().getName().endswith(".parquet")]
            out.append((partition, len(sizes), sum(sizes)))
        return out

    def compact(self, table: str, target_bytes: int = 128 << 20, min_files: int = 5) -> tuple[int, int]:
        """Rewrites partitions of many small files; (files before, files after) of those rewritten."""
        now = self.commit(table)
        small = [(p, n, size) for p, n, size in self.files(table) if n >= min_files and size / max(n, 1) < target_bytes]
        if not now or not small:
            return 0, 0
        folders = dict(now.folders)
        before = sum(n for _, n, _ in small)
        after = 0
        for partition, _, size in small:
            parts = max(1, round(size / target_bytes))
            column = partition.split("=")[0] if partition else None
            rewritten = self._write(table, self.read(table, now.number, [partition]).coalesce(parts), column)
            folders[partition] = rewritten[partition]
            after += sum(s.getPath().getName().endswith(".parquet") for f in rewritten[partition] for s in self._list(f"{self.root}/{table}/{f}"))
        self._save(table, Commit(now.number + 1, now.schema, folders, now.batches))
        return before, after

    def expire(self, table: str, older_than_hours: float = 72, keep_last: int = 5) -> int:
        """Drops commits that are old and not among the last; their data goes with remove_orphans."""
        limit = time.time() - older_than_hours * 3600
        gone = [n for n in self.commits(table)[:-keep_last] if self.commit(table, n).at < limit]
        for n in gone:
            self._delete(f"{self.root}/{table}/_commits/{n:012d}.json")
        return len(gone)

    def remove_orphans(self, table: str, older_than_hours: float = 24) -> int:
        """Deletes data folders that no commit names and that are old enough not to belong to a running write."""
        used = {f.split("/")[1] for n in self.commits(table) for folders in self.commit(table, n).folders.values() for f in folders}
        limit = (time.time() - older_than_hours * 3600) * 1000
        gone = 0
        for status in self._list(f"{self.root}/{table}/data"):
            name = status.getPath().getName()
            if name not in used and status.getModificationTime() < limit:
                self._delete(f"{self.root}/{table}/data/{name}")
                gone += 1
        return gone

    def tables(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self._list(self.root) if self.exists(s.getPath().getName()))


def maintain(store: TableStore, tables: list[str] | None = None, target_bytes: int = 128 << 20, snapshot_hours: float = 72, orphan_hours: float = 24, skip: tuple[str, ...] = ()) -> dict[str, dict]:
    """Compaction, then expiry, then orphans, table by table; an error of one table stops only that table."""
    out: dict[str, dict] = {}
    for table in tables or store.tables():
        result: dict = {}
        try:
            if "compact" not in skip:
                result["compacted"] = store.compact(table, target_bytes)
            if "expire" not in skip:
                result["expired"] = store.expire(table, snapshot_hours)
            if "orphans" not in skip:
                result["orphans"] = store.remove_orphans(table, orphan_hours)
        except Exception as error:  # noqa: BLE001  the other tables still get their turn; the caller sees which failed
            result["error"] = repr(error)
        out[table] = result
    return out
