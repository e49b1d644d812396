"""Shared pieces: the shared work folder, written intermediate tables, input normalisation."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings of the queries that write scratch tables. A query's shuffle files go when it ends, as none is run again; and
#: batches between the JVM and its Python workers are bounded by bytes: texts of any length come by the same few megabytes.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Where none is set, a temporary one in local mode, else an error: executors
    that write to their own disks give incomplete tables."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quarryline-")
        spark.sparkContext.setCheckpointDir(found)
        _at_exit(spark, found)
    return found.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _at_exit(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.deleteOnExit(jpath)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, jpath = _file_system(spark, path)
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return path


class Scratch:
    """Intermediate tables as Parquet in the shared folder. They cut lineage and outlive lost executors.

    `save` writes a frame and returns it reread; `drop` removes a table that nothing pending reads; `finish` keeps the
    result alone. What is left goes when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, fresh_dir(spark, name), 0

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        before = {k: self.spark.conf.get(k, None) for k in _WRITING}
        for k, v in _WRITING.items():
            self.spark.conf.set(k, v)
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            fs, jpath = _file_system(self.spark, df._scratch_path)
            fs.delete(jpath, True)

    def finish(self, df: DataFrame) -> DataFrame:
        """df written and reread; all other tables of this scratch are removed."""
        out = self.save(df)
        fs, _ = _file_system(self.spark, self.root)
        for n in range(1, self.n):
            fs.delete(_file_system(self.spark, f"{self.root}/{n}")[1], True)
        return out


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which its worker returns free memory to the system: workers serve one stage after another, and what the
    allocators keep of one would stand beside the next one's."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
            trim(0)

    return wrapped


def deal(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of equal columns together, in as many partitions as shuffles have: few bytes can be much work, so partitions are
    not joined by their size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def free_name(name: str, *frames: DataFrame) -> str:
    """`name`, with as many underscores after it as no column of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as long) and the text: other columns, whatever their names, are not carried along."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
