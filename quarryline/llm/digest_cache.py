"""Token counts through a digest cache.

A text's count is stored under the digest of its normalised content and the digest of the tokenizer version. Documents
are joined to the cache by both digests; of the texts that it lacks, one of each digest is encoded, and the new counts
are appended. Normalisation here is null -> "": a count must not change, so nothing else may.

Nulls: a null text counts as empty (0 bytes, 0 tokens); rows with a null id, repeated rows and ids that stand for
several texts each keep a row of their own. An empty table gives an empty result and leaves the cache as it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_text
from .vocab import tokenizer_path, vocabulary

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"


def tokenizer_digest(name: str, folder: str | None = None) -> str:
    """sha256 of the vocabulary file: a new version of it shares no entry with the old one."""
    with open(tokenizer_path(name, folder), "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _counter(name: str, folder: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary("byte", name, folder)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("content_digest"), pa.array([vocab.count(t) for t in b.column("text").to_pylist()], pa.int64())], ["content_digest", "n_tokens"])

    return run


def token_counts(docs: DataFrame, cache_path: str, tokenizer: str = "byte_bpe_50k.json", tokenizer_dir: str | None = None, max_tokens: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of `docs`; counts that `cache_path` lacks are added to it.

    cache_path is a Parquet folder that all executors share. Two runs at once may append the same digest twice; reading
    takes one of equal entries.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-counts")
    version = tokenizer_digest(tokenizer, tokenizer_dir)
    texts = id_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    digest = F.unhex(F.sha2(F.col("text"), 256))
    keyed = scratch.save(texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest.alias("content_digest")))

    def cache() -> DataFrame:
        jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache_path)
        if not jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
            return spark.createDataFrame([], CACHE_SCHEMA)
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer_digest") == version)

    # One representative id for each digest (a null id sorts before all others); a hot digest shrinks before the shuffle.
    distinct = scratch.save(keyed.groupBy("content_digest").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("rep_id")))
    misses = scratch.save(distinct.join(cache(), "content_digest", "left_anti").select("rep_id", "content_digest"))
    # The text comes along by the unique pair of id and digest: no key holds more than its repeated rows.
    wanted = texts.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("rep_id"), "text").join(misses, "rep_id").where(digest == F.col("content_digest"))
    new = wanted.select("content_digest", "text").mapInArrow(_counter(tokenizer, tokenizer_dir), "content_digest binary, n_tokens long")
    new.groupBy("content_digest").agg(F.min("n_tokens").alias("n_tokens")).select("content_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens").write.mode("append").option("compression", "zstd").parquet(cache_path)
    scratch.drop(misses)
    # Written before it is joined: then the join's own shuffle can split a digest that very many rows share.
    known = scratch.save(cache().join(distinct.hint("merge"), "content_digest", "left_semi").groupBy("content_digest").agg(F.min("n_tokens").alias("n_tokens")))
    return keyed.join(known.hint("merge"), "content_digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > max_tokens).alias("over_limit"))
