"""The corpus pipeline: five stages over documents, each written as Parquet and reread as the next one's input.

quality      documents that the classifier rejects go
near_copies  one document (the smallest id) of each group of near copies stays: five-word shingles, similarity 0.8
benchmark    documents that hold a benchmark item go
private      numbers, dates, addresses and secrets become pseudonyms
packing      the rest is packed into windows of 2048 tokens
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarryline.llm.common import Scratch, documents
from quarryline.llm.decontaminate import keep_clean
from quarryline.llm.gam import fit_quality, keep_good, labelled, text_features
from quarryline.llm.jaccard import keep_one
from quarryline.llm.packing import pack_documents
from quarryline.llm.pseudonyms import pseudonymise
from quarryline.llm.queries import PSEUDONYM_KEY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores under the threshold go; a null text is scored as an empty one. Repeated rows are judged alike."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, fit_quality(text_features(labelled(docs, labels)), labels))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of one id with different texts are different documents; documents without words are no copies and stay."""
    return keep_one(docs, k=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold an item go; null and empty texts hold none and stay."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay; a null text stays null."""
    return pseudonymise(docs, PSEUDONYM_KEY, keep_columns=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row is a document of its own; a null text is empty, its end id alone."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("near_copies", near_copies), ("benchmark", benchmark), ("private", private), ("packing", packing)]

#: No stage but the last decisions could be written in SQL: the classifier and the retrieval are fitted models.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's result is written before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.save(docs)
    return docs
