"""A training corpus from the documents table: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierbed.llm.chosen_path import one_of_each_class
from tierbed.llm.curve_packing import pack_along_curve
from tierbed.llm.fair_mixing import mixed_documents
from tierbed.llm.line_dedup import dedup_documents
from tierbed.llm.quality_rules import kept_documents
from tierbed.llm.storage import scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject, and boilerplate lines from the others.

    Null and empty texts go. Rows alike share a verdict; a very long text is judged whole; other columns stay,
    also those with odd names. No documents give none.
    """
    return kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines from the texts, all but those of the smallest ``doc_id``.

    Every row stays, a text that loses all lines as an empty one; a null text stays null. No documents give
    none.
    """
    return dedup_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies, the smallest ``doc_id``.

    Texts without words are alike, null ones too; rows alike are one class. No documents give none.
    """
    return one_of_each_class(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the sources come near their targets.

    A null source is a source. Every row is a document, also rows alike; ties of finish times go by a
    digest, so reruns agree. No documents give none.
    """
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the documents into sequences of token ids along the space-filling curve.

    A row is a piece with its ids. Null and empty texts have the end id alone; every row is a document of
    its own, also where ids repeat; a long text goes through several sequences. Other columns are left out.
    """
    return pack_along_curve(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("chosen_path", near_copies),
    ("fair_mixing", mix),
    ("curve_packing", pack),
]

# Shingle classes, Hilbert order and token ids are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
