"""Durable intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tierbed.sources.control import remove

# Spark's setting for shuffle files to be removed when the query that wrote them ends; otherwise they stay
# until the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``.

    Only a session in local mode may go without that setting; elsewhere executors would
    write to disks of their own, so its absence is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tierbed-")
    return f"{shared.rstrip('/')}/{label}-{uuid4().hex}"


def saved(df: DataFrame, label: str, paths: list[str] | None = None, tidy: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again; cuts its lineage durably. ``paths``
    takes up the folder, for :func:`freed`; ``tidy`` removes the write's shuffle files at its end."""
    spark = df.sparkSession
    path = scratch(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true" if tidy else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession, paths: list[str]) -> None:
    """Removes saved tables once all that was made from them is itself saved, so that a lost executor
    never asks for them again."""
    for path in paths:
        remove(spark, path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fan_out(spark: SparkSession) -> int:
    """Number of partitions for shuffles that need an explicit one."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
