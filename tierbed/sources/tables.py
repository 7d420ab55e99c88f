"""Parquet layer: partitioned tables and run-scoped tables."""

from __future__ import annotations

import json
from collections.abc import Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierbed.functions.runs import new_run_id, run_path
from tierbed.sources import control

# Fixed value: the pointer's name, which Spark takes for a hidden file.
POINTER = "_published.json"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds ``path``; lists the path, reads no data."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def gather_partitions(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Bring rows of a partition value together, so a directory gets few files.

    Spark merges small shuffle partitions and splits large ones by their bytes
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so a value that holds much of the
    table is written by many tasks. Needs adaptive execution, as Spark has it by default.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_cols])


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    overwrite: str = "static",
    max_records_per_file: int = 0,
    sort_cols: Sequence[str] = (),
) -> None:
    """Overwrite a Parquet table partitioned by ``partition_cols``.

    ``static`` replaces the whole table, ``dynamic`` only the partitions in ``df``.
    Rows are sorted by ``sort_cols`` within each directory's files, which lets scans skip.
    """
    gathered = gather_partitions(df, partition_cols)
    if sort_cols:
        gathered = gathered.sortWithinPartitions(*partition_cols, *sort_cols)
    (
        gathered.write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def scan_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """Read a Parquet table with its partition columns as strings.

    Partition discovery would turn the directory name ``007`` into the number 7.
    A declared ``schema`` avoids that. Without one, types come from the files, and
    the ``partition_cols`` that lost their string type are declared as strings.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    found = spark.read.parquet(path)
    fields = [
        StructField(f.name, StringType(), True) if f.name in partition_cols else f
        for f in found.schema
    ]
    declared = StructType(fields)
    return found if declared == found.schema else spark.read.schema(declared).parquet(path)


def publish_table(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    sort_cols: Sequence[str] = (),
    note: dict | None = None,
    max_records_per_file: int = 0,
) -> str:
    """Replace a partitioned table: write it beside the published one, then point to it.

    Until the pointer is renamed into place, and if the write fails, readers of ``table_path`` have
    the earlier table whole. It is kept until the next publication, for those who still read it.
    ``note`` is kept with the pointer. Returns the new table's directory.
    """
    spark = df.sparkSession
    version = f"v-{new_run_id()}-{uuid4().hex[:12]}"
    write_partitioned(
        df, f"{path}/{version}", partition_cols, max_records_per_file=max_records_per_file, sort_cols=sort_cols
    )
    before = published(spark, path)
    pointer = {"version": version, "schema": df.schema.jsonValue(), "note": note or {}}
    control.replace_text(spark, f"{path}/{POINTER}", json.dumps(pointer))
    kept = {version, before["version"] if before else None}
    for name in control.names(spark, path):
        if name not in kept:
            control.remove(spark, f"{path}/{name}")
    return f"{path}/{version}"


def published(spark: SparkSession, path: str) -> dict | None:
    """What the pointer of a table says: ``version``, ``schema`` and ``note``."""
    text = control.read_text(spark, f"{path}/{POINTER}")
    return json.loads(text) if text else None


def table_path(spark: SparkSession, path: str) -> str:
    """Where the published table lies; ``path`` itself for a table written there without a pointer."""
    found = published(spark, path)
    return f"{path}/{found['version']}" if found else path


def write_run(df: DataFrame, prefix: str, run_id: str) -> str:
    """Write one run of a table; other runs under ``prefix`` stay as they are."""
    path = run_path(prefix, run_id)
    df.write.mode("overwrite").parquet(path)
    return path


def scan_runs(spark: SparkSession, prefix: str, schema: StructType | None = None) -> DataFrame:
    """All runs under ``prefix``, with the directory's ``run_id`` as a string column."""
    return scan_table(spark, prefix, schema, partition_cols=("run_id",))
