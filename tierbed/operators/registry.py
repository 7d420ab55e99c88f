"""Run registry: a run is committed when its manifest row can be read.

A run that is being written holds a lease, a file that only one writer can create.
"""

from __future__ import annotations

import json
import os
import socket
import time
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tierbed.functions.runs import run_path
from tierbed.sources import control
from tierbed.sources.tables import path_exists

# The manifest's fields, whether pages beyond the cap were left out, and the fields
# that the records have.
MANIFEST_SCHEMA = StructType(
    [
        StructField("run_id", StringType(), True),
        StructField("fetched_rows", LongType(), True),
        StructField("pages_fetched", LongType(), True),
        StructField("per_page", LongType(), True),
        StructField("max_pages", LongType(), True),
        StructField("truncated", BooleanType(), True),
        StructField("started_at_utc", StringType(), True),
        StructField("finished_at_utc", StringType(), True),
        StructField("api_url", StringType(), True),
        StructField("fields", StringType(), True),
    ]
)
MANIFEST_FILE = "manifest.json"
# A lease that is older is taken over: its writer has died without giving it back.
LEASE_SECONDS = 24 * 3600
WRITE_MODES = ("skip", "overwrite", "fail")


def manifests_path(root: str) -> str:
    return f"{root.rstrip('/')}/manifests"


def commit_runs(manifests: DataFrame, root: str) -> None:
    """Commit the runs of ``manifests`` (``run_id``, ``fetched_rows`` and more).

    Replaces earlier manifests of these runs only. Call it last, after the data
    that the manifests describe is written. Each task writes the manifests it has.
    """
    (
        manifests.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("run_id")
        .json(manifests_path(root))
    )


def write_manifest(spark: SparkSession, root: str, manifest: dict) -> None:
    """Commit one run; touches no other run's directory.

    The new manifest takes the place of the old one at once, so that a committed run is never seen
    as uncommitted.
    """
    path = run_path(manifests_path(root), manifest["run_id"])
    row = {f.name: manifest.get(f.name) for f in MANIFEST_SCHEMA if f.name != "run_id"}
    control.replace_text(spark, f"{path}/{MANIFEST_FILE}", json.dumps(row) + "\n")
    for name in control.names(spark, path):
        if name != MANIFEST_FILE:  # from ``commit_runs``
            control.remove(spark, f"{path}/{name}")


def drop_manifest(spark: SparkSession, root: str, run_id: str) -> None:
    """Make a run uncommitted."""
    control.remove(spark, run_path(manifests_path(root), run_id))


class LeaseHeldError(RuntimeError):
    """Another writer is at work on the run."""


@contextmanager
def run_lease(
    spark: SparkSession, root: str, run_id: str, max_seconds: float = LEASE_SECONDS
) -> Iterator[None]:
    """Hold the run against other writers, or raise ``LeaseHeldError`` if one of them holds it.

    The lease is a file that is created only if it is absent. A lease older than ``max_seconds`` is
    that of a dead writer; taking it over is a rename, which only one of several can do.
    """
    path = f"{run_path(f'{root.rstrip("/")}/leases', run_id)}/lease.json"
    own = {"owner": uuid4().hex, "host": socket.gethostname(), "pid": os.getpid()}
    while not control.create_text(spark, path, json.dumps(own | {"since": time.time()})):
        text = control.read_text(spark, path)
        if text is None:  # given back just now
            continue
        # An empty file is a lease whose writer has only just made it.
        since = json.loads(text)["since"] if text else time.time()
        if time.time() - since <= max_seconds:
            raise LeaseHeldError(f"Run is being written by another writer. run_id={run_id} lease={path} {text}")
        stale = f"{path}.{own['owner']}"
        if control.rename(spark, path, stale):
            if control.read_text(spark, stale) != text:  # taken over by another one meanwhile
                control.rename(spark, stale, path)
            else:
                control.remove(spark, stale)
    try:
        yield
    finally:
        if own["owner"] in (control.read_text(spark, path) or ""):
            control.remove(spark, path)


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    """Manifests of all committed runs; empty when nothing was ever committed."""
    try:
        manifests = spark.read.schema(MANIFEST_SCHEMA).json(manifests_path(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        manifests = spark.createDataFrame([], MANIFEST_SCHEMA)
    # A comparison, as a join prunes partitions by a side that is filtered by one.
    return manifests.filter(F.col("fetched_rows") >= 0)


def read_manifest(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """Manifest of one run, read from its directory alone: other runs are not even listed."""
    fields = [f for f in MANIFEST_SCHEMA.fields if f.name != "run_id"]
    try:
        found = spark.read.schema(StructType(fields)).json(run_path(manifests_path(root), run_id))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], StructType(fields))
    committed = found.filter(F.col("fetched_rows").isNotNull())
    return committed.select(F.lit(run_id).alias("run_id"), *[f.name for f in fields])


def require_committed(
    spark: SparkSession, root: str, run_id: str, output: str | None = None
) -> None:
    """Raise when the run has no manifest, or its ``output`` path is gone, so that later steps do
    not start."""
    if output is not None and not path_exists(spark, output):
        raise RuntimeError(
            f"Commit guard failed: output not found. location={output} key=run_id={run_id} "
            "error_code=NO_OUTPUT"
        )
    if read_manifest(spark, root, run_id).isEmpty():
        raise RuntimeError(
            "Commit guard failed: manifest not found. "
            f"location={manifests_path(root)} key=run_id={run_id} error_code=NO_MANIFEST_ROW"
        )


def committed_rows(df: DataFrame, registry: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Rows of ``df`` whose run is in the registry.

    Spark broadcasts the registry if its measured bytes allow, so that ``df`` is not shuffled by a
    column with few, uneven values. A larger registry is joined by shuffle, where AQE splits
    runs that hold much of the table. Where ``run_col`` names the directories of ``df`` and the
    registry is broadcast, directories of other runs are not read at all: Spark prunes them at
    run time by the runs it has found.
    """
    runs = registry.select(F.col("run_id").alias(run_col)).distinct()
    return df.join(runs, run_col, "left_semi")


def rerun_action(committed: bool, output_exists: bool, write_mode: str, run: str) -> str:
    """Decide what an ingest does about earlier output of its run: ``skip`` or ``ingest``."""
    if write_mode not in WRITE_MODES:
        raise ValueError(f"write_mode must be one of {WRITE_MODES}, got {write_mode!r}")
    if write_mode == "fail" and committed:
        raise RuntimeError(f"Run is already committed and write_mode=fail. run={run}")
    if write_mode == "fail" and output_exists:
        raise RuntimeError(f"Run has output but no manifest and write_mode=fail. run={run}")
    return "skip" if committed and write_mode == "skip" else "ingest"
