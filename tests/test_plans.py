"""Physical plans that the operators rely on at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tierbed.operators import (
    commit_runs,
    committed_rows,
    contiguous_prefix,
    entity_counts,
    prefix_totals,
    quality_report,
    read_registry,
    run_slice,
)

from tierbed.plans.pipeline import open_silver
from tierbed.plans.places import SILVER_PARTITIONS, SILVER_SORT
from tierbed.sources import (
    FilePages,
    scan_runs,
    stage_ranges,
    write_page_files,
    write_partitioned,
)

SCHEMA = "id string, brewery_type string, city string, page bigint, ingestion_run_id string, note string"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(str(i), "micro", f"c{i % 3}", i % 4 + 1, "R1", "x") for i in range(40)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def test_gold_reads_only_its_columns(table):
    text = plan(entity_counts(run_slice(table, "R1"), ("city", "brewery_type")))
    assert "ReadSchema: struct<id:string,brewery_type:string,city:string,ingestion_run_id:string>" in text
    assert "EqualTo(ingestion_run_id,R1)" in text


def test_gold_deduplicates_before_its_first_shuffle(table):
    text = plan(entity_counts(table, ("city",), ordered=False))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 2
    assert tree.rstrip().splitlines()[-2:][0].strip().startswith("+- HashAggregate")


def test_report_scans_once(table):
    text = plan(quality_report(table, "R1"))
    assert text.split("\n\n")[0].count("Scan parquet") == 1
    assert "ReadSchema: struct<id:string,ingestion_run_id:string>" in text


def test_prefix_does_not_shuffle_or_order_rows(table):
    text = plan(contiguous_prefix(table))
    main = text.split("===== Subqueries")[0]
    assert "Exchange" not in main and "Join" not in main
    assert "Window" not in text and "Sort" not in text
    # The pages are read alone to find the gap.
    assert "ReadSchema: struct<page:bigint>" in text


def test_committed_rows_join(spark, table, root):
    commit_runs(spark.createDataFrame([("R1", 1)], "run_id string, fetched_rows bigint"), root)
    rows = table.withColumn("run_id", F.col("ingestion_run_id"))
    assert "BroadcastHashJoin LeftSemi" in plan(committed_rows(rows, read_registry(spark, root)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin LeftSemi" in plan(committed_rows(rows, read_registry(spark, root)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_committed_rows_prune_run_directories(spark, root):
    runs = [f"R{i}" for i in range(6)]
    df = spark.createDataFrame([(i, r) for r in runs for i in range(20)], "id int, run_id string")
    write_partitioned(df, f"{root}/by-run", ("run_id",))
    commit_runs(spark.createDataFrame([("R1", 1), ("R4", 0)], "run_id string, fetched_rows bigint"), root)
    rows = committed_rows(scan_runs(spark, f"{root}/by-run", df.schema), read_registry(spark, root))
    assert "dynamicpruning" in plan(rows)
    assert {(r.run_id, r["count"]) for r in rows.groupBy("run_id").count().collect()} == {("R1", 20), ("R4", 20)}


def test_totals_do_not_read_records(spark, tmp_path):
    """Gap, totals, gate and sizes need no scan of the staged records."""
    store = str(tmp_path / "pages")
    write_page_files(spark.range(90).selectExpr("id", "id div 10 + 1 as page"), store)
    staged = stage_ranges(spark, FilePages(store), str(tmp_path / "staging"))
    text = plan(prefix_totals(staged.counts, 5))
    assert "/counts/from=1" in text and "/pages/from" not in text and "record:" not in text


def test_run_slice_prunes_silver_directories(spark, root):
    rows = [("1", "A", "US", "CA", "LA", run) for run in ("R1", "R2")]
    columns = "id string, brewery_type string, country string, state_province string, city string"
    df = spark.createDataFrame(rows, f"{columns}, ingestion_run_id string")
    write_partitioned(df, f"{root}/silver", SILVER_PARTITIONS, sort_cols=SILVER_SORT)
    text = plan(run_slice(open_silver(spark, root, df.schema), "R1"))
    assert "PartitionFilters: [isnotnull(ingestion_run_id" in text


def test_empty_run_report_scans_its_table(spark):
    text = plan(entry.dq_report_empty_run(spark, entry.SF_SMOKE))
    assert "Scan parquet" in text and "user_id" in text
