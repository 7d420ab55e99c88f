"""Ingest, curate, check and aggregate a run, as separate steps and as one flow.

Everything lives under one root: ``staging/``, ``raw/``, ``manifests/``, ``leases/``,
``silver/``, ``quality/``, ``gold/`` and ``steps/``. Each step reads what the step before wrote
and can be repeated, so a lost executor or a failed step never needs a new fetch.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierbed.functions.columns import output_slices
from tierbed.functions.runs import run_path
from tierbed.operators.aggregate import entity_counts
from tierbed.operators.curate import FillRule, curate, stamp_run
from tierbed.operators.pages import prefix_totals
from tierbed.operators.quality import (
    REQUIRED_COLUMNS,
    quality_gate,
    quality_report,
    run_slice,
    write_report,
)
from tierbed.operators.registry import (
    drop_manifest,
    read_manifest,
    require_committed,
    rerun_action,
    run_lease,
    write_manifest,
)
from tierbed.plans.places import (
    GOLD_COUNT,
    GOLD_KEYS,
    PLACE_RULES,
    PLACE_SCHEMA,
    SILVER_PARTITIONS,
    SILVER_SORT,
)
from tierbed.sources import control
from tierbed.sources.paged import PageBackend, place_of, stage_ranges
from tierbed.sources.raw import scan_raw, with_other_fields, write_raw_records
from tierbed.sources.tables import (
    path_exists,
    publish_table,
    published,
    scan_table,
    table_path,
    write_partitioned,
    write_run,
)


def layer(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def ingest(
    spark: SparkSession,
    backend: PageBackend,
    root: str,
    run_id: str,
    *,
    write_mode: str = "skip",
    per_page: int = 200,
    max_pages: int | None = None,
    pages_per_task: int | None = None,
    max_slices: int | None = None,
    rows_per_slice: int = 500,
    api_url: str | None = None,
) -> str:
    """Fetch a run's pages into ``raw/`` and commit it; returns ``skipped`` or ``ingested``.

    Only one writer at a time works on a run; another one gets ``LeaseHeldError``. Pages are
    fetched once, into ``staging/``, range by range. A run that broke while it fetched goes on behind
    the ranges it has, unless ``write_mode`` is ``overwrite``. Gap, totals and the gate against empty
    runs come from one table of rows a page; the staged records are read once, by the raw write, which also
    gathers their fields for the manifest.

    The old manifest goes first and the new one comes last, so a run that breaks in between
    is seen as incomplete and redone, as is one whose raw output is gone. All pages up to the first
    empty one are fetched unless ``max_pages`` says otherwise; the manifest's ``truncated`` tells
    whether that left pages out. Raw files follow the bytes of the staged ones, a file a task. With
    ``max_slices`` there is one file per ``rows_per_slice`` rows, at most so many. ``api_url`` is by
    default the backend's URL or path.
    """
    raw = run_path(layer(root, "raw"), run_id)
    staging = run_path(layer(root, "staging"), run_id)
    with run_lease(spark, root, run_id):
        listed = not read_manifest(spark, root, run_id).isEmpty()
        has_output = path_exists(spark, raw)
        committed = listed and has_output
        action = rerun_action(committed, has_output, write_mode, raw)
        if action == "skip":
            return "skipped"

        started = utc_now()
        if listed:
            drop_manifest(spark, root, run_id)
        staged = stage_ranges(
            spark, backend, staging, per_page, max_pages, pages_per_task, resume=write_mode != "overwrite"
        )
        totals = prefix_totals(staged.counts, max_pages).first()
        if totals.fetched_rows == 0:
            # The next attempt asks again.
            control.remove(spark, staging)
            raise RuntimeError(f"Ingest returned 0 rows, nothing is committed. run_id={run_id}")
        # The prefix is pages 1..n, so the pages counted are its last page.
        kept = staged.records.filter(F.col("page").between(1, totals.pages_fetched))
        slices = max_slices and output_slices(totals.fetched_rows, max_slices, rows_per_slice)
        fields = write_raw_records(kept, raw, slices)

        write_manifest(
            spark,
            root,
            {
                "run_id": run_id,
                "fetched_rows": totals.fetched_rows,
                "pages_fetched": totals.pages_fetched,
                "per_page": per_page,
                "max_pages": max_pages,
                "truncated": totals.truncated,
                "started_at_utc": started,
                "finished_at_utc": utc_now(),
                "api_url": api_url if api_url is not None else place_of(backend),
                "fields": fields.json(),
            },
        )
        # The run is committed; give the staged copy's space back.
        control.remove(spark, staging)
        return "ingested"


def committed_fields(spark: SparkSession, root: str, run_id: str) -> StructType | None:
    """The fields that a committed run's records have, if its manifest tells."""
    row = read_manifest(spark, root, run_id).first()
    return StructType.fromJson(json.loads(row.fields)) if row and row.fields else None


def silver_schema(
    spark: SparkSession, raw_schema: str = PLACE_SCHEMA, rules: Sequence[FillRule] = PLACE_RULES
) -> StructType:
    """Schema that ``curate`` gives to rows of ``raw_schema``; declares silver scans."""
    return curate(spark.createDataFrame([], raw_schema), "", rules).schema


def build_silver(
    spark: SparkSession,
    root: str,
    run_id: str,
    *,
    raw_schema: str | None = PLACE_SCHEMA,
    other_fields: bool = True,
    rules: Sequence[FillRule] = PLACE_RULES,
    partition_cols: Sequence[str] = SILVER_PARTITIONS,
    sort_cols: Sequence[str] = SILVER_SORT,
    overwrite: str = "static",
    note: dict | None = None,
) -> StructType:
    """Curate a run's raw lines into the silver table; returns the table's schema.

    Fields that ``raw_schema`` does not name are kept unless ``other_fields`` is false; the manifest
    knows them, so the raw lines are read once. Without ``raw_schema`` all types are inferred, also
    from the manifest. For a run without a manifest, Spark reads the lines once more.

    The table is written beside the published one and then takes its place (``overwrite`` is
    ``static``), or the run's partitions are replaced in the published one (``dynamic``).
    """
    path, silver = run_path(layer(root, "raw"), run_id), layer(root, "silver")
    schema = raw_schema
    if raw_schema is None or other_fields:
        found = committed_fields(spark, root, run_id)
        schema = found if raw_schema is None else with_other_fields(spark, path, raw_schema, found)
    curated = curate(scan_raw(spark, path, schema), run_id, rules)
    sorted_by = [c for c in sort_cols if c in curated.columns and c not in partition_cols]
    if overwrite == "static" or not path_exists(spark, silver):
        publish_table(curated, silver, partition_cols, sorted_by, {"run_id": run_id, **(note or {})})
    else:
        write_partitioned(curated, table_path(spark, silver), partition_cols, overwrite, sort_cols=sorted_by)
    return curated.schema


def open_silver(
    spark: SparkSession,
    root: str,
    schema: StructType | None = None,
    partition_cols: Sequence[str] = SILVER_PARTITIONS,
) -> DataFrame:
    """The published silver table. Its directories are listed once, when it is opened."""
    return scan_table(spark, table_path(spark, layer(root, "silver")), schema, partition_cols)


def check_silver(
    spark: SparkSession,
    root: str,
    run_id: str,
    *,
    silver: DataFrame | None = None,
    min_rows: int = 1,
    max_null_id_ratio: float = 0.0,
    id_col: str = "id",
    run_col: str = "ingestion_run_id",
    required: Sequence[str] = REQUIRED_COLUMNS,
) -> list[Row]:
    """Write the run's quality report, then raise if a critical check failed.

    Unless ``silver`` is given, the columns are those the files have, so that a
    missing one is seen. A table without a run column is reported as such instead
    of failing on the run filter.
    """
    if silver is None:
        # Only an id or run column that names directories has to be read as a string.
        silver = open_silver(spark, root, partition_cols=(id_col, run_col))
    if run_col in silver.columns:
        silver = run_slice(silver, run_id, run_col)
    report = quality_report(silver, run_id, min_rows, max_null_id_ratio, id_col, run_col, required)

    # At most five rows: collected once for the file, the gate and the caller.
    checks = report.collect()
    target = run_path(layer(root, "quality/silver"), run_id)
    write_report(spark.createDataFrame(checks, report.schema), target)
    quality_gate(checks)
    return checks


def build_gold(
    spark: SparkSession,
    root: str,
    run_id: str,
    *,
    silver: DataFrame | None = None,
    keys: Sequence[str] = GOLD_KEYS,
    id_col: str = "id",
    out: str = GOLD_COUNT,
    partition_cols: Sequence[str] = SILVER_PARTITIONS,
) -> str:
    """Count distinct entities of the run per group into ``gold/``; returns the path."""
    if silver is None:
        silver = open_silver(spark, root, partition_cols=partition_cols)
    counts = entity_counts(run_slice(silver, run_id), keys, id_col, out)
    return write_run(stamp_run(counts, run_id), layer(root, "gold/entity_counts"), run_id)


def run_pipeline(
    spark: SparkSession,
    backend: PageBackend,
    root: str,
    run_id: str,
    *,
    write_mode: str = "skip",
    per_page: int = 200,
    max_pages: int | None = None,
    pages_per_task: int | None = None,
    max_slices: int | None = None,
    rows_per_slice: int = 500,
    api_url: str | None = None,
    min_rows: int = 1,
    max_null_id_ratio: float = 0.0,
    raw_schema: str | None = PLACE_SCHEMA,
    other_fields: bool = True,
    rules: Sequence[FillRule] = PLACE_RULES,
    partition_cols: Sequence[str] = SILVER_PARTITIONS,
    sort_cols: Sequence[str] = SILVER_SORT,
    required: Sequence[str] = REQUIRED_COLUMNS,
    keys: Sequence[str] = GOLD_KEYS,
    id_col: str = "id",
    out: str = GOLD_COUNT,
    on_step: Callable[[str, str], None] = lambda step, outcome: None,
) -> DataFrame:
    """Ingest, guard, curate, check and aggregate one run; returns its gold table.

    A rerun goes on behind the last complete step: silver, quality and gold leave a record of what
    they were made from (the manifest or the silver table, and the step's settings), and a step is
    skipped if its record still holds. ``on_step`` hears of each step and its outcome: ``run``,
    ``skipped`` or ``failed``.
    """

    def step(name: str, made_from: dict, work: Callable[[], object], there: Callable[[], bool]) -> None:
        path = f"{run_path(layer(root, 'steps'), run_id)}/{name}.json"
        record = json.dumps(made_from, sort_keys=True, default=repr)
        if control.read_text(spark, path) == record and there():
            on_step(name, "skipped")
            return
        control.remove(spark, path)
        try:
            work()
        except Exception:
            on_step(name, "failed")
            raise
        control.replace_text(spark, path, record)
        on_step(name, "run")

    try:
        fetched = ingest(
            spark,
            backend,
            root,
            run_id,
            write_mode=write_mode,
            per_page=per_page,
            max_pages=max_pages,
            pages_per_task=pages_per_task,
            max_slices=max_slices,
            rows_per_slice=rows_per_slice,
            api_url=api_url,
        )
    except Exception:
        on_step("ingest", "failed")
        raise
    on_step("ingest", "run" if fetched == "ingested" else "skipped")
    require_committed(spark, root, run_id, run_path(layer(root, "raw"), run_id))

    committed = read_manifest(spark, root, run_id).first().finished_at_utc
    curation = {
        "committed": committed, "raw_schema": raw_schema, "other_fields": other_fields, "rules": list(rules),
        "partition_cols": list(partition_cols), "sort_cols": list(sort_cols),
    }
    table = layer(root, "silver")
    note = {"run_id": run_id, "committed": committed}
    step(
        "silver",
        curation,
        lambda: build_silver(
            spark,
            root,
            run_id,
            raw_schema=raw_schema,
            other_fields=other_fields,
            rules=rules,
            partition_cols=partition_cols,
            sort_cols=sort_cols,
            note=note,
        ),
        # Another run may have replaced the table since.
        lambda: (published(spark, table) or {}).get("note") == note,
    )

    now = published(spark, table)
    silver = scan_table(spark, f"{table}/{now['version']}", StructType.fromJson(now["schema"]), partition_cols)
    checks = {
        "silver": now["version"], "min_rows": min_rows, "max_null_id_ratio": max_null_id_ratio, "id_col": id_col,
        "required": list(required),
    }
    step(
        "quality",
        checks,
        lambda: check_silver(
            spark,
            root,
            run_id,
            silver=silver,
            min_rows=min_rows,
            max_null_id_ratio=max_null_id_ratio,
            id_col=id_col,
            required=required,
        ),
        lambda: path_exists(spark, run_path(layer(root, "quality/silver"), run_id)),
    )

    gold = run_path(layer(root, "gold/entity_counts"), run_id)
    step(
        "gold",
        {"silver": now["version"], "keys": list(keys), "id_col": id_col, "out": out},
        lambda: build_gold(spark, root, run_id, silver=silver, keys=keys, id_col=id_col, out=out),
        lambda: path_exists(spark, gold),
    )
    return spark.read.parquet(gold)
