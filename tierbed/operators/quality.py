"""Data quality rules, report and gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# Columns that a curated table must have (fixed values).
REQUIRED_COLUMNS = (
    "id",
    "brewery_type",
    "country",
    "state_province",
    "city",
    "ingestion_run_id",
)
CRITICAL = "critical"
WARNING = "warning"

# The rules in report order, each with its severity, threshold text, and
# details text with the metric that follows it.
RULES = {
    "required_columns_present": (CRITICAL, "missing_columns == 0", "missing=", "missing"),
    "minimum_rows": (CRITICAL, "row_count >= {min_rows}", "row_count=", "row_count"),
    "null_id_ratio": (
        CRITICAL,
        "null_id_ratio <= {max_null_id_ratio}",
        "null_id_count=",
        "null_ids",
    ),
    "duplicate_id_groups": (
        WARNING,
        "duplicate_id_groups == 0",
        "Warning-only check to monitor duplicate upstream IDs.",
        "''",
    ),
    "ingestion_run_id_consistency": (
        CRITICAL,
        "rows_with_wrong_run_id == 0",
        "expected_run_id=",
        "run_id",
    ),
}


class QualityGateError(RuntimeError):
    """A critical quality rule failed."""


def run_slice(df: DataFrame, run_id: str, run_col: str = "ingestion_run_id") -> DataFrame:
    """Rows of one run; the comparison is pushed down to Parquet."""
    return df.filter(F.col(run_col) == F.lit(run_id))


def wrong_run(run_id: str, run_col: str, null_safe: bool = False) -> Column:
    """Row belongs to another run. A NULL run id counts only when ``null_safe``."""
    if null_safe:
        return ~F.col(run_col).eqNullSafe(F.lit(run_id))
    return F.col(run_col) != F.lit(run_id)


def null_ratio(df: DataFrame, id_col: str = "id", out: str = "null_id_ratio") -> DataFrame:
    """One row: share of rows whose ``id_col`` is NULL; NULL on an empty table."""
    n_null = F.count(F.when(F.col(id_col).isNull(), 1))
    n_rows = F.nullif(F.count(F.lit(1)), F.lit(0))
    return df.agg((n_null.cast("double") / n_rows).alias(out))


def duplicate_groups(df: DataFrame, id_col: str = "id", out: str = "duplicate_groups") -> DataFrame:
    """One row: number of non-NULL ids that occur more than once."""
    return (
        df.filter(F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias(out))
    )


def mismatch_count(
    df: DataFrame,
    run_id: str,
    run_col: str = "ingestion_run_id",
    null_safe: bool = False,
    out: str = "wrong_run_rows",
) -> DataFrame:
    """One row: number of rows that carry another run id."""
    return df.agg(F.count(F.when(wrong_run(run_id, run_col, null_safe), 1)).alias(out))


def measure(df: DataFrame, run_id: str, id_col: str | None, run_col: str | None) -> DataFrame:
    """All metrics of the report in one pass: a single row.

    Rows are grouped by id once, with counts folded before the shuffle. A NULL or
    very frequent id therefore sends one row per task, not one per occurrence.
    """
    wrong = F.count(F.when(wrong_run(run_id, run_col), 1)) if run_col else F.expr("0L")
    rows = F.count(F.lit(1))
    if id_col is None:
        return df.agg(
            rows.alias("row_count"),
            F.expr("0L AS null_ids"),
            F.expr("0L AS repeated_ids"),
            wrong.alias("wrong_run_rows"),
        )
    return (
        df.groupBy(F.col(id_col).alias("id"))
        .agg(rows.alias("n"), wrong.alias("wrong"))
        .selectExpr(
            "coalesce(sum(n), 0L) AS row_count",
            "coalesce(sum(n) FILTER (WHERE id IS NULL), 0L) AS null_ids",
            "count_if(id IS NOT NULL AND n > 1) AS repeated_ids",
            "coalesce(sum(wrong), 0L) AS wrong_run_rows",
        )
    )


def quality_report(
    df: DataFrame,
    run_id: str,
    min_rows: int = 1,
    max_null_id_ratio: float = 0.0,
    id_col: str = "id",
    run_col: str = "ingestion_run_id",
    required: Sequence[str] = REQUIRED_COLUMNS,
) -> DataFrame:
    """One row per check, in report order (``ord``), with the overall ``status``.

    An empty table reports only the first two checks. Checks whose column is
    missing are left out. Status is ``failed`` when a critical check failed.
    """
    missing = [c for c in required if c not in df.columns]
    has_id = id_col in df.columns
    has_run = run_col in df.columns

    # Per rule: can it be measured, its metric, and what the metric must satisfy.
    tests = {
        "required_columns_present": (True, "size(missing_columns)", "= 0"),
        "minimum_rows": (True, "row_count", f">= {min_rows}"),
        "null_id_ratio": (
            has_id,
            "null_ids / nullif(row_count, 0)",
            f"<= CAST('{max_null_id_ratio}' AS double)",
        ),
        "duplicate_id_groups": (has_id, "repeated_ids", "= 0"),
        "ingestion_run_id_consistency": (has_run, "wrong_run_rows", "= 0"),
    }
    limits = {"min_rows": min_rows, "max_null_id_ratio": max_null_id_ratio}
    checks = []
    for ord, (name, (measurable, metric, condition)) in enumerate(tests.items(), start=1):
        severity, threshold, details, value = RULES[name]
        if measurable:
            checks.append(
                f"struct({ord} AS ord, '{name}' AS name, {metric} {condition} AS passed, "
                f"'{severity}' AS severity, CAST({metric} AS double) AS metric, "
                f"'{threshold.format(**limits)}' AS threshold, "
                f"concat('{details}', {value}) AS details)"
            )

    # Texts from the caller enter as literals, never as SQL.
    literals = (
        F.lit(run_id).alias("run_id"),
        F.lit(str(missing)).alias("missing"),
        F.lit(missing).cast("array<string>").alias("missing_columns"),
    )
    reported = f"filter(array({', '.join(checks)}), c -> row_count > 0 OR c.ord <= 2)"
    failed = f"exists(checks, c -> NOT c.passed AND c.severity = '{CRITICAL}')"
    return (
        measure(df, run_id, id_col if has_id else None, run_col if has_run else None)
        .select("*", *literals)
        .selectExpr("run_id", "row_count", f"{reported} AS checks")
        .selectExpr(
            "run_id",
            "current_timestamp() AS evaluated_at_utc",
            "row_count",
            f"CASE WHEN {failed} THEN 'failed' ELSE 'passed' END AS status",
            "inline(checks)",
        )
    )


def report_status(report: DataFrame) -> DataFrame:
    """Roll a report up to one row: status and number of failed critical checks."""
    failed = ~F.col("passed") & (F.col("severity") == CRITICAL)
    return report.agg(
        F.when(F.bool_or(failed), "failed").otherwise("passed").alias("status"),
        F.count(F.when(failed, 1)).alias("failed_critical"),
    )


def write_report(report: DataFrame, path: str) -> None:
    """Write a report as one JSON object with its checks as a list."""
    fields = ["name", "passed", "severity", "metric", "threshold", "details"]
    ordered = F.array_sort(F.collect_list(F.struct("ord", *fields)))
    (
        report.groupBy("run_id", "evaluated_at_utc", "row_count", "status")
        .agg(ordered.alias("checks"))
        .withColumn(
            "checks", F.transform("checks", lambda c: F.struct(*[c[f].alias(f) for f in fields]))
        )
        .coalesce(1)
        .write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .json(path)
    )


def quality_gate(checks: Sequence[Row]) -> None:
    """Raise when a collected report (at most five rows) has a failed critical check."""
    ordered = sorted(checks, key=lambda c: c.ord)
    failed = [c.name for c in ordered if not c.passed and c.severity == CRITICAL]
    if failed:
        raise QualityGateError(
            f"Data quality checks failed. run_id={checks[0].run_id} failed_critical_checks={failed}"
        )
