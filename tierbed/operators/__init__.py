"""Table operators: page prefix, curation, aggregates, quality rules, runs, monitoring."""

from tierbed.operators.aggregate import entity_counts
from tierbed.operators.curate import FillRule, curate, stamp_run
from tierbed.operators.monitoring import (
    alert_body,
    format_monitoring,
    parse_monitoring,
    read_monitoring_log,
    route_alerts,
    unparsed_monitoring,
)
from tierbed.operators.pages import contiguous_prefix, fetch_totals, prefix_totals
from tierbed.operators.quality import (
    QualityGateError,
    duplicate_groups,
    mismatch_count,
    null_ratio,
    quality_gate,
    quality_report,
    report_status,
    run_slice,
    write_report,
)
from tierbed.operators.registry import (
    LeaseHeldError,
    commit_runs,
    committed_rows,
    drop_manifest,
    read_manifest,
    read_registry,
    require_committed,
    rerun_action,
    run_lease,
    write_manifest,
)

__all__ = [
    "FillRule",
    "LeaseHeldError",
    "QualityGateError",
    "alert_body",
    "commit_runs",
    "committed_rows",
    "contiguous_prefix",
    "curate",
    "drop_manifest",
    "duplicate_groups",
    "entity_counts",
    "fetch_totals",
    "format_monitoring",
    "mismatch_count",
    "null_ratio",
    "parse_monitoring",
    "prefix_totals",
    "quality_gate",
    "quality_report",
    "read_monitoring_log",
    "read_manifest",
    "read_registry",
    "report_status",
    "require_committed",
    "rerun_action",
    "route_alerts",
    "run_lease",
    "run_slice",
    "stamp_run",
    "unparsed_monitoring",
    "write_manifest",
    "write_report",
]
