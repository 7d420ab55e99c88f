"""Monitoring log lines to events, alert routing and alert texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How an event is marked in a log line, and its fields.
EVENT_PATTERN = r"(?s)\[monitoring\] (\{.*\})\s*\z"
EVENT_MARK = "[monitoring] {"
EVENT_SCHEMA = (
    "dag_id string, task_id string, run_id string, try_number int, state string, owner string, "
    "log_url string, logical_date string, exception string, captured_at_utc string, event string"
)

# Event -> level, status label, subject prefix, what happened, names the task.
ROUTES = {
    "task_failure": ("ERROR", "FAILED", "ALERT", "Task failed", True),
    "task_retry": ("WARNING", "RETRY", "WARN", "Task retry", True),
    "dag_failure": ("ERROR", "FAILED", "ALERT", "DAG failed", False),
    "dag_success": ("INFO", "SUCCEEDED", "INFO", "DAG succeeded", False),
}
# Label of each body line -> event column.
BODY_LINES = {
    "Status": "status_label",
    "DAG": "dag_id",
    "Task": "task_id",
    "Run ID": "run_id",
    "Try Number": "try_number",
    "State": "state",
    "Logical Date (UTC)": "logical_date",
    "Exception": "exception",
    "Log URL": "log_url",
    "Captured At (UTC)": "captured_at_utc",
}


def format_monitoring(events: DataFrame, column: str = "value") -> DataFrame:
    """One log line per event: its fields as JSON with sorted keys and NULLs kept."""
    fields = F.struct(*sorted(events.columns))
    payload = F.to_json(fields, {"ignoreNullFields": "false"})
    return events.select(F.concat(F.lit("[monitoring] "), payload).alias(column))


def parse_monitoring(lines: DataFrame, column: str = "value") -> DataFrame:
    """Events found in log lines; lines that carry no event are dropped.

    Lines with the mark whose event cannot be read are given by ``unparsed_monitoring``.
    """
    payload = F.regexp_extract(F.col(column), EVENT_PATTERN, 1)
    return (
        lines.filter(F.col(column).contains(EVENT_MARK))
        # A generator, because the filter would otherwise parse the line a second time.
        .select(F.inline(F.array(F.from_json(payload, EVENT_SCHEMA))))
        .filter(F.col("event").isNotNull())
    )


def unparsed_monitoring(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that are marked as an event but hold none that can be read."""
    payload = F.regexp_extract(F.col(column), EVENT_PATTERN, 1)
    event = F.from_json(payload, EVENT_SCHEMA)["event"]
    return lines.filter(F.col(column).contains(EVENT_MARK) & event.isNull())


def read_monitoring_log(spark: SparkSession, path: str) -> DataFrame:
    """Events of the log files under ``path``."""
    return parse_monitoring(spark.read.text(path))


def or_none(column: str) -> str:
    return f"coalesce(CAST({column} AS string), 'None')"


def by_event(values: dict[str, str]) -> str:
    """SQL CASE over the known events; NULL for any other event."""
    whens = " ".join(f"WHEN '{event}' THEN {value}" for event, value in values.items())
    return f"CASE event {whens} END"


def subject(prefix: str, happened: str, names_task: bool) -> str:
    task = f", ': ', {or_none('task_id')}" if names_task else ""
    return f"concat('[{prefix}][', {or_none('dag_id')}, '] {happened}'{task})"


def route_alerts(events: DataFrame, notify_success: bool = False) -> DataFrame:
    """Add ``level``, ``status_label``, ``subject`` and ``notify`` to each event.

    An unknown event has no level, label or subject and does not notify.
    """
    notify = {event: str(event != "dag_success" or notify_success) for event in ROUTES}
    return events.withColumns(
        {
            "level": F.expr(by_event({e: f"'{r[0]}'" for e, r in ROUTES.items()})),
            "status_label": F.expr(by_event({e: f"'{r[1]}'" for e, r in ROUTES.items()})),
            "subject": F.expr(by_event({e: subject(*r[2:]) for e, r in ROUTES.items()})),
            "notify": F.expr(f"coalesce({by_event(notify)}, false)"),
        }
    )


def alert_body(routed: DataFrame, out: str = "body") -> DataFrame:
    """Add the alert text: one ``Label: value`` line per field, ``None`` when missing."""
    lines = [f"concat('{label}: ', {or_none(column)})" for label, column in BODY_LINES.items()]
    return routed.withColumn(out, F.expr(f"concat_ws(char(10), {', '.join(lines)})"))
