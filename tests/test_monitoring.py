import json

import pytest

from tierbed.operators import (
    alert_body,
    format_monitoring,
    parse_monitoring,
    read_monitoring_log,
    route_alerts,
    unparsed_monitoring,
)

EVENT = {
    "dag_id": "daily", "task_id": "dq_silver", "run_id": "R1", "try_number": 2, "state": "failed",
    "owner": "data", "log_url": "http://log/1", "logical_date": "2026-02-28T00:00:00+00:00",
    "exception": "DQ failed: {\"é\": 1}\nsecond line", "captured_at_utc": "2026-02-28T12:00:00+00:00",
    "event": "task_failure",
}


def line(base, /, **changes):
    return f"2026-02-28 ERROR [monitoring] {json.dumps(base | changes, ensure_ascii=False, sort_keys=True)}"


def events(spark, *lines):
    return parse_monitoring(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_parse_round_trip_and_noise(spark):
    df = events(
        spark,
        line(EVENT),
        "INFO nothing here {}",
        "[monitoring] no json",
        "[monitoring] {bad",
        '[monitoring] {"a": 1}',
        line(EVENT, exception=None, try_number=None) + "  ",
    )
    got = [r.asDict() for r in df.collect()]
    assert got == [EVENT, EVENT | {"exception": None, "try_number": None}]


def test_format_is_sorted_and_parses_back(spark):
    df = events(spark, line(EVENT), line(EVENT, exception=None))
    lines = format_monitoring(df)
    text = lines.first().value
    assert text.startswith("[monitoring] {")
    keys = list(json.loads(text.removeprefix("[monitoring] ")))
    assert keys == sorted(EVENT) and "é" in text
    assert parse_monitoring(lines).collect() == df.collect()


def test_read_from_files(spark, tmp_path):
    (tmp_path / "a.log").write_text(line(EVENT) + "\nother\n", encoding="utf-8")
    (tmp_path / "b.log").write_text(line(EVENT, event="dag_success") + "\n", encoding="utf-8")
    got = read_monitoring_log(spark, str(tmp_path)).collect()
    assert sorted(r.event for r in got) == ["dag_success", "task_failure"]


@pytest.mark.parametrize(
    ("event", "want"),
    [
        ("task_failure", ("ERROR", "FAILED", "[ALERT][daily] Task failed: dq_silver", True)),
        ("task_retry", ("WARNING", "RETRY", "[WARN][daily] Task retry: dq_silver", True)),
        ("dag_failure", ("ERROR", "FAILED", "[ALERT][daily] DAG failed", True)),
        ("dag_success", ("INFO", "SUCCEEDED", "[INFO][daily] DAG succeeded", False)),
        ("other", (None, None, None, False)),
    ],
)
def test_routes(spark, event, want):
    row = route_alerts(events(spark, line(EVENT, event=event))).first()
    assert (row.level, row.status_label, row.subject, row.notify) == want


def test_success_notifies_when_asked(spark):
    df = events(spark, line(EVENT, event="dag_success"))
    assert route_alerts(df, notify_success=True).first().notify is True


def test_missing_ids_print_none(spark):
    row = route_alerts(events(spark, line(EVENT, dag_id=None, task_id=None))).first()
    assert row.subject == "[ALERT][None] Task failed: None"


def test_body(spark):
    row = alert_body(route_alerts(events(spark, line(EVENT, state=None, exception="DQ failed")))).first()
    assert row.body.split("\n") == [
        "Status: FAILED",
        "DAG: daily",
        "Task: dq_silver",
        "Run ID: R1",
        "Try Number: 2",
        "State: None",
        "Logical Date (UTC): 2026-02-28T00:00:00+00:00",
        "Exception: DQ failed",
        "Log URL: http://log/1",
        "Captured At (UTC): 2026-02-28T12:00:00+00:00",
    ]


def test_line_separators_inside_a_text_lose_no_event(spark):
    texts = ["a\u0085b", "\u2028", "x\u2029y", "plain"]
    rows = [("e", "task_failure", t) for t in texts]
    events = spark.createDataFrame(rows, "dag_id string, event string, exception string")
    parsed = parse_monitoring(format_monitoring(events))
    assert sorted(r.exception for r in parsed.collect()) == sorted(texts)


def test_unparsed_lines_are_given_out(spark):
    lines = ['[monitoring] {"event": "x"}', '[monitoring] {"event": "x"', "[monitoring] {} tail", "other"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert sorted(r.value for r in unparsed_monitoring(df).collect()) == sorted(lines[1:3])
