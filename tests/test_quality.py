import glob
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierbed.operators import (
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

SCHEMA = (
    "id string, brewery_type string, country string, state_province string, city string, "
    "ingestion_run_id string"
)


def rows(*pairs):
    return [(i, "micro", "US", "CA", "LA", run) for i, run in pairs]


def report(spark, data, schema=SCHEMA, **options):
    checks = quality_report(spark.createDataFrame(data, schema), "R1", **options).collect()
    assert [c.ord for c in checks] == sorted(c.ord for c in checks)
    return checks


def test_passing(spark):
    checks = report(spark, rows(("1", "R1"), ("2", "R1")))
    assert [c.name for c in checks] == [
        "required_columns_present",
        "minimum_rows",
        "null_id_ratio",
        "duplicate_id_groups",
        "ingestion_run_id_consistency",
    ]
    assert all(c.passed for c in checks)
    assert {(c.run_id, c.status, c.row_count) for c in checks} == {("R1", "passed", 2)}
    assert [c.details for c in checks] == [
        "missing=[]",
        "row_count=2",
        "null_id_count=0",
        "Warning-only check to monitor duplicate upstream IDs.",
        "expected_run_id=R1",
    ]
    quality_gate(checks)


def test_failing_gate_names_critical_checks(spark):
    checks = report(spark, rows((None, "other_run")))
    failed = [c.name for c in checks if not c.passed]
    assert failed == ["null_id_ratio", "ingestion_run_id_consistency"]
    assert {c.status for c in checks} == {"failed"}
    with pytest.raises(QualityGateError, match="null_id_ratio.*ingestion_run_id_consistency") as e:
        quality_gate(checks)
    assert "run_id=R1" in str(e.value)


def test_duplicates_only_warn(spark):
    checks = report(spark, rows(("1", "R1"), ("1", "R1"), ("1", "R1"), ("2", "R1")))
    duplicate = next(c for c in checks if c.name == "duplicate_id_groups")
    assert (duplicate.passed, duplicate.severity, duplicate.metric) == (False, "warning", 1.0)
    assert duplicate.status == "passed"
    quality_gate(checks)


def test_empty_table_reports_two_checks(spark):
    checks = report(spark, [])
    assert [(c.name, c.passed) for c in checks] == [
        ("required_columns_present", True),
        ("minimum_rows", False),
    ]
    assert {c.status for c in checks} == {"failed"}
    assert {c.status for c in report(spark, [], min_rows=0)} == {"passed"}


def test_missing_columns_leave_out_their_checks(spark):
    checks = report(spark, [("US", "R1")], "country string, ingestion_run_id string")
    assert [c.ord for c in checks] == [1, 2, 5]
    assert checks[0].metric == 4.0
    assert checks[0].details == "missing=['id', 'brewery_type', 'state_province', 'city']"
    assert [c.ord for c in report(spark, [("1",)], "id string")] == [1, 2, 3, 4]
    assert [c.ord for c in report(spark, [("1",)], "other string")] == [1, 2]


@pytest.mark.parametrize(("min_rows", "passed"), [(1, True), (2, True), (3, False)])
def test_minimum_rows_boundary(spark, min_rows, passed):
    check = report(spark, rows(("1", "R1"), ("2", "R1")), min_rows=min_rows)[1]
    assert check.passed is passed
    assert check.threshold == f"row_count >= {min_rows}"


@pytest.mark.parametrize(("limit", "passed"), [(0.0, False), (0.49, False), (0.5, True), (1e-05, False)])
def test_null_ratio_boundary(spark, limit, passed):
    check = report(spark, rows((None, "R1"), ("2", "R1")), max_null_id_ratio=limit)[2]
    assert (check.metric, check.passed) == (0.5, passed)
    assert check.threshold == f"null_id_ratio <= {limit}"


def test_run_id_with_quotes(spark):
    odd = "a'b\\c\"d"
    df = spark.createDataFrame(rows(("1", odd)), SCHEMA)
    checks = quality_report(df, odd).collect()
    assert checks[4].passed and checks[4].details == f"expected_run_id={odd}"


def test_null_run_id_is_not_a_mismatch(spark):
    df = spark.createDataFrame(rows(("1", "R1"), ("2", "R2"), ("3", None)), SCHEMA)
    assert mismatch_count(df, "R1").first()[0] == 1
    assert mismatch_count(df, "R1", null_safe=True).first()[0] == 2
    assert quality_report(df, "R1").collect()[4].metric == 1.0
    assert [r.id for r in run_slice(df, "R1").collect()] == ["1"]


def test_single_metrics_on_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert null_ratio(df).first()[0] is None
    assert duplicate_groups(df, "id").first()[0] == 0


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from([None, "1", "2", "3", "4"]), st.sampled_from(["R1", "R2", None])),
        min_size=1,
        max_size=20,
    )
)
def test_metrics_against_brute_force(spark, pairs):
    ids = [i for i, _ in pairs]
    checks = report(spark, rows(*pairs))
    assert checks[1].metric == len(pairs)
    assert checks[2].metric == ids.count(None) / len(ids)
    assert checks[3].metric == len({i for i in ids if i is not None and ids.count(i) > 1})
    assert checks[4].metric == sum(run == "R2" for _, run in pairs)


def test_status_roll_up(spark):
    df = quality_report(spark.createDataFrame(rows((None, "R2")), SCHEMA), "R1")
    assert tuple(report_status(df).first()) == ("failed", 2)


def test_report_file(spark, root):
    write_report(quality_report(spark.createDataFrame(rows((None, "R1")), SCHEMA), "R1"), root)
    [file] = glob.glob(f"{root}/part-*.json")
    [line] = open(file).read().splitlines()
    data = json.loads(line)
    assert (data["run_id"], data["row_count"], data["status"]) == ("R1", 1, "failed")
    assert "evaluated_at_utc" in data
    assert [c["name"] for c in data["checks"]][2] == "null_id_ratio"
    assert set(data["checks"][0]) == {
        "name", "passed", "severity", "metric", "threshold", "details"
    }
