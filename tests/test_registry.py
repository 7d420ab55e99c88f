import json
import threading
import time

import pytest

from tierbed.operators import (
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
from tierbed.sources import control


def manifest(run_id, rows=1):
    return {"run_id": run_id, "fetched_rows": rows, "pages_fetched": 1, "per_page": 200,
            "max_pages": 10, "truncated": False, "started_at_utc": "a", "finished_at_utc": "b", "api_url": "u"}


def runs(spark, root):
    return {r.run_id: r.fetched_rows for r in read_registry(spark, root).collect()}


def test_commit_replace_and_drop(spark, root):
    assert runs(spark, root) == {}
    write_manifest(spark, root, manifest("20260101"))
    write_manifest(spark, root, manifest("007", 2))
    write_manifest(spark, root, manifest("20260101", 3))
    assert runs(spark, root) == {"20260101": 3, "007": 2}
    drop_manifest(spark, root, "20260101")
    assert runs(spark, root) == {"007": 2}
    write_manifest(spark, root, manifest("20260101", 4))
    assert runs(spark, root) == {"20260101": 4, "007": 2}


def test_commit_many_runs_at_once(spark, root):
    write_manifest(spark, root, manifest("a:1/x", 9))
    commit_runs(spark.createDataFrame([("R1", 1), ("R2", 2)], "run_id string, fetched_rows bigint"), root)
    assert runs(spark, root) == {"a:1/x": 9, "R1": 1, "R2": 2}


def test_manifest_fields(spark, root):
    write_manifest(spark, root, manifest("R1"))
    assert read_registry(spark, root).first().asDict() == manifest("R1") | {"fields": None}


def test_guard(spark, root):
    with pytest.raises(RuntimeError, match="manifest not found") as e:
        require_committed(spark, root, "R1")
    assert root in str(e.value) and "run_id=R1" in str(e.value) and "error_code=" in str(e.value)
    write_manifest(spark, root, manifest("R1"))
    require_committed(spark, root, "R1")
    with pytest.raises(RuntimeError):
        require_committed(spark, root, "R2")


def test_directories_are_those_of_a_partitioned_write(spark, root):
    odd = "a+b c:d/e%f#g[h]é=i"
    commit_runs(spark.createDataFrame([(odd, 1)], "run_id string, fetched_rows bigint"), root)
    assert read_manifest(spark, root, odd).first().fetched_rows == 1
    write_manifest(spark, root, manifest(odd, 2))
    assert runs(spark, root) == {odd: 2}


def test_guard_wants_the_output_too(spark, root):
    write_manifest(spark, root, manifest("R1"))
    with pytest.raises(RuntimeError, match="output not found"):
        require_committed(spark, root, "R1", f"{root}/raw/run_id=R1")


def test_committed_rows(spark, root):
    commit_runs(spark.createDataFrame([("R1", 1), ("R2", 2)], "run_id string, fetched_rows bigint"), root)
    df = spark.createDataFrame([(1, "R1"), (2, "R3"), (3, "R2"), (4, None), (5, "R1")], "id int, run_id string")
    kept = committed_rows(df, read_registry(spark, root))
    assert sorted(r.id for r in kept.collect()) == [1, 3, 5]


MATRIX = [
    (True, True, "skip", "skip"),
    (True, True, "overwrite", "ingest"),
    (True, True, "fail", None),
    (False, True, "skip", "ingest"),
    (False, True, "overwrite", "ingest"),
    (False, True, "fail", None),
    (False, False, "skip", "ingest"),
    (False, False, "overwrite", "ingest"),
    (False, False, "fail", "ingest"),
]


@pytest.mark.parametrize(("committed", "output", "mode", "want"), MATRIX)
def test_rerun_matrix(committed, output, mode, want):
    if want is None:
        with pytest.raises(RuntimeError, match="write_mode=fail"):
            rerun_action(committed, output, mode, "R1")
    else:
        assert rerun_action(committed, output, mode, "R1") == want


def test_unknown_mode():
    with pytest.raises(ValueError):
        rerun_action(False, False, "append", "R1")


def test_a_lease_keeps_other_writers_out(spark, root):
    with run_lease(spark, root, "R:1"):
        with pytest.raises(LeaseHeldError, match="R:1"), run_lease(spark, root, "R:1"):
            pass
        with run_lease(spark, root, "R2"):
            pass
    with run_lease(spark, root, "R:1"):
        pass
    with pytest.raises(ValueError), run_lease(spark, root, "R:1"):
        raise ValueError
    with run_lease(spark, root, "R:1"):
        pass


def test_the_lease_of_a_dead_writer_is_taken_over(spark, root):
    path = f"{root}/leases/run_id=R1/lease.json"
    control.create_text(spark, path, json.dumps({"owner": "gone", "since": time.time() - 100}))
    with pytest.raises(LeaseHeldError), run_lease(spark, root, "R1", max_seconds=1000):
        pass
    with run_lease(spark, root, "R1", max_seconds=50):
        assert json.loads(control.read_text(spark, path))["owner"] != "gone"
    assert control.read_text(spark, path) is None
    assert control.names(spark, f"{root}/leases/run_id=R1") == []


def test_one_of_many_creates_a_file(spark, root):
    made = []

    def create(i):
        made.append(control.create_text(spark, f"{root}/x/lease", str(i)))

    threads = [threading.Thread(target=create, args=(i,)) for i in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(made) == [False] * 7 + [True]


def test_replacing_and_removing(spark, root):
    path = f"{root}/a%3Ab/x.json"
    assert control.read_text(spark, path) is None and control.names(spark, f"{root}/a%3Ab") == []
    for text in ("one", "zwöi\n"):
        control.replace_text(spark, path, text)
        assert control.read_text(spark, path) == text
    assert control.names(spark, f"{root}/a%3Ab") == ["x.json"]
    control.remove(spark, path)
    control.remove(spark, path)
    assert control.read_text(spark, path) is None
