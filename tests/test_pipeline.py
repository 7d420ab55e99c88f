import glob
import json
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from tierbed.functions import run_path
from tierbed.operators import LeaseHeldError, QualityGateError, read_registry
from tierbed.plans import (
    PLACE_SCHEMA,
    build_gold,
    build_silver,
    check_silver,
    ingest,
    open_silver,
    pipeline,
    run_pipeline,
    silver_schema,
)
from tierbed.sources import write_partitioned, write_raw


def place(id, city="Los Angeles", kind="micro"):
    return {"id": id, "name": f"n{id}", "brewery_type": kind, "country": "US", "state": "CA",
            "state_province": None, "city": city}


class Pages:
    def __init__(self, *pages):
        self.pages = pages

    def records(self, page, per_page):
        rows = self.pages[page - 1] if page <= len(self.pages) else []
        return iter(json.dumps(r) for r in rows)


class Broken:
    def records(self, page, per_page):
        raise OSError("source is down")


def manifest(spark, root):
    return {r.run_id: r for r in read_registry(spark, root).collect()}


def raw_ids(spark, root, run_id):
    return sorted(r.id for r in spark.read.json(run_path(f"{root}/raw", run_id)).collect())


def test_ingest_counts_and_manifest(spark, root):
    pages = Pages([place("1"), place("2")], [place("3")], [], [place("9")])
    assert ingest(spark, pages, root, "R1", per_page=2, max_pages=6, api_url="u") == "ingested"
    row = manifest(spark, root)["R1"]
    assert (row.fetched_rows, row.pages_fetched, row.per_page, row.max_pages) == (3, 2, 2, 6)
    assert row.started_at_utc <= row.finished_at_utc and row.api_url == "u"
    assert raw_ids(spark, root, "R1") == ["1", "2", "3"]


def test_raw_keeps_records_as_sent(spark, root):
    odd = {"id": "1", "extra": {"a": [1, None]}, "city": None, "name": "São"}
    ingest(spark, Pages([odd]), root, "R1")
    [line] = [r.value for r in spark.read.text(run_path(f"{root}/raw", "R1")).collect()]
    assert line == json.dumps(odd)


def test_raw_file_count(spark, root):
    pages = Pages(*[[place(f"{p}-{i}") for i in range(200)] for p in range(8)])
    ingest(spark, pages, root, "R1", max_slices=8)
    assert len(glob.glob(f"{root}/raw/run_id=R1/part-*")) == 3
    ingest(spark, pages, root, "R2", max_slices=64, rows_per_slice=320)
    assert len(glob.glob(f"{root}/raw/run_id=R2/part-*")) == 5
    assert spark.read.json(run_path(f"{root}/raw", "R2")).distinct().count() == 1600


def test_raw_files_follow_the_staged_bytes(spark, root):
    """More than eight files where the splits are more than eight."""
    pages = Pages(*[[place(f"{p}-{i}") | {"name": "x" * 200} for i in range(200)] for p in range(30)])
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "20k")
    try:
        ingest(spark, pages, root, "R1")
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(f"{root}/raw/run_id=R1/part-*")) > 8
    assert spark.read.json(run_path(f"{root}/raw", "R1")).distinct().count() == 6000


def test_silver_reads_the_raw_lines_once(spark, root, monkeypatch):
    wide = [place("1") | {"phone": 12}, place("2")]
    ingest(spark, Pages(wide), root, "R1")
    scans = []
    scan = pipeline.scan_raw
    monkeypatch.setattr(pipeline, "scan_raw", lambda s, p, schema: scans.append(schema) or scan(s, p, schema))
    monkeypatch.setattr("tierbed.sources.raw.scan_raw", None)  # what infers a schema
    for raw_schema in (PLACE_SCHEMA, None):
        schema = build_silver(spark, root, "R1", raw_schema=raw_schema)
        assert "phone" in schema.names
    assert len(scans) == 2 and None not in scans


def test_two_ingests_of_one_run(spark, root):
    """One is in the middle of its fetch when the other one comes."""

    class Slow(Pages):
        def records(self, page, per_page):
            import time

            time.sleep(3 if page == 1 else 0)
            return super().records(page, per_page)

    outcomes = []

    def go():
        try:
            outcomes.append(ingest(spark, Slow([place("1")]), root, "R1", write_mode="overwrite"))
        except LeaseHeldError:
            outcomes.append("held")

    threads = [threading.Thread(target=go) for _ in range(2)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(outcomes) == ["held", "ingested"]
    assert raw_ids(spark, root, "R1") == ["1"] and manifest(spark, root)["R1"].fetched_rows == 1


def steps_of(spark, root, pages, run_id="R1", **options):
    told = []
    try:
        run_pipeline(spark, pages, root, run_id, on_step=lambda *x: told.append(x), **options)
    except Exception as error:
        assert told[-1][1] == "failed", error
    return [f"{step} {outcome}" for step, outcome in told]


def test_a_rerun_goes_on_after_the_last_complete_step(spark, root):
    pages = Pages([place(None), place("2")])
    assert steps_of(spark, root, pages) == ["ingest run", "silver run", "quality failed"]
    loose = {"max_null_id_ratio": 0.5}
    assert steps_of(spark, root, Broken(), **loose) == ["ingest skipped", "silver skipped", "quality run", "gold run"]
    done = ["ingest skipped", "silver skipped", "quality skipped", "gold skipped"]
    assert steps_of(spark, root, Broken(), **loose) == done
    assert steps_of(spark, root, Broken(), out="n", **loose) == [*done[:3], "gold run"]
    # Lost output, another run's silver and a new fetch are all seen.
    shutil.rmtree(f"{root}/gold")
    assert steps_of(spark, root, Broken(), out="n", **loose) == [*done[:3], "gold run"]
    again = ["silver run", "quality run", "gold run"]
    assert steps_of(spark, root, Pages([place("9")]), "R2") == ["ingest run", *again]
    assert steps_of(spark, root, Broken(), out="n", **loose) == ["ingest skipped", *again]
    fetched = steps_of(spark, root, pages, write_mode="overwrite", out="n", **loose)
    assert fetched == ["ingest run", *again]
    assert steps_of(spark, root, Broken(), "R3") == ["ingest failed"]


def test_a_failed_curation_leaves_the_earlier_silver(spark, root, monkeypatch):
    run_pipeline(spark, Pages([place("1")]), root, "R1")
    ingest(spark, Pages([place("2")]), root, "R2")
    failing = F.raise_error(F.lit("midway")).cast("string")
    curate = pipeline.curate
    monkeypatch.setattr(pipeline, "curate", lambda *x: curate(*x).withColumn("city", failing))
    with pytest.raises(Exception, match="midway"):
        build_silver(spark, root, "R2")
    assert [r.id for r in open_silver(spark, root).collect()] == ["1"]


def test_no_cap_and_cap(spark, root):
    pages = Pages(*[[place(str(p))] for p in range(15)])
    ingest(spark, pages, root, "R1")
    ingest(spark, pages, root, "R2", max_pages=10)
    ingest(spark, pages, root, "R3", max_pages=15)
    got = {k: (r.fetched_rows, r.pages_fetched, r.max_pages, r.truncated)
           for k, r in manifest(spark, root).items()}
    assert got == {"R1": (15, 15, None, False), "R2": (10, 10, 10, True), "R3": (15, 15, 15, False)}
    assert len(raw_ids(spark, root, "R2")) == 10


def test_lost_output_is_fetched_again(spark, root):
    ingest(spark, Pages([place("1")]), root, "R1")
    shutil.rmtree(f"{root}/raw/run_id=R1")
    assert ingest(spark, Pages([place("2")]), root, "R1", write_mode="fail") == "ingested"
    assert raw_ids(spark, root, "R1") == ["2"]


def test_silver_keeps_all_fields(spark, root):
    wide = [place("1") | {"phone": "12", "geo": {"lat": 1.5}}, place("2")]
    for run_id, options in (("R1", {}), ("R2", {"raw_schema": None})):
        run_pipeline(spark, Pages(wide), root, run_id, **options)
        rows = {r.id: r for r in open_silver(spark, root).collect()}
        assert rows["1"].phone == "12" and rows["1"].geo.lat == 1.5 and rows["2"].phone is None
    run_pipeline(spark, Pages(wide), root, "R3", other_fields=False)
    assert "phone" not in open_silver(spark, root).columns


def test_empty_ingest_commits_nothing(spark, root):
    with pytest.raises(RuntimeError, match="returned 0 rows"):
        ingest(spark, Pages([]), root, "R1")
    assert manifest(spark, root) == {}
    assert not glob.glob(f"{root}/raw/*")
    with pytest.raises(RuntimeError, match="manifest not found"):
        pipeline.require_committed(spark, root, "R1")


def test_rerun_modes_on_data(spark, root):
    old, new = Pages([place("1")]), Pages([place("2")])
    ingest(spark, old, root, "R1")
    assert ingest(spark, new, root, "R1") == "skipped"
    assert raw_ids(spark, root, "R1") == ["1"]
    with pytest.raises(RuntimeError, match="write_mode=fail"):
        ingest(spark, new, root, "R1", write_mode="fail")
    assert manifest(spark, root)["R1"].fetched_rows == 1
    assert ingest(spark, new, root, "R1", write_mode="overwrite") == "ingested"
    assert raw_ids(spark, root, "R1") == ["2"]


def test_incomplete_run_is_redone(spark, root):
    write_raw(spark.createDataFrame([("old",)], "id string"), run_path(f"{root}/raw", "R1"))
    with pytest.raises(RuntimeError, match="no manifest"):
        ingest(spark, Pages([place("1")]), root, "R1", write_mode="fail")
    assert ingest(spark, Pages([place("1")]), root, "R1") == "ingested"
    assert raw_ids(spark, root, "R1") == ["1"]


def test_failed_overwrite_leaves_an_incomplete_run(spark, root):
    ingest(spark, Pages([place("1")]), root, "R1")
    with pytest.raises(Exception, match="source is down"):
        ingest(spark, Broken(), root, "R1", write_mode="overwrite")
    assert manifest(spark, root) == {}
    assert ingest(spark, Pages([place("2")]), root, "R1") == "ingested"
    assert raw_ids(spark, root, "R1") == ["2"]


def test_flow(spark, root):
    pages = Pages([place("1"), place("1")], [place("2", "San Diego", "brewpub")])
    gold = run_pipeline(spark, pages, root, "R1")
    got = {(r.state_province, r.city, r.brewery_type, r.brewery_count, r.ingestion_run_id)
           for r in gold.collect()}
    assert got == {("CA", "Los Angeles", "micro", 1, "R1"), ("CA", "San Diego", "brewpub", 1, "R1")}
    [file] = glob.glob(f"{root}/quality/silver/run_id=R1/part-*.json")
    report = json.load(open(file))
    assert report["status"] == "passed"
    assert [c["name"] for c in report["checks"] if not c["passed"]] == ["duplicate_id_groups"]


def test_flow_stops_at_the_gate_and_leaves_the_report(spark, root):
    with pytest.raises(QualityGateError, match="null_id_ratio"):
        run_pipeline(spark, Pages([place(None), place("2")]), root, "R1")
    assert glob.glob(f"{root}/quality/silver/run_id=R1/part-*.json")
    assert not glob.glob(f"{root}/gold/*")
    gold = run_pipeline(spark, Pages(), root, "R1", max_null_id_ratio=0.5)
    assert gold.agg(F.sum("brewery_count")).first()[0] == 1


def test_numeric_looking_places_survive_the_flow(spark, root):
    gold = run_pipeline(spark, Pages([place("1", "007"), place("2", "7")]), root, "R1")
    assert sorted(r.city for r in gold.collect()) == ["007", "7"]


def test_second_run_replaces_silver_and_adds_gold(spark, root):
    run_pipeline(spark, Pages([place("1")]), root, "R1")
    run_pipeline(spark, Pages([place("2")]), root, "R2")
    silver = open_silver(spark, root)
    assert [r.ingestion_run_id for r in silver.collect()] == ["R2"]
    assert len(glob.glob(f"{root}/gold/entity_counts/run_id=*")) == 2


def test_gold_counts_only_its_run(spark, root):
    for run_id, city in (("R1", "A"), ("R2", "B")):
        ingest(spark, Pages([place("1", city)]), root, run_id)
        build_silver(spark, root, run_id, overwrite="dynamic")
    assert open_silver(spark, root).count() == 2
    gold = spark.read.parquet(build_gold(spark, root, "R2"))
    assert [(r.city, r.brewery_count) for r in gold.collect()] == [("B", 1)]


def test_check_reports_missing_run_column(spark, root):
    df = spark.createDataFrame([("1", "micro", "US", "CA", "LA")],
                               "id string, brewery_type string, country string, state_province string, city string")
    write_partitioned(df, f"{root}/silver", ("country",))
    with pytest.raises(QualityGateError, match="required_columns_present"):
        check_silver(spark, root, "R1")


def test_check_sees_wrong_run_as_too_few_rows(spark, root):
    ingest(spark, Pages([place("1")]), root, "R1")
    build_silver(spark, root, "R1")
    assert all(c.passed for c in check_silver(spark, root, "R1"))
    with pytest.raises(QualityGateError, match=r"\['minimum_rows'\]"):
        check_silver(spark, root, "R2")


def test_check_empty_table(spark, root):
    silver = spark.createDataFrame([], silver_schema(spark, PLACE_SCHEMA))
    with pytest.raises(QualityGateError, match=r"\['minimum_rows'\]"):
        check_silver(spark, root, "R1", silver=silver)


def test_malformed_line_fails_the_null_id_rule(spark, root, tmp_path):
    path = tmp_path / "lake/raw/run_id=R1"
    path.mkdir(parents=True)
    (path / "part-0.json").write_text(json.dumps(place("1")) + "\n{bad\n")
    build_silver(spark, root, "R1")
    with pytest.raises(QualityGateError, match="null_id_ratio"):
        check_silver(spark, root, "R1")


def test_run_id_with_special_characters(spark, root):
    run_id = "manual__2026-02-28T12:00:00+00:00"
    gold = run_pipeline(spark, Pages([place("1")]), root, run_id)
    assert gold.first().ingestion_run_id == run_id
    assert ingest(spark, Pages([place("1")]), root, run_id) == "skipped"
