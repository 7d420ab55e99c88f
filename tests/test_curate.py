import json

from tierbed.operators import FillRule, curate
from tierbed.plans import PLACE_RULES, PLACE_SCHEMA
from tierbed.sources import scan_raw

ROWS = [
    ("p-17", "Alte Muehle", "tasting room", "Norway", "Vestland", None, "Bergen"),
    ("p-18", "Sur le Pont", "nano", None, None, None, None),
]


def write_lines(path, *lines):
    path.mkdir()
    (path / "part-0.json").write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")
    return str(path)


def test_fills_and_stamps(spark):
    out = curate(spark.createDataFrame(ROWS, PLACE_SCHEMA), "R1", PLACE_RULES)
    first, second = out.orderBy("id").collect()
    assert (first.country, first.state_province, first.city) == ("Norway", "Vestland", "Bergen")
    assert first.state == "Vestland" and first.name == "Alte Muehle"
    assert (second.country, second.state_province, second.city) == ("UNKNOWN",) * 3
    assert second.state is None
    assert first.ingestion_run_id == "R1"
    assert first.ingestion_ts_utc == second.ingestion_ts_utc is not None


def test_own_rules(spark):
    df = spark.createDataFrame([(None, 3)], "a int, b int")
    out = curate(df, "R1", (FillRule("c", ("a", "b"), "none"), FillRule("a", ("a",), "0")))
    assert (out.first().a, out.first().b, out.first().c) == ("0", 3, "3")


def test_numeric_field_declared_and_inferred(spark, tmp_path):
    path = write_lines(
        tmp_path / "raw",
        json.dumps({"id": "1", "country": "x", "state_province": "y", "state": None, "city": 7}),
        json.dumps({"id": "2", "country": "x", "state_province": "y", "state": None, "city": None}),
    )
    for schema in (PLACE_SCHEMA, None):
        out = curate(scan_raw(spark, path, schema), "R1", PLACE_RULES).orderBy("id")
        assert [r.city for r in out.collect()] == ["7", "UNKNOWN"]


def test_absent_field_and_malformed_line_with_declared_schema(spark, tmp_path):
    path = write_lines(tmp_path / "raw", '{"id": "1", "city": "LA"}', "{bad")
    out = curate(scan_raw(spark, path, PLACE_SCHEMA), "R1", PLACE_RULES)
    rows = {r.id: r for r in out.collect()}
    assert set(rows) == {"1", None}
    assert rows["1"].state_province == "UNKNOWN" and rows["1"].city == "LA"


def test_zero_byte_input(spark, tmp_path):
    path = write_lines(tmp_path / "raw")
    assert curate(scan_raw(spark, path, PLACE_SCHEMA), "R1", PLACE_RULES).count() == 0


def test_blank_is_kept_unless_asked(spark):
    df = spark.createDataFrame([("", "s", "")], "country string, state string, city string")
    rules = (FillRule("country", ("country",)), FillRule("city", ("city", "state")))
    kept, filled = curate(df, "R1", rules).first(), curate(df, "R1", rules, True).first()
    assert (kept.country, kept.city) == ("", "")
    assert (filled.country, filled.city) == ("UNKNOWN", "s")
