from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierbed.functions import fill_default, new_run_id, output_slices, run_id_text, run_path

SLICES = [(0, 1), (499, 1), (500, 1), (1000, 2), (3999, 7), (4000, 8), (99999, 8)]


def values(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_fill_default_casts_before_coalesce(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(7,), (None,)], "city bigint")
        assert values(df.select(fill_default("city"))) == ["7", "UNKNOWN"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_fill_default_chain_and_blank(spark):
    df = spark.createDataFrame(
        [("a", "b"), (None, "b"), (None, None), ("", "b"), (" ", None)], "x string, y string"
    )
    assert values(df.select(fill_default("x", "y"))) == ["a", "b", "UNKNOWN", "", " "]
    filled = fill_default("x", "y", default="?", blank_as_missing=True)
    assert values(df.select(filled)) == ["a", "b", "?", "b", "?"]


def test_output_slices_int_and_column_agree(spark):
    df = spark.createDataFrame(SLICES, "n bigint, want bigint")
    assert [output_slices(n) for n, _ in SLICES] == [want for _, want in SLICES]
    assert df.filter(output_slices(F.col("n")) != F.col("want")).count() == 0
    assert output_slices(99999, max_slices=64, rows_per_slice=2000) == 49


def test_run_id_text_matches_python(spark):
    instant = datetime(2026, 2, 28, 12, 0, 5, 999999)
    df = spark.createDataFrame([(instant,)], "ts timestamp_ntz")
    assert values(df.select(run_id_text("ts"))) == ["20260228T120005"]
    assert datetime.strptime(new_run_id(), "%Y%m%dT%H%M%S")


def test_run_path_strips_slash_and_encodes():
    assert run_path("s3a://lake/raw/", "20260228T120000") == "s3a://lake/raw/run_id=20260228T120000"
    assert run_path("/lake", "manual__2026-02-28T12:00:00+00:00").endswith(
        "run_id=manual__2026-02-28T12%3A00%3A00+00%3A00"
    )


def test_run_id_text_in_other_time_zones(spark):
    """Instants are told in UTC; wall times stand as they are, also in a gap of daylight saving."""
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            row = spark.sql(
                "SELECT timestamp'2026-01-05T12:00:05Z' AS t, timestamp'2026-11-01T05:30:00.9Z' AS u,"
                " timestamp_ntz'2026-03-08 02:30:00' AS n, timestamp'1969-12-31T23:59:59.5Z' AS o"
            ).select(*[run_id_text(c).alias(c) for c in "tuno"]).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert tuple(row) == ("20260105T120005", "20261101T053000", "20260308T023000", "19691231T235959")
