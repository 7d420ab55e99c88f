import glob

import pytest
from pyspark.sql import functions as F

from tierbed.functions import run_path
from tierbed.sources import (
    path_exists,
    publish_table,
    published,
    record_fields,
    scan_raw,
    scan_runs,
    scan_table,
    table_path,
    with_other_fields,
    write_partitioned,
    write_raw,
    write_raw_records,
    write_run,
)


def test_raw_keeps_nulls_and_text(spark, root):
    df = spark.createDataFrame([("São", None), ("two\nlines\u2028", 1)], "a string, b int")
    write_raw(df, root, slices=1)
    [file] = glob.glob(f"{root}/part-*.json")
    lines = open(file, encoding="utf-8", newline="").read().split("\n")[:-1]
    assert '{"a":"São","b":null}' in lines and len(lines) == 2
    assert sorted(scan_raw(spark, root, df.schema).collect()) == sorted(df.collect())


def test_line_breaks_between_tokens_do_not_make_more_records(spark, root):
    df = spark.createDataFrame([(1, '{\n "id": "a",\r\n "b": "x\\ny"\n}')], "page int, record string")
    write_raw_records(df, root)
    assert [tuple(r) for r in scan_raw(spark, root, "id string, b string").collect()] == [("a", "x\ny")]


def test_other_fields_follow_the_declared_ones(spark, root):
    write_raw_records(spark.createDataFrame([('{"id": 7, "lat": 1.5}',)], "record string"), root)
    schema = with_other_fields(spark, root, "id string, city string")
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("id", "string"), ("city", "string"), ("lat", "double")
    ]


RECORDS = [
    '{"id": 7, "lat": 1.5, "a b": "x", "n": null, "geo": {"x": [1, 2], "y": {"z": 1e300}}, "m": 1, "Id": 1}',
    '{"id": "s", "m": 2.25, "list": [{"k": true}, {"q": "w"}], "none": {}, "empty": [], "big": 12345678901234567890}',
    '{"`odd` OBJECT<": 1}',
    "{bad",
    "[1]",
    "",
]


def test_fields_gathered_by_the_write_are_those_that_spark_infers(spark, root):
    records = [r.replace(', "Id": 1', "") for r in RECORDS]
    df = spark.createDataFrame([(r,) for r in records], "record string").repartition(3)
    fields = write_raw_records(df, root)
    inferred = scan_raw(spark, root).schema
    got = {f.name: f.dataType for f in fields}
    # Spark leaves out objects that are always empty.
    assert got.pop("none").simpleString() == "string"
    assert got == {f.name: f.dataType for f in inferred if f.name != "_corrupt_record"}
    assert with_other_fields(spark, root, "ID string", fields)["lat"].dataType.simpleString() == "double"
    assert "id" not in with_other_fields(spark, root, "ID string", fields).names


@pytest.mark.parametrize("records", [[], ["{bad", "[1]", "7", "{}"]])
def test_no_fields(spark, root, records):
    df = spark.createDataFrame([(r,) for r in records], "record string")
    assert len(write_raw_records(df, root)) == 0
    assert record_fields("VOID") == record_fields("VARIANT") == record_fields("OBJECT<>")


def test_raw_records_are_written_without_a_shuffle(spark, root, tmp_path):
    df = spark.range(0, 100_000, 1, 11).select(F.to_json(F.struct("id")).alias("record"))
    write_raw_records(df, root)
    assert len(glob.glob(f"{root}/part-*")) == 11


def test_raw_records_are_written_unchanged(spark, root):
    records = ['{"id": 1, "x": null}', '{"id": 2, "y": "é"}', "{bad"]
    df = spark.createDataFrame([(1, r) for r in records], "page int, record string")
    write_raw_records(df, root, slices=3)
    assert len(glob.glob(f"{root}/part-*")) == 3
    assert sorted(r.value for r in spark.read.text(root).collect()) == sorted(records)


def test_hidden_files_are_not_read(spark, root):
    write_raw(spark.createDataFrame([("1",)], "id string"), root)
    open(f"{root}/_metadata.json", "w").write('{"id": "marker"}\n')
    assert [r.id for r in scan_raw(spark, root).collect()] == ["1"]


@pytest.fixture
def coded(spark):
    return spark.createDataFrame([(1, "007"), (2, "7"), (3, ""), (4, None)], "id int, code string")


def test_partition_values_stay_strings(spark, root, coded):
    write_partitioned(coded, root, ("code",))
    declared = scan_table(spark, root, coded.schema)
    found = scan_table(spark, root, partition_cols=("code",))
    for df in (declared, found):
        got = {r.id: r.code for r in df.collect()}
        # A blank partition value comes back as NULL.
        assert got == {1: "007", 2: "7", 3: None, 4: None}


def test_static_and_dynamic_overwrite(spark, root, coded):
    other = spark.createDataFrame([(9, "7")], coded.schema)
    for mode, want in (("dynamic", [1, 3, 4, 9]), ("static", [9])):
        write_partitioned(coded, root, ("code",))
        write_partitioned(other, root, ("code",), overwrite=mode)
        ids = [r.id for r in scan_table(spark, root, coded.schema).collect()]
        assert sorted(ids) == want


def test_a_failed_write_leaves_the_published_table(spark, root, coded):
    publish_table(coded.filter("code is not null"), root, ("code",), note={"n": 1})
    bad = spark.range(4).select(
        F.when(F.col("id") == 3, F.raise_error(F.lit("midway"))).otherwise("x").alias("code"), "id"
    )
    with pytest.raises(Exception, match="midway"):
        publish_table(bad, root, ("code",))
    first = scan_table(spark, table_path(spark, root), coded.schema)
    assert published(spark, root)["note"] == {"n": 1} and first.count() == 3
    # A reader of the first table can go on while the second one is published.
    publish_table(coded.filter("id = 1"), root, ("code",))
    assert first.count() == 3
    assert [r.id for r in scan_table(spark, table_path(spark, root), coded.schema).collect()] == [1]
    publish_table(coded.filter("id = 2"), root, ("code",))
    assert len(glob.glob(f"{root}/v-*")) == 2


def test_few_files_per_partition(spark, root):
    df = spark.range(0, 4000, 1, 8).withColumn("k", (F.col("id") % 20).cast("string"))
    write_partitioned(df, root, ("k",), sort_cols=("id",))
    assert len(glob.glob(f"{root}/k=*/*.parquet")) == 20
    assert spark.read.parquet(root).count() == 4000


@pytest.mark.parametrize(("n", "bytes_per_task"), [(20_000, "200k"), (200_000, "2m")])
def test_hot_partition_value_is_split_over_tasks(spark, root, n, bytes_per_task):
    """A value with 90 % of the rows must not be written by one task, at any size."""
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, bytes_per_task)
    try:
        write_partitioned(df, root, ("k",))
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(f"{root}/k=hot/*.parquet")) >= 3
    assert spark.read.parquet(root).distinct().count() == n


def test_run_scoped_overwrite_keeps_other_runs(spark, root):
    def run(*ids):
        return spark.createDataFrame([(i,) for i in ids], "id int")

    write_run(run(1, 2), root, "20260101")
    write_run(run(3), root, "20260102")
    write_run(run(4), root, "20260101")
    got = {(r.id, r.run_id) for r in scan_runs(spark, root).collect()}
    assert got == {(4, "20260101"), (3, "20260102")}


def test_encoded_run_id_reads_back(spark, root):
    run_id = "manual__2026-02-28T12:00:00+00:00"
    write_run(spark.createDataFrame([(1,)], "id int"), root, run_id)
    assert scan_runs(spark, root).first().run_id == run_id


def test_path_exists(spark, root):
    assert not path_exists(spark, root)
    write_raw(spark.createDataFrame([], "id string"), run_path(root, "R1"))
    assert path_exists(spark, run_path(root, "R1"))
    assert not path_exists(spark, run_path(root, "R2"))
