"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def ordered(rows, names):
    """Rows with columns in name order, in any fixed order."""
    by_name = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in by_name) for row in rows)


def test_every_query_has_an_oracle():
    assert set(entry.table_queries()) == set(entry.table_sql())


@pytest.mark.parametrize("name", sorted(entry.table_queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    result = duck.execute(entry.table_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert ordered(df.collect(), df.columns) == ordered(result.fetchall(), names)


def test_scratch_is_in_the_shared_folder(spark):
    """``spark.checkpoint.dir`` is fixed for a session, so this reads what it has."""
    first, second = entry.scratch(spark, "x"), entry.scratch(spark, "x")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert first != second and "tierbed-x-" in first
    assert shared is None or first.startswith(shared)


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "country", "state_province", "city", "brewery_type", "brewery_count", "ingestion_run_id"
    ]
