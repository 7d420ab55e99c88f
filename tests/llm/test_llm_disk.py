"""What operators leave on disk."""

import glob
import os
import tempfile
import time
from uuid import uuid4

from pyspark.sql import functions as F

from tierbed.llm import storage
from tierbed.llm.suffix_tree import suffix_tree_scores


def _shuffle_files(spark):
    root = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())
    return {f for one in root.split(",") for f in glob.glob(f"{one}/blockmgr-*/*/shuffle_*.data")}


def test_suffix_tree_keeps_only_tables_that_are_read_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "scratch", lambda spark, label: f"{tmp_path}/{label}-{uuid4().hex}")
    docs = spark.range(60).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a b c d"), F.col("id") % 7, F.lit("e f")).alias("text")
    )
    scores = suffix_tree_scores(docs, F.col("doc_id") % 5 != 2)
    left = sorted(path.name.rsplit("-", 1)[0] for path in tmp_path.iterdir())
    assert left == ["tree-others", "tree-scored", "tree-weights"]
    assert scores.count() == 60 and {r.n_tokens for r in scores.collect()} == {8}


def test_tidy_tables_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "scratch", lambda spark, label: f"{tmp_path}/{label}-{uuid4().hex}")
    before = _shuffle_files(spark)
    rows = storage.saved(spark.range(1000).groupBy(F.col("id") % 10).count(), "counted", tidy=True)
    end = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert rows.count() == 10


def test_suffix_tree_scores_are_read_without_new_shuffles(spark, tmp_path, monkeypatch):
    """All that documents look up is gone when the scores are there, and reading them moves nothing."""
    monkeypatch.setattr(storage, "scratch", lambda spark, label: f"{tmp_path}/{label}-{uuid4().hex}")
    docs = spark.range(60).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a b c d"), F.col("id") % 7, F.lit("e f")).alias("text")
    )
    before = _shuffle_files(spark)
    scores = suffix_tree_scores(docs, F.col("doc_id") % 5 != 2)
    assert len(scores.collect()) == 60
    end = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
