import io
import json
import os
import urllib.error
from collections import Counter
from uuid import uuid4

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierbed.operators import contiguous_prefix, fetch_totals, prefix_totals
from tierbed.sources import (
    FilePages,
    HttpPages,
    paged,
    read_page_files,
    read_pages,
    stage_pages,
    stage_ranges,
    write_page_files,
)
from tierbed.sources.paged import PageReader, default_task_pages


class ListPages:
    """Pages held in memory."""

    def __init__(self, pages):
        self.pages = pages

    def records(self, page, per_page):
        return iter(json.dumps(r) for r in self.pages.get(page, []))


def brute_prefix(pages):
    kept, page = [], 1
    while page in pages:
        kept += [p for p in pages if p == page]
        page += 1
    return kept


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 9), max_size=25))
def test_prefix_against_brute_force(spark, pages):
    df = spark.createDataFrame([(p,) for p in pages], "page bigint")
    assert sorted(r.page for r in contiguous_prefix(df).collect()) == sorted(brute_prefix(pages))


@pytest.mark.parametrize(
    ("pages", "cap", "want"),
    [([1, 2, 4], None, [1, 2]), ([2, 3], None, []), ([1, 2, 3], 2, [1, 2]), ([1], None, [1])],
)
def test_prefix_cases(spark, pages, cap, want):
    df = spark.createDataFrame([(p,) for p in pages], "page bigint")
    assert sorted(r.page for r in contiguous_prefix(df, max_pages=cap).collect()) == want


def test_fetch_totals(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "page bigint")
    assert tuple(fetch_totals(df).first()) == (3, 2)


@pytest.mark.parametrize(
    ("counts", "cap", "want"),
    [
        ([(1, 5), (2, 3), (4, 9)], None, (8, 2, False)),
        ([(1, 5), (2, 3), (3, 1)], 2, (8, 2, True)),
        ([(1, 5), (2, 3), (3, 1)], 3, (9, 3, False)),
        ([(2, 3)], 7, (0, 0, False)),
        ([], None, (0, 0, False)),
    ],
)
def test_prefix_totals(spark, counts, cap, want):
    df = spark.createDataFrame(counts, "page bigint, rows bigint")
    assert tuple(prefix_totals(df, cap).first()) == want


class Failing(ListPages):
    """Fails from a page on while a file is there; notes each page that it has given."""

    def __init__(self, pages, notes, fails_from):
        super().__init__(pages)
        self.notes, self.fails_from = str(notes), fails_from

    def records(self, page, per_page):
        if page >= self.fails_from and os.path.exists(f"{self.notes}/down"):
            raise OSError("source is down")
        with open(f"{self.notes}/{page}-{uuid4().hex}", "w"):
            return super().records(page, per_page)


def asked(notes):
    return Counter(int(f.name.split("-")[0]) for f in notes.iterdir() if "-" in f.name)


def test_a_restart_keeps_committed_ranges(spark, tmp_path):
    n = 5 * spark.sparkContext.defaultParallelism * paged.TASKS_PER_CORE
    notes = tmp_path / "notes"
    notes.mkdir()
    (notes / "down").touch()
    first = spark.sparkContext.defaultParallelism * paged.TASKS_PER_CORE
    backend = Failing({p: [{"id": p}] * (p % 3 + 1) for p in range(1, n + 1)}, notes, first + 1)
    where = str(tmp_path / "staging")
    with pytest.raises(Exception, match="source is down"):
        stage_ranges(spark, backend, where)
    (notes / "down").unlink()
    staged = stage_ranges(spark, backend, where, resume=True)
    assert {p: c for p, c in asked(notes).items() if p <= n} == dict.fromkeys(range(1, n + 1), 1)
    assert {r.page: r.rows for r in staged.counts.collect()} == {p: p % 3 + 1 for p in range(1, n + 1)}
    assert staged.records.count() == sum(p % 3 + 1 for p in range(1, n + 1))
    # Complete: nothing is asked again. Another page size is another source.
    before = asked(notes)
    stage_ranges(spark, backend, where, resume=True)
    assert asked(notes) == before
    stage_ranges(spark, backend, where, per_page=7, resume=True)
    assert asked(notes)[1] == 2


def test_carriage_returns_do_not_end_records(spark, tmp_path):
    path = tmp_path / "pages/page=1"
    path.mkdir(parents=True)
    (path / "part-0.txt").write_bytes(b'{"id": 1,\r "a": 2}\r\n\r\n{"id": 2}\n')
    rows = [json.loads(r.record) for r in read_page_files(spark, str(tmp_path / "pages")).collect()]
    assert rows == [{"id": 1, "a": 2}, {"id": 2}]
    assert [json.loads(r) for r in FilePages(str(tmp_path / "pages")).records(1, 9)] == rows


def test_read_pages_from_backend(spark):
    pages = {1: [{"id": 1}, {"id": 2}], 2: [{"id": 3}], 4: [{"id": 5}]}
    df = read_pages(spark, ListPages(pages), max_pages=10, pages_per_task=1)
    assert df.rdd.getNumPartitions() == 10
    got = sorted((r.page, json.loads(r.record)["id"]) for r in df.collect())
    assert got == [(1, 1), (1, 2), (2, 3), (4, 5)]


def test_two_sources_do_not_mix(spark):
    first = read_pages(spark, ListPages({1: [{"id": 1}]}), max_pages=2)
    second = read_pages(spark, ListPages({1: [{"id": 2}]}), max_pages=2)
    assert [r.record for r in first.collect()] == ['{"id": 1}']
    assert [r.record for r in second.collect()] == ['{"id": 2}']


def test_task_stops_at_first_empty_page_of_its_range():
    asked = []

    class Spy(ListPages):
        def records(self, page, per_page):
            asked.append(page)
            return super().records(page, per_page)

    reader = PageReader(Spy({1: [{}], 2: [{}], 4: [{}]}), 200, 9, 5)
    first, second = reader.partitions()
    assert [(p.first, p.last) for p in (first, second)] == [(1, 5), (6, 9)]
    rows = sum(b.num_rows for b in reader.read(first)) + sum(b.num_rows for b in reader.read(second))
    assert rows == 2 and asked == [1, 2, 3, 6]


def test_large_page_is_read_in_bounded_batches():
    n = 3 * paged.BATCH_ROWS + 1
    reader = PageReader(ListPages({1: [{"i": i} for i in range(n)]}), 200, 1, 1)
    sizes = [b.num_rows for b in reader.read(reader.partitions()[0])]
    assert sum(sizes) == n and max(sizes) <= paged.BATCH_ROWS


def test_task_count_is_bounded():
    assert default_task_pages(10, 8) == 1
    assert default_task_pages(1000, 8) == 32
    for pages in (10, 1_000, 500_000_000):
        assert -(-pages // default_task_pages(pages, 8)) <= 8 * paged.TASKS_PER_CORE
        assert -(-pages // default_task_pages(pages, 8, max_concurrency=3)) <= 3


def test_concurrency_limit_of_a_backend(spark):
    backend = ListPages({p: [{"id": p}] for p in range(1, 8)})
    backend.max_concurrency = 2
    df = read_pages(spark, backend, max_pages=7)
    assert df.rdd.getNumPartitions() == 2 and df.count() == 7


def test_rounds_go_on_until_an_empty_page(spark, tmp_path):
    n = 3 * spark.sparkContext.defaultParallelism * paged.TASKS_PER_CORE + 5
    backend = ListPages({p: [{"id": p}] for p in range(1, n + 1)})
    staged = stage_pages(spark, backend, str(tmp_path / "all"))
    assert sorted(r.page for r in staged.collect()) == list(range(1, n + 1))
    capped = stage_pages(spark, backend, str(tmp_path / "capped"), max_pages=3)
    assert sorted(r.page for r in capped.collect()) == [1, 2, 3, 4]


def test_page_files_read_by_spark(spark, tmp_path):
    path = str(tmp_path / "pages")
    rows = [(1, 1, "é"), (2, 1, None), (3, 12, "x\ny")]
    write_page_files(spark.createDataFrame(rows, "id int, page int, name string"), path)
    got = sorted((r.page, json.loads(r.record)["id"]) for r in read_page_files(spark, path).collect())
    assert got == [(1, 1), (1, 2), (12, 3)]
    write_page_files(spark.createDataFrame([], "id int, page int"), str(tmp_path / "none"))
    assert read_page_files(spark, str(tmp_path / "none")).collect() == []


def test_page_files(spark, tmp_path):
    path = str(tmp_path / "pages")
    rows = [(1, 1, "é"), (2, 1, None), (3, 2, "x\ny")]
    write_page_files(spark.createDataFrame(rows, "id int, page int, name string"), path)
    for location in (path, f"file:{path}", f"file://{path}/"):
        backend = FilePages(location)
        first = sorted((json.loads(r) for r in backend.records(1, 200)), key=lambda r: r["id"])
        assert first == [{"id": 1, "name": "é"}, {"id": 2, "name": None}]
        assert [json.loads(r) for r in backend.records(2, 200)] == [{"id": 3, "name": "x\ny"}]
        assert list(backend.records(3, 200)) == []


def http_error(code):
    return urllib.error.HTTPError("http://x", code, "", {}, io.BytesIO())


@pytest.fixture
def replies(monkeypatch):
    """Answers for urlopen in order, and the URLs asked for."""
    script, asked = [], []

    def urlopen(url, timeout):
        asked.append((url, timeout))
        reply = script.pop(0)
        if isinstance(reply, Exception):
            raise reply
        return io.BytesIO(json.dumps(reply).encode())

    monkeypatch.setattr(paged.urllib.request, "urlopen", urlopen)
    monkeypatch.setattr(paged.time, "sleep", lambda s: None)
    return script, asked


def test_http_retries_transient_errors(replies):
    script, asked = replies
    script += [http_error(429), TimeoutError(), urllib.error.URLError("lost"), [{"a": "é"}]]
    assert list(HttpPages("http://x/v1", 5).records(2, 50)) == ['{"a": "é"}']
    assert asked == [("http://x/v1?page=2&per_page=50", 5)] * 4


def test_http_fails_at_once_on_other_errors(replies):
    script, asked = replies
    script += [http_error(404), []]
    with pytest.raises(urllib.error.HTTPError):
        list(HttpPages("http://x").records(1, 50))
    assert len(asked) == 1


def test_http_gives_up_after_six_attempts(replies):
    script, asked = replies
    script += [http_error(503)] * 9
    with pytest.raises(urllib.error.HTTPError):
        list(HttpPages("http://x").records(1, 50))
    assert len(asked) == 6


def test_page_files_are_listed_by_few_tasks(spark, tmp_path):
    bound = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    path, before = str(tmp_path / "store"), spark.conf.get(bound)
    write_page_files(spark.range(100).select("id", (F.col("id") + 1).alias("page")), path)
    sc = spark.sparkContext
    sc.setJobGroup("listing", "")
    try:
        pages = read_page_files(spark, path)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert 0 < max(tracker.getStageInfo(s).numTasks for s in stages) <= 4 * sc.defaultParallelism
    assert spark.conf.get(bound) == before
    assert sorted(r.page for r in pages.collect()) == list(range(1, 101))
