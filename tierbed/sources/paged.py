"""Paged record source: executors fetch ranges of pages in parallel.

The rows are ``(page, record)`` with the record kept as its JSON text. Nothing is
typed here, so no field is lost and the raw layer stores what the source sent.
"""

from __future__ import annotations

import base64
import io
import json
import random
import sys
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple, Protocol

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierbed.sources import control
from tierbed.sources.tables import gather_partitions

PAGE_SCHEMA = StructType(
    [StructField("page", LongType(), True), StructField("record", StringType(), True)]
)
# Rows of each page that has any.
COUNT_SCHEMA = StructType(
    [StructField("page", LongType(), True), StructField("rows", LongType(), True)]
)

# Read tasks per core, unless a source limits how many may run at once.
TASKS_PER_CORE = 4
# Pages that a task asks for in a round at most; bounds what a failure can lose.
MAX_TASK_PAGES = 64
# Rows per Arrow batch handed to the JVM; bounds a task's memory whatever the page size.
BATCH_ROWS = 4_096
# Spark's bound on the tasks that list directories; by default it starts one a directory.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# Fixed values of the fetch policy.
RETRY_STATUS = (429, 500, 502, 503, 504)
RETRY_ATTEMPTS = 6
RETRY_FIRST_WAIT_S = 1
RETRY_MAX_WAIT_S = 30


class PageBackend(Protocol):
    """Where pages come from. Must be picklable and give the same page every time."""

    def records(self, page: int, per_page: int) -> Iterator[str]:
        """JSON text of each record of ``page``; nothing for an empty page."""
        ...


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI for use in a task, and the path there."""
    uri = urllib.parse.urlsplit(path)
    if uri.scheme in ("", "file"):
        return pafs.LocalFileSystem(), uri.path
    return pafs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))


class FilePages:
    """Pages stored as JSON-lines files under ``<path>/page=<n>/``.

    ``path`` must be readable from every executor: an absolute path on a shared
    mount, or a URI of a filesystem that pyarrow knows.
    """

    def __init__(self, path: str):
        self.path = path

    def records(self, page: int, per_page: int) -> Iterator[str]:
        fs, root = file_system(self.path)
        listing = pafs.FileSelector(f"{root.rstrip('/')}/page={page}", allow_not_found=True)
        files = [f for f in fs.get_file_info(listing) if f.is_file and f.base_name[0] not in "._"]
        for file in sorted(files, key=lambda f: f.path):
            with fs.open_input_stream(file.path) as stream:
                for line in io.TextIOWrapper(stream, encoding="utf-8", newline="\n"):
                    if line.strip():
                        yield line.rstrip("\n")


class HttpPages:
    """Pages of a REST endpoint that takes ``page`` and ``per_page`` and returns a list.

    At most ``max_concurrency`` tasks ask at once. Records are parsed and written as JSON again.
    """

    def __init__(self, url: str, timeout_s: int = 30, max_concurrency: int = 1):
        self.url = url
        self.timeout_s = timeout_s
        self.max_concurrency = max_concurrency

    def records(self, page: int, per_page: int) -> Iterator[str]:
        query = urllib.parse.urlencode({"page": page, "per_page": per_page})
        for attempt in range(1, RETRY_ATTEMPTS + 1):
            try:
                with urllib.request.urlopen(f"{self.url}?{query}", timeout=self.timeout_s) as reply:
                    rows = json.load(reply)
                break
            except OSError as error:
                # HTTPError and URLError are OSErrors, as are timeouts and lost connections.
                final = isinstance(error, urllib.error.HTTPError) and error.code not in RETRY_STATUS
                if final or attempt == RETRY_ATTEMPTS:
                    raise
                wait = RETRY_FIRST_WAIT_S * 2 ** (attempt - 1) + random.random()
                time.sleep(min(RETRY_MAX_WAIT_S, wait))
        for row in rows:
            yield json.dumps(row, ensure_ascii=False)


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first = first
        self.last = last


class PageReader(DataSourceReader):
    def __init__(
        self,
        backend: PageBackend,
        per_page: int,
        max_pages: int,
        pages_per_task: int,
        first_page: int = 1,
    ):
        self.backend = backend
        self.per_page = per_page
        self.max_pages = max_pages
        self.pages_per_task = pages_per_task
        self.first_page = first_page

    def partitions(self) -> list[PageRange]:
        step = self.pages_per_task
        return [
            PageRange(first, min(first + step - 1, self.max_pages))
            for first in range(self.first_page, self.max_pages + 1, step)
        ]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        for page in range(partition.first, partition.last + 1):
            empty = True
            batch: list[str] = []
            for record in self.backend.records(page, self.per_page):
                empty = False
                batch.append(record)
                if len(batch) == BATCH_ROWS:
                    yield to_batch(page, batch)
                    batch = []
            if batch:
                yield to_batch(page, batch)
            if empty:
                # Later pages of this range lie behind a gap, so no run can keep them.
                return


def to_batch(page: int, records: list[str]) -> pa.RecordBatch:
    columns = [pa.array([page] * len(records), pa.int64()), pa.array(records, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["page", "record"])


class PagedSource(DataSource):
    """The source behind ``read_pages``; its options carry the backend as text."""

    @classmethod
    def name(cls) -> str:
        return "tierbed_pages"

    def schema(self) -> StructType:
        return PAGE_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        backend = cloudpickle.loads(base64.b64decode(self.options["backend"]))
        numbers = (int(self.options[k]) for k in ("per_page", "last", "step", "first"))
        return PageReader(backend, *numbers)


def default_task_pages(pages: int, cores: int, max_concurrency: int | None = None) -> int:
    """Pages per task: a few tasks per core, or as many tasks as may ask at once."""
    return max(1, -(-pages // (max_concurrency or cores * TASKS_PER_CORE)))


def read_pages(
    spark: SparkSession,
    backend: PageBackend,
    per_page: int = 200,
    max_pages: int = 10,
    pages_per_task: int | None = None,
    first_page: int = 1,
) -> DataFrame:
    """Pages ``first_page``..``max_pages`` of ``backend`` as ``(page, record)`` rows.

    One task reads ``pages_per_task`` consecutive pages, by default few enough to
    keep every core busy, or so many that no more tasks run than the backend's
    ``max_concurrency``. A task stops at the first empty page of its range;
    ``contiguous_prefix`` drops what other tasks read behind the first gap. Every
    action on the result fetches again, so write it out before using it twice.
    """
    cores = spark.sparkContext.defaultParallelism
    limit = getattr(backend, "max_concurrency", None)
    step = pages_per_task or default_task_pages(max_pages - first_page + 1, cores, limit)
    # Ship the source code with the plan, so executors need no copy of the package.
    modules = [
        sys.modules[m] for m in {__name__, type(backend).__module__} - {"__main__", "builtins"}
    ]
    cloudpickle.register_pickle_by_value(modules[0])
    for module in modules[1:]:
        cloudpickle.register_pickle_by_value(module)
    try:
        packed = base64.b64encode(cloudpickle.dumps(backend)).decode()
        spark.dataSource.register(PagedSource)
    finally:
        for module in modules:
            cloudpickle.unregister_pickle_by_value(module)
    options = {"per_page": per_page, "last": max_pages, "step": step, "first": first_page}
    return spark.read.format(PagedSource.name()).options(backend=packed, **options).load()


class Staged(NamedTuple):
    """``records(page, record)`` and ``counts(page, rows)`` of staged pages."""

    records: DataFrame
    counts: DataFrame


def place_of(backend: PageBackend) -> str:
    """Where a backend says its pages come from."""
    return str(getattr(backend, "url", None) or getattr(backend, "path", ""))


def stage_pages(
    spark: SparkSession,
    backend: PageBackend,
    path: str,
    per_page: int = 200,
    max_pages: int | None = None,
    pages_per_task: int | None = None,
) -> DataFrame:
    """Write the pages of ``backend`` anew to ``path`` and read them from there."""
    return stage_ranges(spark, backend, path, per_page, max_pages, pages_per_task).records


def stage_ranges(
    spark: SparkSession,
    backend: PageBackend,
    path: str,
    per_page: int = 200,
    max_pages: int | None = None,
    pages_per_task: int | None = None,
    resume: bool = False,
) -> Staged:
    """Write the pages of ``backend`` to ``path``, range by range, and count each page's rows once.

    Stored page files are one range and are read by Spark itself. Other backends are asked in
    rounds, each twice as long as the one before and bounded by ``MAX_TASK_PAGES`` a task, until a
    round meets an empty page. With ``max_pages`` one page more is asked for, which shows whether
    there is more than that.

    A range is committed by a file of its own, after its pages and counts are written. With
    ``resume`` the ranges that an earlier attempt has committed for the same place, page size
    and cap are kept, and fetching goes on behind them.
    """
    source = {"place": place_of(backend), "per_page": per_page, "max_pages": max_pages}
    done = {}
    if resume:
        for name in control.names(spark, f"{path}/ranges"):
            mark = json.loads(control.read_text(spark, f"{path}/ranges/{name}"))
            if mark.pop("source") == source:
                done[mark["first"]] = mark
    if not done:
        control.remove(spark, path)

    def part(kind: str, first: int) -> str:
        return f"{path}/{kind}/from={first}"

    def commit(first: int, last: int | None, pages: DataFrame) -> dict:
        pages.write.mode("overwrite").parquet(part("pages", first))
        staged = spark.read.schema(PAGE_SCHEMA).parquet(part("pages", first))
        counts = staged.groupBy("page").agg(F.count(F.lit(1)).alias("rows"))
        counts.write.mode("overwrite").parquet(part("counts", first))
        # Only a round needs to know whether it met an empty page.
        found = last and spark.read.schema(COUNT_SCHEMA).parquet(part("counts", first)).count()
        mark = {"first": first, "last": last, "found": found}
        control.replace_text(spark, f"{path}/ranges/{first}.json", json.dumps(mark | {"source": source}))
        return mark

    ranges, first = [], 1
    if isinstance(backend, FilePages):
        pages = read_page_files(spark, backend.path)
        if max_pages is not None:
            pages = pages.filter(F.col("page") <= max_pages + 1)
        ranges = [done.get(1) or commit(1, None, pages)]
    else:
        round_pages = spark.sparkContext.defaultParallelism * TASKS_PER_CORE
        most, end = round_pages * MAX_TASK_PAGES, None if max_pages is None else max_pages + 1
        while True:
            if first in done:
                mark = done[first]
            else:
                last = first + round_pages - 1 if end is None else min(first + round_pages - 1, end)
                mark = commit(first, last, read_pages(spark, backend, per_page, last, pages_per_task, first))
            ranges.append(mark)
            if mark["found"] < mark["last"] - first + 1 or mark["last"] == end:
                break
            first, round_pages = mark["last"] + 1, min(2 * round_pages, most)
    firsts = [mark["first"] for mark in ranges]
    return Staged(
        spark.read.schema(PAGE_SCHEMA).parquet(*[part("pages", x) for x in firsts]),
        spark.read.schema(COUNT_SCHEMA).parquet(*[part("counts", x) for x in firsts]),
    )


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Bounds the tasks of a listing meanwhile; a lower bound of the session stays."""
    before = spark.conf.get(LISTING)
    most = spark.sparkContext.defaultParallelism * TASKS_PER_CORE
    spark.conf.set(LISTING, str(min(most, int(before))))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """The page files under ``path`` as ``(page, record)`` rows; large files are read in splits.

    Records end at line feeds; a carriage return is white space between a record's tokens. A store has
    a directory a page, so they are listed by a few tasks per core and not by one a page.
    """
    with _few_listing_tasks(spark):
        files = spark.read.text(path, lineSep="\n")
    if "page" not in files.columns:  # no page at all
        return spark.createDataFrame([], PAGE_SCHEMA)
    page = F.col("page").cast("bigint").alias("page")
    return files.filter(F.trim(F.translate("value", "\r\t", "  ")) != "").select(page, F.col("value").alias("record"))


def write_page_files(df: DataFrame, path: str, page: str = "page") -> None:
    """Store ``df`` as the page files that ``FilePages`` reads; ``page`` names the page."""
    fields = F.struct(*[F.col(c) for c in df.columns if c != page])
    records = df.select(
        F.col(page).alias("page"),
        F.to_json(fields, {"ignoreNullFields": "false"}).alias("record"),
    )
    gathered = gather_partitions(records, ("page",))
    gathered.write.mode("overwrite").partitionBy("page").text(path)
