"""Readers and writers: pages, raw JSON lines, Parquet tables."""

from tierbed.sources.paged import (
    FilePages,
    HttpPages,
    PageBackend,
    file_system,
    read_page_files,
    read_pages,
    stage_pages,
    stage_ranges,
    write_page_files,
)
from tierbed.sources.raw import (
    record_fields,
    scan_raw,
    with_other_fields,
    write_raw,
    write_raw_records,
)
from tierbed.sources.tables import (
    path_exists,
    publish_table,
    published,
    scan_runs,
    scan_table,
    table_path,
    write_partitioned,
    write_run,
)

__all__ = [
    "FilePages",
    "HttpPages",
    "PageBackend",
    "file_system",
    "path_exists",
    "publish_table",
    "published",
    "read_page_files",
    "read_pages",
    "record_fields",
    "scan_raw",
    "scan_runs",
    "scan_table",
    "stage_pages",
    "stage_ranges",
    "table_path",
    "with_other_fields",
    "write_page_files",
    "write_partitioned",
    "write_raw",
    "write_raw_records",
    "write_run",
]
