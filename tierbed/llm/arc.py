"""Legacy ARC archives to WARC.

An ARC archive starts with a version block, whose first number says how many fields each header
line has; every record is a header line, which ends in a declared length, and so many bytes. The
converter reads records by these lengths and makes WARC records with synthesised identifiers,
timestamps, types and digests. Records whose payload another record has already become
revisits. In a WARC archive every record is a gzip member of its own, and an archive ends at a
bound of bytes, however many records a task has. Spark's text sink writes them: a row holds members
without the last byte, which is the highest of a length below 16 MB and so always zero, and
the sink ends each row with that zero. Archives are read back a record at a time.

A task holds one archive as it is stored. Payloads are shuffled once; finding equal payloads moves digests only.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierbed.llm.storage import saved

SALTS = 16
ARCHIVE_BYTES = 8 << 20
# A row of the WARC sink has about so many bytes, an archive so many rows, a gzip member less than
# so many bytes before compression.
ROW_BYTES, ROWS = 1 << 20, 128
MEMBER_BYTES = 1 << 24
# Fixed values of the two formats.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code",
        "Checksum", "Location", "Offset", "Filename", "Archive-length",
    ],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- ARC ----------------------------------------------------------------------------------


def arc_archive(records: list[tuple[str | None, bytes, list[tuple[str, str]]]], version: int,
                name: str, date: str) -> bytes:
    """An ARC archive of ``(url, body, extra HTTP headers)`` records."""
    about = f"{version} 0 tierbed\n{' '.join(ARC_FIELDS[version])}\n".encode()
    extra = "" if version == 1 else " 200 - - 0 " + name
    parts = [f"filedesc://{name} 0.0.0.0 {date} text/plain{extra} {len(about)}\n".encode(), about]
    for url, body, headers in records:
        lines = [("Content-Type", "text/html; charset=utf-8"), *headers, ("Content-Length", str(len(body)))]
        head = "HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
        block = head.encode() + body
        target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
        parts.append(f"\n{target} 0.0.0.0 {date} text/html{extra} {len(block)}\n".encode())
        parts.append(block)
    return b"".join(parts) + b"\n"


def arc_records(content: bytes) -> Iterator[dict]:
    """Records of an ARC archive of either version, plain or gzipped, with ``offset`` and ``block``.

    A length that the archive does not hold is an error, not a shorter record.
    """
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at, fields = 0, None
    while at < len(content):
        if content[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = content.find(b"\n", at)
        line = content[at : end if end >= 0 else len(content)].rstrip(b"\r").decode("utf-8", "replace")
        size = line.rpartition(" ")[2]
        if end < 0 or not size.isdigit() or end + 1 + int(size) > len(content):
            raise ValueError(f"bad ARC record at byte {at}: {line[:200]}")
        block = content[end + 1 : end + 1 + int(size)]
        if fields is None:
            fields = ARC_FIELDS.get(int(block.split(b" ", 1)[0] or 0))
            if not line.startswith("filedesc://") or fields is None:
                raise ValueError(f"no ARC version block: {line[:200]}")
        values = line.rsplit(" ", len(fields) - 1)
        if len(values) != len(fields):
            raise ValueError(f"{len(values)} of {len(fields)} ARC fields at byte {at}: {line[:200]}")
        yield dict(zip(fields, values, strict=True)) | {"offset": at, "block": block}
        at = end + 1 + int(size)


def _arc_of_pages(date: str, id_header: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def archive() -> pa.RecordBatch:
            nonlocal made, held, size
            version, name = 1 + (task + made) % 2, f"pages-{task}-{made}.arc"
            content = arc_archive(held, version, name, date)
            made, held, size = made + 1, [], 0
            return pa.RecordBatch.from_pydict({"name": [name], "content": pa.array([content], pa.binary())})

        for batch in batches:
            columns = (batch.column("id").to_pylist(), batch.column("url").to_pylist(),
                       batch.column("body").cast(pa.binary()).to_pylist())
            for key, url, body in zip(*columns, strict=True):
                held.append((url, body or b"", [] if key is None else [(id_header, str(key))]))
                size += len(body or b"")
                if size >= ARCHIVE_BYTES:
                    yield archive()
        if held:
            yield archive()

    return run


def pages_as_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 body_col: str = "html", date: str = "20240101000000") -> DataFrame:
    """Rows ``name, content``: ARC archives of about 8 MB, versions 1 and 2 in turn, of all pages.

    The id goes into the HTTP header ``X-Page-Id``; null ids leave it out, null URLs become
    ``about:blank``, null bodies are empty.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(body_col).cast("string").alias("body"),
    )
    return rows.mapInArrow(_arc_of_pages(date, "X-Page-Id"), "name string, content binary")


# --- ARC to WARC --------------------------------------------------------------------------

RECORD = (
    "page_id bigint, type string, record_id string, uri string, ip string, date string, "
    "content_type string, payload_digest string, payload_bytes bigint, block_digest string"
)


def _http_header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace") if found else None


def warcinfo_block(block: bytes) -> bytes:
    """The version block of an ARC archive as named fields: its version line, the names of its header
    fields, and any further lines as its description."""
    lines = [x.strip() for x in block.decode("utf-8", "replace").splitlines()]
    names = ["arc-version", "arc-fields"] + ["description"] * len(lines)
    fields = [("software", "tierbed"), ("format", "WARC File Format 1.1")]
    fields += [(name, line) for name, line in zip(names, lines) if line]
    return "".join(f"{name}: {value}\r\n" for name, value in fields).encode()


def warc_block(record: dict) -> bytes:
    """The block of the WARC record equivalent to an ARC record."""
    return warcinfo_block(record["block"]) if record["URL"].startswith("filedesc://") else record["block"]


def warc_fields(record: dict) -> dict:
    """What the WARC record equivalent to an ARC record says in its header. The record on the
    archive itself has no payload."""
    block, url, date = warc_block(record), record["URL"], record["Archive-date"].ljust(14, "0")
    http = block[:5] == b"HTTP/" and not url.startswith("filedesc://")
    head, cut, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
    page = _http_header(head, "X-Page-Id") if http else None
    kind, content = "response", "application/http;msgtype=response"
    if not http:
        kind = "warcinfo" if url.startswith("filedesc://") else "resource"
        content = "application/warc-fields" if kind == "warcinfo" else record["Content-type"]
    name = f"{url} {date} {page} {hashlib.sha1(block).hexdigest()}"
    return {
        "page_id": int(page) if page and re.fullmatch(r"-?\d+", page) else None,
        "type": kind,
        "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        "uri": url,
        "ip": record["IP-address"],
        "date": f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z",
        "content_type": content,
        "payload_digest": None if kind == "warcinfo" else base32_sha1(payload),
        "payload_bytes": 0 if kind == "warcinfo" else len(payload),
        "block_digest": base32_sha1(block),
    }


def _convert(with_block: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, blocks = [], []
                for record in arc_records(batch.column("content")[i].as_py() or b""):
                    rows.append(warc_fields(record))
                    blocks.append(warc_block(record))
                if not rows:
                    continue
                kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64()}
                columns = {k: pa.array([r[k] for r in rows], kinds.get(k, pa.string())) for k in rows[0]}
                if with_block:
                    columns["block"] = pa.array(blocks, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def convert_arc(archives: DataFrame, with_block: bool = True) -> DataFrame:
    """WARC records, one row each, of ARC archives in the column ``content``; plain or gzipped.

    A null or empty archive has no records; a malformed one is an error.
    """
    schema = RECORD + (", block binary" if with_block else "")
    return archives.select("content").mapInArrow(_convert(with_block), schema)


def revisits(records: DataFrame, min_payload: int = 0) -> DataFrame:
    """``page_id, payload_digest`` of responses with a payload that a smaller page has, and which.

    Null page ids come after all others; where all ids are null, none is a revisit. Digests that
    a third of all records share are met in many tasks.
    """
    small = records.filter((F.col("type") == "response") & (F.col("payload_bytes") >= min_payload))
    least = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "record_id", "uri", "date")))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    groups = (
        small.groupBy(F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("n"))
        .agg(least.alias("first"), F.count("*").alias("size"))
        .filter((F.col("size") > 1) & F.col("first").isNotNull())
        .select("d", "n", "first", salts.alias("s"))
    )
    salted = small.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    same = (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("n")) & (F.col("salt") == F.col("s"))
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first.page_id"))
    return (
        salted.join(groups, same)
        .filter(later)
        .groupBy("page_id", "payload_digest")
        .agg(F.min("first").alias("first"))
    )


# --- WARC ---------------------------------------------------------------------------------


def _warc_record(row: dict) -> bytes:
    """A WARC record with the line ends behind it."""
    block, first = row["block"], row["first"]
    if row["type"] == "warcinfo":  # on the archive, not on something fetched
        about = [("WARC-Filename", row["uri"].removeprefix("filedesc://"))]
    else:
        about = [
            ("WARC-Target-URI", row["uri"]),
            ("WARC-IP-Address", row["ip"]),
            ("WARC-Payload-Digest", "sha1:" + row["payload_digest"]),
        ]
    headers = [
        ("WARC-Type", row["type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", row["date"]),
        *about,
        ("WARC-Block-Digest", "sha1:" + row["block_digest"]),
        ("Content-Type", row["content_type"]),
    ]
    if first is not None:
        block = block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
        headers[0] = ("WARC-Type", "revisit")
        headers[6] = ("WARC-Block-Digest", "sha1:" + base32_sha1(block))
        headers += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", first["record_id"]),
            ("WARC-Refers-To-Target-URI", first["uri"]),
            ("WARC-Refers-To-Date", first["date"]),
            ("X-Refers-To-Page-Id", str(first["page_id"])),
        ]
    if row["page_id"] is not None:
        headers.append(("X-Page-Id", str(row["page_id"])))
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def gzip_member(record: bytes) -> bytes:
    """A record as a gzip member; one of 16 MB or more as several, each with a length below that."""
    most = MEMBER_BYTES - 1
    return b"".join(gzip.compress(record[a : a + most], 6, mtime=0) for a in range(0, len(record), most))


def _warc_members(row_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def row() -> pa.RecordBatch:
            nonlocal held, size
            content = b"".join(held)
            held, size = [], 0
            return pa.RecordBatch.from_pydict({"members": pa.array([content[:-1]], pa.binary())})

        for batch in batches:
            for a in range(0, batch.num_rows, 50):
                for record in batch.slice(a, 50).to_pylist():
                    member = gzip_member(_warc_record(record))
                    if held and size + len(member) > row_bytes:
                        yield row()
                    held.append(member)
                    size += len(member)
        if held:
            yield row()

    return run


def write_warc(records: DataFrame, repeats: DataFrame, path: str, row_bytes: int = ROW_BYTES, rows: int = ROWS) -> None:
    """Writes ``records`` as WARC archives, those in ``repeats`` as revisits, a gzip member a record.

    An archive has at most ``rows`` times ``row_bytes`` (128 MB), or ``rows`` times the largest
    compressed record where that is more.
    """
    again = repeats.select(F.col("page_id").alias("p"), F.col("payload_digest").alias("d"), "first")
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("payload_digest") == F.col("d"))
    joined = records.join(again, same & (F.col("type") == "response"), "left").drop("p", "d")
    members = joined.mapInArrow(_warc_members(row_bytes), "members binary")
    sink = members.select(F.col("members").cast("string")).write.option("maxRecordsPerFile", rows)
    sink.option("lineSep", "\0").option("compression", "none").text(path)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, with lower-case names, and block of every record of a WARC archive."""
    source = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        source = io.BufferedReader(gzip.GzipFile(fileobj=source))
    at = 0
    while first := source.readline():
        lines = []
        while (line := source.readline()).strip():
            lines.append(line.decode("utf-8", "replace"))
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = headers.get("content-length", "")
        block = source.read(int(size)) if size.isdigit() else b""
        whole = size.isdigit() and len(block) == int(size) and source.read(4) == b"\r\n\r\n"
        if not first.startswith(b"WARC/") or not whole:
            raise ValueError(f"bad WARC record at byte {at}: {first[:200]!r}")
        yield headers, block
        at = source.tell()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("page_id", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("uri", pa.string()),
         ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
         ("refers_to_id", pa.string())]
    )
    for batch in batches:
        for i in range(batch.num_rows):
            rows = []
            for headers, block in warc_records(batch.column("content")[i].as_py()):
                kind = headers["warc-type"]
                digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                http = headers["content-type"].startswith("application/http")
                head, _, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
                if kind == "revisit":
                    size = int(_http_header(head, "Content-Length") or 0)
                elif kind == "warcinfo":
                    size = 0
                    if "sha1:" + base32_sha1(block) != headers["warc-block-digest"]:
                        raise ValueError(f"{headers['warc-record-id']}: block and digest differ")
                else:
                    size = len(payload)
                    if base32_sha1(payload) != digest:
                        raise ValueError(f"{headers['warc-record-id']}: payload and digest differ")
                page, first = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                rows.append(
                    {
                        "page_id": int(page) if page else None,
                        "type": kind,
                        "record_id": headers["warc-record-id"],
                        "uri": headers.get("warc-target-uri"),
                        "payload_digest": digest,
                        "payload_bytes": size,
                        "refers_to": int(first) if first else None,
                        "refers_to_id": headers.get("warc-refers-to"),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC archives under ``path``; payloads are checked by digest."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(
        _read,
        "page_id bigint, type string, record_id string, uri string, payload_digest string, "
        "payload_bytes bigint, refers_to bigint, refers_to_id string",
    )


def convert_pages(pages: DataFrame, path: str, min_payload: int = 0) -> DataFrame:
    """Pages as ARC archives, these as WARC archives under ``path``, and those read back.

    Rows as in :func:`read_warc`. Null ids, URLs and bodies as in :func:`pages_as_arc`. Rows alike
    in id and body are all responses, or all revisits of a smaller id. Other columns are
    ignored; an empty table writes no record.
    """
    archives = pages_as_arc(pages)
    digests = saved(convert_arc(archives, with_block=False), "arc-digests")
    write_warc(convert_arc(archives), revisits(digests, min_payload), path)
    return read_warc(pages.sparkSession, path)
