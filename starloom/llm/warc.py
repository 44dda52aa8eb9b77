"""WARC records in ZIP archives: written by Spark tasks, read back by byte ranges.

An archive holds stored (uncompressed) members: WARC files whose records are gzipped one
by one, and an index with a line per record.  Reading never unpacks an archive.  A task
reads an archive's end record and central directory (ZIP64 too), finds where its stored
members begin, and reads the index; the index lines are dealt over the cluster, and each
record is then fetched by its own range.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.sources.scratch import Workspace

#: Fixed values of the ZIP format: signatures, sizes, and the marks that send to ZIP64.
LOCAL_HEADER = b"PK\x03\x04"
CENTRAL_ENTRY = b"PK\x01\x02"
END_RECORD = b"PK\x05\x06"
END64_RECORD = b"PK\x06\x06"
END64_LOCATOR = b"PK\x06\x07"
END_BYTES, END64_BYTES, LOCATOR_BYTES, ENTRY_BYTES, LOCAL_BYTES = 22, 56, 20, 46, 30
LONGEST_COMMENT = 0xFFFF
IN_ZIP64_16, IN_ZIP64_32, ZIP64_FIELD = 0xFFFF, 0xFFFFFFFF, 0x0001
STORED = 0

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

# An archive is closed once it has so many records or bytes; the next one is begun.
ARCHIVE_RECORDS, ARCHIVE_BYTES = 50_000, 1 << 30
INDEX_ROWS_OUT, RECORD_BYTES_OUT = 10_000, 8 << 20


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# --- records -----------------------------------------------------------------------


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(value: object) -> str:
    """A header value stays on its line."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in str(value))


def record_bytes(
    record_id: str, url: str | None, payload: bytes, digest: str, page: str | None,
    refers_to_id: str | None, refers_to_page: str | None,
) -> bytes:
    """One WARC record: a response, or a revisit where ``refers_to_id`` is given.

    A revisit has the response's HTTP header, which tells the payload's length, and no
    payload.
    """
    revisit = refers_to_id is not None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", refers_to_id),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("X-Page-ID", page),
        ("X-Refers-To-Page-ID", refers_to_page),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(body)),
    ]
    lines = [f"{k}: {_header_value(v)}" for k, v in fields if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


def parse_headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def parse_record(data: bytes) -> dict:
    """Headers, payload (None for a revisit), its length and its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = parse_headers(head)
    http, _, payload = rest[: int(headers["content-length"])].partition(b"\r\n\r\n")
    length = int(parse_headers(http)["content-length"])
    stated = headers["warc-payload-digest"].removeprefix("sha1:")
    revisit = headers["warc-type"] == "revisit"
    if not revisit and (len(payload) != length or base32_sha1(payload) != stated):
        raise ValueError(f"damaged record {headers['warc-record-id']}")
    return {
        "headers": headers, "payload": None if revisit else payload,
        "payload_bytes": length, "payload_digest": stated,
    }


# --- ZIP directories ---------------------------------------------------------------


def _zip64_values(extra: bytes) -> bytes:
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_FIELD:
            return extra[at + 4 : at + 4 + size]
        at += 4 + size
    return b""


def central_directory(file, size: int) -> list[dict]:
    """The members that an archive's central directory lists, ZIP64 values put in."""
    tail_at = max(0, size - END_BYTES - LONGEST_COMMENT)
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(END_RECORD)
    while end >= 0 and end + END_BYTES + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
        end = tail.rfind(END_RECORD, 0, end)
    if end < 0:
        raise ValueError("not a ZIP archive")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if count == IN_ZIP64_16 or IN_ZIP64_32 in (length, start):
        locator = file.read_at(LOCATOR_BYTES, tail_at + end - LOCATOR_BYTES)
        if not locator.startswith(END64_LOCATOR):
            raise ValueError("the ZIP64 locator is missing")
        record = file.read_at(END64_BYTES, struct.unpack_from("<Q", locator, 8)[0])
        if not record.startswith(END64_RECORD):
            raise ValueError("the ZIP64 end record is missing")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, members, at = file.read_at(length, start), [], 0
    for _ in range(count):
        if directory[at : at + 4] != CENTRAL_ENTRY:
            raise ValueError("damaged central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, whole, name_size, extra_size, comment_size = struct.unpack_from(
            "<IIHHH", directory, at + 20
        )
        header_at = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + ENTRY_BYTES : at + ENTRY_BYTES + name_size]
        extra_at = at + ENTRY_BYTES + name_size
        wide, used = _zip64_values(directory[extra_at : extra_at + extra_size]), 0
        values = []
        for value in (whole, packed, header_at):
            if value == IN_ZIP64_32:
                value = struct.unpack_from("<Q", wide, used)[0]
                used += 8
            values.append(value)
        members.append(
            {"name": name.decode("utf-8"), "method": method, "size": values[0],
             "packed": values[1], "header_at": values[2]}
        )
        at = extra_at + extra_size + comment_size
    return members


def data_start(file, member: dict) -> int:
    """Where a stored member's bytes begin."""
    if member["method"] != STORED:
        raise ValueError(f"{member['name']} is compressed; its records have no ranges")
    header = file.read_at(LOCAL_BYTES, member["header_at"])
    if not header.startswith(LOCAL_HEADER):
        raise ValueError("damaged local header")
    return member["header_at"] + LOCAL_BYTES + sum(struct.unpack_from("<HH", header, 26))


def archive_index(uri: str) -> Iterator[dict]:
    """All lines of an archive's indexes, with the records' places in the archive."""
    system, path = filesystem(uri)
    with system.open_input_file(path) as file:
        members = {m["name"]: m for m in central_directory(file, file.size())}
        starts = {n: data_start(file, m) for n, m in members.items() if n.startswith("archive/")}
        for name, member in members.items():
            if name.startswith("indexes/"):
                for line in file.read_at(member["size"], data_start(file, member)).splitlines():
                    entry = json.loads(line.split(b" ", 2)[2])
                    at = starts[entry["filename"]] + entry["offset"]
                    yield {"archive": uri, "at": at, "length": entry["length"]}


# --- Spark jobs --------------------------------------------------------------------

MANIFEST = "archive string, records bigint, bytes bigint"
INDEX = "archive string, at bigint, length bigint"


def packed_payloads(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """Each row's payload deflated, with its length and digest."""
    kind = pages.schema[key].dataType.simpleString()
    given = pages.select(
        F.col(f"`{key}`").alias("page"), F.col(f"`{url}`").alias("url"), F.col(f"`{payload}`").alias("payload")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [(p.as_py() or "").encode() for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([zlib.compress(p, 6) for p in payloads], pa.binary()),
                 pa.array([len(p) for p in payloads], pa.int64()),
                 pa.array([base32_sha1(p) for p in payloads], pa.string())],
                ["page", "url", "packed", "bytes", "digest"],
            )

    return given.mapInArrow(
        run, f"page {kind}, url string, packed binary, bytes bigint, digest string"
    ).withColumn("row", F.monotonically_increasing_id())


def with_revisits(pages: DataFrame, work: Workspace, key: str, url: str, payload: str, least: int):
    """Rows to be written: which payload was met first, and which rows repeat it.

    Of equal payloads of at least ``least`` bytes the smallest key is the response (null
    last; of repeated rows the first).  Both sides of the join are written tables, so a
    payload that a third of the rows share is split by adaptive execution.
    """
    rows = work.stage(packed_payloads(pages, key, url, payload), "rows")
    order = F.struct(F.col("page").isNull().alias("last"), "page", "row")
    first = (
        rows.filter(F.col("bytes") >= least)
        .groupBy(F.col("digest").alias("first_digest"))
        .agg(F.min(order).alias("first"))
    )
    first = work.stage(first, "first")
    revisits = F.col("first.row").isNotNull() & (F.col("first.row") != F.col("row"))
    return rows.join(first, F.col("digest") == F.col("first_digest"), "left").select(
        "page", "url", "packed", "digest", "row",
        F.when(revisits, F.col("first.row")).alias("refers_row"),
        F.when(revisits, F.col("first.page")).alias("refers_page"),
    )


class _ArchiveWriter:
    """One archive, written as a stream and named only when it is complete."""

    def __init__(self, root: str, name: str):
        self.system, folder = filesystem(root)
        self.uri, self.final = f"{root}/{name}", f"{folder}/{name}"
        self.draft = f"{folder}/_{name}.{TaskContext.get().taskAttemptId()}"
        self.out = self.system.open_output_stream(self.draft)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(WARC_MEMBER, "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, url: str, record: bytes) -> None:
        packed = gzip.compress(record, compresslevel=6, mtime=0)
        self.member.write(packed)
        place = {"offset": self.at, "length": len(packed), "filename": WARC_MEMBER}
        key = _header_value(url).replace(" ", "%20") or "-"
        self.lines.append(f"{key} {DATE} {json.dumps(place)}")
        self.at += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(INDEX_MEMBER, "\n".join(sorted(self.lines)))
        self.zip.close()
        self.out.close()
        self.system.move(self.draft, self.final)
        return self.uri, len(self.lines), self.at


def write_archives(rows: DataFrame, root: str) -> DataFrame:
    """Writes ``with_revisits`` rows below ``root``; gives a row per archive.

    Archives are named by partition and number, so a task that runs again replaces its own.
    """
    filesystem_of, folder = filesystem(root)
    filesystem_of.create_dir(folder, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, writer, done = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for row in zip(*batch.columns):
                page, url, packed, digest, row_id, refers_row, refers_page = (v.as_py() for v in row)
                if writer is None:
                    writer = _ArchiveWriter(root, f"part-{part:06d}-{number:04d}.zip")
                text = None if page is None else str(page)
                record = record_bytes(
                    f"<urn:x-row:{row_id}>", url, zlib.decompress(packed), digest, text,
                    None if refers_row is None else f"<urn:x-row:{refers_row}>",
                    None if refers_page is None else str(refers_page),
                )
                writer.add(url or "", record)
                if len(writer.lines) >= ARCHIVE_RECORDS or writer.at >= ARCHIVE_BYTES:
                    done.append(writer.close())
                    writer, number = None, number + 1
        if writer is not None:
            done.append(writer.close())
        columns = list(zip(*done)) or [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["archive", "records", "bytes"]
        )

    return rows.mapInArrow(run, MANIFEST)


def read_index(archives: DataFrame) -> DataFrame:
    """One row per record of the archives, with its byte range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("at", pa.int64()), ("length", pa.int64())])
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows = []
                for row in archive_index(uri):
                    rows.append(row)
                    if len(rows) == INDEX_ROWS_OUT:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select("archive").mapInArrow(run, INDEX)


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Fetches every record by its range; response payloads are checked by digest."""
    schema = (
        "page string, url string, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to string" + ", payload binary" * with_payload
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [
            ("page", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()),
            ("refers_to", pa.string()), *[("payload", pa.binary())] * with_payload,
        ]
        out, held, open_uri, file = [], 0, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["archive"] != open_uri:
                    if file is not None:
                        file.close()
                    system, path = filesystem(row["archive"])
                    open_uri, file = row["archive"], system.open_input_file(path)
                found = parse_record(gzip.decompress(file.read_at(row["length"], row["at"])))
                headers = found["headers"]
                out.append(
                    {"page": headers.get("x-page-id"), "url": headers.get("warc-target-uri"),
                     "payload_bytes": found["payload_bytes"],
                     "payload_digest": found["payload_digest"],
                     "record_type": headers["warc-type"],
                     "refers_to": headers.get("x-refers-to-page-id")}
                    | ({"payload": found["payload"]} if with_payload else {})
                )
                held += found["payload_bytes"] if with_payload else 200
                if held > RECORD_BYTES_OUT:
                    yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))
                    out, held = [], 0
        if file is not None:
            file.close()
        yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))

    # A task reads neighbouring records of an archive in order.
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = index.repartition(tasks, "archive", F.shiftright("at", 20)).sortWithinPartitions("archive", "at")
    return near.mapInArrow(run, schema)


def archive_pages(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
    least: int = 0, with_payload: bool = False,
) -> DataFrame:
    """Writes a record per row and reads all back: a row per page, from the archives.

    A null payload is empty; a null key or URL stays null; repeated rows are records of
    their own.  An empty table gives no rows.  Other columns are not read.
    """
    work = Workspace(pages.sparkSession, "warc")
    manifest = work.stage(
        write_archives(with_revisits(pages, work, key, url, payload, least), work.path("archives")),
        "manifest",
    )
    work.drop("rows", "first")
    kind = pages.schema[key].dataType
    records = read_records(read_index(manifest), with_payload)
    return records.select(
        F.col("page").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "url",
        *["payload"] * with_payload,
    )
