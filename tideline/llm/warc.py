"""WARC archives as a Python data source.

Writing: every task writes gzip members, one per record, into files that are rolled at a
size; the driver then lists the files of the tasks that ended well in a manifest. Each
member carries its lengths in the gzip header field ``sl`` that the WARC standard
describes, so that a reader can step over a record it has only seen the head of.

Reading: files are dealt to partitions by size. For each record only the head is inflated
and parsed; record-type and header predicates are decided there, and the payload is
inflated only for records that pass, and only if payloads are asked for.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)

from tideline.llm.common import filesystem, whole
from tideline.llm.exact_dedup import exact_classes
from tideline.sources.sinks import qualified

SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_length long, headers map<string,string>, payload binary"
)
WRITTEN = "record_type string, record_id string, target_uri string, refers_to string, payload binary"
#: Columns that are headers, and the headers.
HEADER_OF = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_files-"
HEAD_BYTES = 4096
WINDOW_BYTES = 4 << 20
BATCH_BYTES = 16 << 20


class CorruptRecord(ValueError):
    """A record that can't be parsed, or whose payload differs from its digest."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(name: str, value: str) -> bytes:
    value = value.replace("\r", "%0D").replace("\n", "%0A")
    return f"{name}: {value}\r\n".encode()


def member(content: bytes, level: int = 6) -> bytes:
    """A gzip member whose header tells its compressed and uncompressed length."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(content) + squeeze.flush()
    size = 10 + 2 + 12 + len(body) + 8
    lengths = struct.pack("<2sHII", b"sl", 8, size & 0xFFFFFFFF, len(content) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(lengths)) + lengths
    return head + body + struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)


def record(
    record_type: str,
    record_id: str,
    target_uri: str | None,
    refers_to: str | None,
    payload: bytes,
    date: str,
) -> bytes:
    """A response, or a revisit that keeps the HTTP head and leaves the payload out."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    )
    block = http if record_type == "revisit" else http + payload
    head = b"WARC/1.1\r\n" + _line("WARC-Type", record_type)
    head += _line("WARC-Record-ID", record_id) + _line("WARC-Date", date)
    if target_uri is not None:
        head += _line("WARC-Target-URI", target_uri)
    if record_type == "revisit":
        head += _line("WARC-Profile", REVISIT_PROFILE)
        head += _line("WARC-Refers-To", refers_to or "")
    head += _line("Content-Type", "application/http; msgtype=response")
    head += _line("WARC-Payload-Digest", f"sha1:{digest(payload)}")
    head += _line("Content-Length", str(len(block)))
    return head + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Files(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path = options["path"]
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.roll = int(options.get("roll_bytes", 128 << 20))
        self.level = int(options.get("level", 6))
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        names: list[str] = []
        out = None
        for batch in iterator:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or out.tell() >= self.roll:
                    if out is not None:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = store.open_output_stream(f"{root}/{names[-1]}", compression=None)
                kind, key, uri, refers, payload = row
                content = record(kind, key, uri, refers, payload or b"", self.date)
                out.write(member(content, self.level))
        if out is not None:
            out.close()
        return Files(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        old = _manifests(store, root)
        names = sorted(n for m in messages if m is not None for n in m.names)
        with store.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}.json") as file:
            file.write(json.dumps(names).encode())
        if self.overwrite:
            for name in old:
                store.delete_file(f"{root}/{name}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = filesystem(self.path)
        for m in messages:
            for name in m.names if m is not None else []:
                store.delete_file(f"{root}/{name}")


def _manifests(store, root: str) -> list[str]:
    from pyarrow import fs

    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name.startswith(MANIFEST))


@dataclass
class Archives(InputPartition):
    paths: tuple[str, ...]


class Window:
    """Random access to a file through one buffered piece of it."""

    def __init__(self, file) -> None:
        self.file, self.size = file, file.size()
        self.start, self.raw = 0, b""

    def get(self, at: int, n: int) -> bytes:
        if at < self.start or at + n > self.start + len(self.raw):
            self.file.seek(at)
            self.start, self.raw = at, self.file.read(max(n, WINDOW_BYTES))
        return self.raw[at - self.start : at - self.start + n]


@dataclass
class Head:
    headers: dict[str, str]
    length: int  # bytes of the head, with its blank line


def parse_head(raw: bytes) -> Head | None:
    """The head at the start of ``raw``, or None if it is not complete there."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = raw[:end].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise CorruptRecord(f"no WARC head: {lines[0][:40]!r}")
    headers = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    return Head(headers, end + 4)


class Member:
    """One gzip member: ``upto`` inflates as far as asked, ``end`` finds the next one."""

    def __init__(self, window: Window, at: int) -> None:
        self.window, self.at = window, at
        head = window.get(at, 12)
        if head[:3] != b"\x1f\x8b\x08":
            raise CorruptRecord("no gzip member")
        self.length = None
        if head[3] & 4:
            extra = window.get(at + 12, struct.unpack("<H", head[10:12])[0])
            k = 0
            while k + 4 <= len(extra):
                name, n = struct.unpack_from("<2sH", extra, k)
                if name == b"sl" and n == 8:
                    self.length = struct.unpack_from("<I", extra, k + 4)[0]
                k += 4 + n
        self.inflate = zlib.decompressobj(31)
        self.read, self.raw = at, bytearray()

    def upto(self, n: int | None) -> bytes:
        """At least the first ``n`` bytes, or everything."""
        while not self.inflate.eof and (n is None or len(self.raw) < n):
            piece = self.inflate.unconsumed_tail
            if not piece:
                piece = self.window.get(self.read, min(1 << 16, self.window.size - self.read))
                if not piece:
                    raise CorruptRecord("a record is cut short")
                self.read += len(piece)
            self.raw += self.inflate.decompress(piece, 0 if n is None else max(1, n - len(self.raw)))
        return bytes(self.raw)

    def end(self) -> int:
        if self.length:
            return self.at + self.length
        while not self.inflate.eof:  # an archive from elsewhere: inflate, but keep nothing
            self.upto(len(self.raw) + (1 << 16))
            self.raw = self.raw[-1:]
        return self.read - len(self.inflate.unused_data)


class Plain:
    """One record of an archive that is not compressed."""

    def __init__(self, window: Window, at: int) -> None:
        self.window, self.at, self.stop = window, at, None

    def upto(self, n: int | None) -> bytes:
        stop = self.window.size if self.stop is None else self.stop
        return self.window.get(self.at, min(stop - self.at, stop if n is None else n))

    def end(self) -> int:
        return self.stop


def read_records(file, wanted, with_payload: bool) -> Iterator[tuple]:
    """Rows of SCHEMA for the records whose headers ``wanted`` accepts."""
    window, at = Window(file), 0
    while at < window.size:
        packed = window.get(at, 2) == b"\x1f\x8b"
        source = Member(window, at) if packed else Plain(window, at)
        n, head = HEAD_BYTES, None
        while head is None:
            raw = source.upto(n)
            head = parse_head(raw)
            if head is None and len(raw) < n:
                raise CorruptRecord("a head is cut short")
            n *= 4
        length = int(head.headers.get("content-length", "0"))
        if not packed:
            source.stop = at + head.length + length + 4
        if wanted(head.headers):
            kind = head.headers.get("warc-type")
            payload = size = None
            if head.headers.get("content-type", "").startswith("application/http"):
                whole_block = with_payload and kind == "response"
                some = length if whole_block else min(length, HEAD_BYTES)
                block = source.upto(head.length + some)[head.length : head.length + length]
                http, _, body = block.partition(b"\r\n\r\n")
                told = re.search(rb"(?im)^content-length:\s*(\d+)", http)
                size = int(told[1]) if told else None
                if whole_block:
                    payload, size = body, len(body)
            elif with_payload:
                payload = source.upto(head.length + length)[head.length : head.length + length]
                size = len(payload)
            else:
                size = length
            named = head.headers.get("warc-payload-digest")
            told = named.removeprefix("sha1:") if named and named.startswith("sha1:") else None
            if payload is not None and told is not None and told != digest(payload):
                raise CorruptRecord(f"digest of {head.headers.get('warc-record-id')}")
            yield (
                kind,
                head.headers.get("warc-record-id"),
                head.headers.get("warc-target-uri"),
                head.headers.get("warc-refers-to"),
                named.removeprefix("sha1:") if named else None,
                size,
                head.headers,
                payload,
            )
        at = source.end()


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.payload = options.get("payload", "true") == "true"
        self.target = int(options.get("partition_bytes", 128 << 20))
        #: (column, operation, values), all of which a record's headers must meet.
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if isinstance(f, EqualTo) and column in HEADER_OF:
                self.tests.append((column, "in", (f.value,)))
            elif isinstance(f, In) and column in HEADER_OF:
                self.tests.append((column, "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith) and column in HEADER_OF:
                self.tests.append((column, "starts", (f.value,)))
            else:
                yield f

    def wanted(self, headers: dict[str, str]) -> bool:
        for column, operation, values in self.tests:
            value = headers.get(HEADER_OF[column])
            if column == "payload_digest" and value:
                value = value.removeprefix("sha1:")
            if value is None or not (
                value in values if operation == "in" else value.startswith(values[0])
            ):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        """Files in parts of about the target size; one file is never in two parts."""
        from pyarrow import fs

        store, root = filesystem(self.path)
        one = store.get_file_info(root)
        if one.type == fs.FileType.File:
            found = [one]
        elif listed := _manifests(store, root):
            names = []
            for m in listed:
                with store.open_input_stream(f"{root}/{m}") as file:
                    names += [f"{root}/{n}" for n in json.loads(file.read())]
            found = store.get_file_info(names)
        else:
            found = store.get_file_info(fs.FileSelector(root, recursive=True))
            found = [f for f in found if re.search(r"\.warc(\.gz)?$", f.path)]
        parts: list[list[str]] = []
        room = 0
        for f in sorted(found, key=lambda f: f.path):
            if not parts or room < f.size:
                parts.append([])
                room = self.target
            parts[-1].append(f.path)
            room -= f.size
        return [Archives(tuple(p)) for p in parts] or [Archives(())]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                for row in read_records(file, self.wanted, self.payload):
                    rows.append(row)
                    size += len(row[-1] or b"") + 500
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, names = pa.string(), [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [text] * 5 + [pa.int64(), pa.map_(text, text), pa.binary()]
    columns = list(zip(*rows, strict=True))
    columns[6] = [list(h.items()) for h in columns[6]]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        names = [c.split()[0] for c in WRITTEN.split(", ")]
        if schema.names != names:
            raise ValueError(f"Columns to write must be {names}")
        return WarcWriter(dict(self.options), overwrite)


def read_warc(spark: SparkSession, path: str, payload: bool = True, **options: str) -> DataFrame:
    """Records below a folder, or of one file.

    Filters on record_type, record_id, target_uri, refers_to and payload_digest (equality,
    IN, prefix) reach the reader; this switches the session's pushdown for Python sources
    on. ``payload=False`` never inflates payloads. A cut record, an unreadable head and a
    payload that differs from its digest are errors.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc").options(payload=str(payload).lower(), **options)
    return reader.load(qualified(spark, path))


def write_warc(records: DataFrame, path: str, **options: str) -> None:
    """Append records (columns of WRITTEN) to the archives below a folder."""
    spark = records.sparkSession
    spark.dataSource.register(WarcDataSource)
    names = [c.split()[0] for c in WRITTEN.split(", ")]
    writer = records.select(*names).write.format("warc").options(**options).mode("append")
    writer.save(qualified(spark, path))


def archive_pages(
    pages: DataFrame,
    path: str,
    min_revisit_bytes: int = 0,
    id_col: str = "page_id",
    uri_col: str = "url",
    html_col: str = "html",
    **options: str,
) -> None:
    """Write one record per page: of equal payloads the smallest identifier is the response.

    The others revisit it. Payloads under ``min_revisit_bytes`` are all responses. A null
    text is an empty payload and a null address gives no header. A null identifier
    is the response only if no other page has its payload. Repeated rows (same identifier
    and payload) are written each, all of them as responses or all as revisits.
    """
    classes = (
        exact_classes(pages, id_col, html_col, keep="min")
        .select(
            F.col(id_col).alias("same_id"),
            F.col("text_sha256").alias("same_text"),
            F.col("keep_id").alias("first_id"),
        )
        .dropDuplicates(["same_id", "same_text"])
    )
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(uri_col).alias("target_uri"), whole(html_col).alias("body")
    ).withColumn("sha", F.sha2("body", 256))
    revisit = ~F.col("id").eqNullSafe(F.col("first_id")) & (
        F.octet_length("body") >= min_revisit_bytes
    )

    def name(ident: str):
        key = F.coalesce(F.col(ident).cast("string"), F.lit(""))
        return F.concat(F.lit("<urn:x-record:"), key, F.lit(">"))

    records = rows.join(
        classes, F.col("id").eqNullSafe(F.col("same_id")) & (F.col("sha") == F.col("same_text"))
    ).select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        name("id").alias("record_id"),
        "target_uri",
        F.when(revisit, name("first_id")).alias("refers_to"),
        F.encode("body", "UTF-8").alias("payload"),
    )
    write_warc(records, path, **options)


def record_key(column: str):
    """The identifier in a record's name; null where it had none."""
    return F.col(column).substr(F.lit(len("<urn:x-record:") + 1), F.length(column) - 15).try_cast(
        "long"
    )
