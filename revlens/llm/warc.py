"""WARC archives as a Spark data source, format "warc".

Reading plans partitions of whole files, small ones together, and hands comparisons of header columns
(`record_type`, `record_id`, `target_uri`, `payload_digest`, `refers_to`, `content_type`) to the scan. A task
parses a record's headers first; a payload that the filters reject, or that the option `payload` =
`false` leaves out, is never decoded: in plain files it is passed by, in files of one gzip
member per record as well, by the skip length in the member's header (written here, and defined by
the WARC standard's annex). Members without it are inflated in pieces and discarded.

Writing makes one file per task, a new one beyond the option `file_bytes`, and lists the files of
successful tasks in a manifest when the job commits. Files of lost or repeated attempts
are not in a manifest, so they are never read. Folders without a manifest are read as they are.
Paths may be on any file system that pyarrow can open, such as file or hdfs; all executors must share it.

Defined results: a null or empty payload is a payload of no bytes; control characters and blanks
in header values are percent-encoded; an empty table gives a folder without records; a damaged
or cut record is an error that names file and offset.
"""

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, "
    "refers_to string, payload_digest string, payload_sha1 string, content_type string, "
    "payload_bytes long, payload binary"
)
# Columns that filters may use before a payload is decoded, and their headers.
HEADER_OF = {
    "record_id": "warc-record-id", "record_type": "warc-type",
    "target_uri": "warc-target-uri", "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest", "content_type": "content-type",
}
PARTITION_BYTES = 64 << 20
FILE_BYTES = 256 << 20
HEAD_BYTES = 16 << 10
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "_files-"
_END = b"\r\n\r\n"
_SKIP = struct.Struct("<2sHII")


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """A file system and the path in it. A single slash after file: is put right."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


class Files(InputPartition):
    def __init__(self, names: list[str]):
        super().__init__(None)
        self.names = names


class Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "WarcReader":
        return WarcReader(self.options, schema.fieldNames())

    def writer(self, schema, overwrite: bool) -> "WarcWriter":
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options)


class WarcReader(DataSourceReader):
    def __init__(self, options, columns: list[str]):
        self.path = options["path"]
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.with_payload = options.get("payload", "true").lower() != "false"
        self.columns = columns
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            column = one.attribute[0] if len(one.attribute) == 1 else None
            if column not in HEADER_OF:
                yield one
            elif isinstance(one, EqualTo):
                self.tests.append((column, "in", frozenset([one.value])))
            elif isinstance(one, In):
                self.tests.append((column, "in", frozenset(one.value)))
            elif isinstance(one, StringStartsWith):
                self.tests.append((column, "starts", one.value))
            elif isinstance(one, IsNotNull):
                self.tests.append((column, "is", None))
            else:
                yield one

    def partitions(self) -> list[Files]:
        system, root = open_path(self.path)
        found = [f for f in system.get_file_info(fs.FileSelector(root)) if f.is_file]
        manifests = [f for f in found if f.base_name.startswith(_MANIFEST)]
        if manifests:
            listed = set()
            for manifest in manifests:
                with system.open_input_stream(manifest.path) as file:
                    listed.update(json.loads(file.read()))
            found = [f for f in found if f.base_name in listed]
            if len(found) != len(listed):
                raise FileNotFoundError(f"{self.path}: files of the manifest are missing")
        else:
            found = [f for f in found if f.base_name.endswith((".warc", ".warc.gz"))]
        parts: list[Files] = []
        size = self.partition_bytes
        for file in sorted(found, key=lambda f: f.path):
            if size + file.size > self.partition_bytes:
                parts.append(Files([]))
                size = 0
            parts[-1].names.append(file.path)
            size += file.size
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        system, _ = open_path(self.path)
        for name in partition.names:
            with system.open_input_file(name) as file:
                records = _members if file.read(2) == b"\x1f\x8b" else _plain
                file.seek(0)
                offset = 0
                try:
                    for offset, head, payload in records(file):
                        row = self._row(head, payload)
                        if row is not None:
                            yield row
                except (ValueError, KeyError, zlib.error) as error:
                    raise ValueError(
                        f"{name}: the record at {offset} or the next is cut or damaged: {error}"
                    ) from error

    def _wanted(self, values: dict) -> bool:
        for column, kind, against in self.tests:
            value = values[column]
            if value is None or kind == "in" and value not in against or (
                    kind == "starts" and not value.startswith(against)):
                return False
        return True

    def _row(self, head: "Head", payload) -> tuple | None:
        values = {column: head.warc.get(header) for column, header in HEADER_OF.items()}
        if not self._wanted(values):
            return None
        digest = values["payload_digest"] or ""
        values["warc_date"] = head.warc.get("warc-date")
        values["payload_sha1"] = (
            base64.b32decode(digest[5:].upper()).hex() if digest.startswith("sha1:") else None)
        values["payload_bytes"] = head.payload_bytes
        values["payload"] = (
            payload() if self.with_payload and values["record_type"] != "revisit" else None)
        return tuple(values[c] for c in self.columns)


class Head:
    """The headers of a record, and of the HTTP message in it if there is one."""

    def __init__(self, data: bytes):
        end = data.find(_END)
        if end < 0 or not data.startswith(b"WARC/"):
            raise ValueError("no WARC header")
        self.warc = _fields(data[:end])
        self.block_at = end + 4
        self.block_bytes = int(self.warc["content-length"])
        self.payload_at = self.block_at
        self.payload_bytes = self.block_bytes
        if self.warc.get("content-type", "").startswith("application/http"):
            http_end = data.find(_END, self.block_at)
            if http_end < 0:
                raise ValueError("no HTTP header")
            self.payload_at = http_end + 4
            self.payload_bytes = self.block_bytes - (self.payload_at - self.block_at)
            if self.warc["warc-type"] == "revisit":
                length = _fields(data[self.block_at:http_end]).get("content-length")
                self.payload_bytes = int(length) if length else None


def _fields(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _head(more) -> Head:
    """Parse from as few bytes as hold the headers; `more(n)` gives the first n."""
    size, known = HEAD_BYTES, -1
    while True:
        data = more(size)
        try:
            return Head(data)
        except ValueError:
            if len(data) == known:
                raise
            known, size = len(data), size * 4


def _plain(file) -> Iterator[tuple[int, Head, object]]:
    at, end = 0, file.size()
    while at < end:
        head = _head(lambda n, at=at: file.read_at(min(n, end - at), at))
        stop = at + head.block_at + head.block_bytes
        if stop + 4 > end:
            raise ValueError("its end is missing")
        yield at, head, lambda at=at, stop=stop, head=head: file.read_at(
            stop - at - head.payload_at, at + head.payload_at)
        at = stop + 4


def _members(file) -> Iterator[tuple[int, Head, object]]:
    at, end = 0, file.size()
    while at < end:
        start = file.read_at(min(24, end - at), at)
        length = 0
        if len(start) == 24 and start[3] == 4 and start[10:12] == b"\x0c\x00":
            mark, size, length, _ = _SKIP.unpack(start[12:])
            length = length if mark == b"sl" and size == 8 else 0
        member = _Member(file, at, length or end - at)
        head = _head(member.first)
        yield at, head, lambda member=member, head=head: member.payload(head)
        at += length or member.whole_length()
        if at > end:
            raise ValueError("its end is missing")


class _Member:
    """A gzip member, inflated only as far as it is asked for."""

    def __init__(self, file, at: int, most: int):
        self.file, self.at, self.most = file, at, most
        self.restart()

    def restart(self) -> None:
        self.inflate = zlib.decompressobj(31)
        self.taken = 0
        self.out = b""

    def _more(self, wanted: int) -> bytes:
        if self.inflate.unconsumed_tail:
            return self.inflate.decompress(self.inflate.unconsumed_tail, wanted)
        data = self.file.read_at(min(1 << 16, self.most - self.taken), self.at + self.taken)
        if not data and not self.inflate.eof:
            raise ValueError("its end is missing")
        self.taken += len(data)
        return self.inflate.decompress(data, wanted)

    def first(self, size: int) -> bytes:
        while len(self.out) < size and not self.inflate.eof:
            self.out += self._more(size - len(self.out))
        return self.out

    def payload(self, head: Head) -> bytes:
        buffer = io.BytesIO()
        buffer.write(self.out)
        while not self.inflate.eof:
            buffer.write(self._more(1 << 20))
        return buffer.getvalue()[head.payload_at:head.block_at + head.block_bytes]

    def whole_length(self) -> int:
        while not self.inflate.eof:
            self._more(1 << 20)
        return self.taken - len(self.inflate.unused_data)


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), value)


def record_bytes(row, date: str) -> bytes:
    """One record as it stands in a file without compression."""
    revisit = row.record_type == "revisit"
    payload = b"" if revisit else bytes(row.payload or b"")
    size = row.payload_bytes if revisit else len(payload)
    block = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode() + payload
    sha1 = bytes.fromhex(row.payload_sha1) if row.payload_sha1 else hashlib.sha1(payload).digest()
    head = [
        "WARC/1.1", f"WARC-Type: {row.record_type}", f"WARC-Record-ID: {_clean(row.record_id)}",
        f"WARC-Date: {date}", "WARC-Payload-Digest: sha1:" + base64.b32encode(sha1).decode(),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if row.target_uri is not None:
        head.append(f"WARC-Target-URI: {_clean(row.target_uri)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_clean(row.refers_to)}"]
    return "\r\n".join(head).encode() + _END + block + _END


def member_bytes(record: bytes, level: int = 6) -> bytes:
    """The record as one gzip member with its skip length (left out beyond 32 bits)."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    body += struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    length = 24 + len(body)
    if max(length, len(record)) >= 1 << 32:
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x0c\0"
            + _SKIP.pack(b"sl", 8, length, len(record)) + body)


class WarcWriter(DataSourceWriter):
    def __init__(self, options):
        self.path = options["path"]
        self.compressed = options.get("compression", "gzip") == "gzip"
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))
        self.date = options.get(
            "date", datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))

    def write(self, rows: Iterator) -> Written:
        system, root = open_path(self.path)
        system.create_dir(root, recursive=True)
        names, file, size = [], None, 0
        for row in rows:
            data = record_bytes(row, self.date)
            if self.compressed:
                data = member_bytes(data)
            if file is None or size + len(data) > self.file_bytes and size:
                if file is not None:
                    file.close()
                names.append(f"{uuid.uuid4().hex}.warc" + ".gz" * self.compressed)
                file, size = system.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
            file.write(data)
            size += len(data)
        if file is not None:
            file.close()
        return Written(names)

    def commit(self, messages: list) -> None:
        system, root = open_path(self.path)
        system.create_dir(root, recursive=True)
        names = [name for message in messages if message for name in message.names]
        with system.open_output_stream(f"{root}/{_MANIFEST}{uuid.uuid4().hex}") as file:
            file.write(json.dumps(names).encode())

    def abort(self, messages: list) -> None:
        system, root = open_path(self.path)
        for message in messages:
            for name in message.names if message else ():
                system.delete_file(f"{root}/{name}")


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


SAME_FROM_BYTES = 1000
_ID = "urn:page:"


def page_records(pages: DataFrame, same_from: int = SAME_FROM_BYTES) -> DataFrame:
    """Records for the writer: of equal payloads of at least `same_from` bytes the row with the
    largest page_id is the response and the others revisit it; all other rows are responses.

    Rows that share the largest page_id are all responses; without any page_id so are all rows.
    Only digests that occur twice are joined back, and Spark splits a digest that holds many rows.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("target_uri"),
        payload.alias("payload"), F.sha1(payload).alias("payload_sha1"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    first = (
        rows.filter(F.col("payload_bytes") >= same_from).groupBy("payload_sha1", "payload_bytes")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.join(first, ["payload_sha1", "payload_bytes"], "left").select(
        F.concat(F.lit(f"<{_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                 F.lit(">")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.when(revisit, F.concat(F.lit(f"<{_ID}"), F.col("response"), F.lit(">")))
        .alias("refers_to"),
        "payload_sha1", "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def page_of(column: str):
    """The page_id in a record id."""
    return F.expr(f"try_cast(regexp_extract({column}, '{_ID}(-?[0-9]+)', 1) as long)")


def write(records: DataFrame, path: str, **options: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").options(**options).mode("append").save(path)


def load(spark: SparkSession, path: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)
