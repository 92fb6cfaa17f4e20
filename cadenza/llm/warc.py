"""WARC archives as a PySpark Python data source, and page archives with revisit records.

Format ``cadenza_warc``. Writing: one file per task, one record per row. A
task names its file by attempt and the driver's commit lists the files that
count, with byte offsets of some record starts, in a manifest; files of failed
attempts are never listed. Reading: the manifest's (or, in a folder without
one, every ``*.warc``) files become partitions of about ``split_bytes``, cut at
listed record starts. Predicates on the record type and the other header
columns are pushed down: a record's headers are parsed first, and where they
do not match, or where the payload is not asked for (option ``payload`` =
``false``), its block is skipped by its length without being read.
"""

from __future__ import annotations

import base64
import io
import json
import operator
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from .common import filesystem, materialise, scratch_path

FORMAT = "cadenza_warc"
VERSION = b"WARC/1.1"
SCHEMA = "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
_ARROW = pa.schema(
    [(c, pa.string()) for c in ("record_type", "record_id", "target_uri", "refers_to", "payload_digest")] + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes between the record starts that a manifest lists.
CUT_BYTES = 4 << 20


def _line(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict, date: str) -> bytes:
    """A WARC record; the payload of a revisit record stays out, its digest and length are in the headers."""
    payload = row["payload"] or b""
    body = b"" if row["record_type"] == "revisit" else _HTTP.format(len(payload)).encode() + payload
    headers = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", date), ("WARC-Target-URI", row["target_uri"])]
    if row["payload_digest"] is not None:
        headers.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()))
    if row["record_type"] == "revisit":
        headers += [("WARC-Refers-To", row["refers_to"]), ("WARC-Profile", _PROFILE)]
    headers += [("X-Payload-Length", str(row["payload_bytes"])), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    lines = "".join(f"{k}: {_line(v)}\r\n" for k, v in headers if v is not None)
    return VERSION + b"\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + body + b"\r\n\r\n"


def read_headers(source: io.BufferedIOBase, end: int | None = None) -> dict[str, str] | None:
    """Headers of the next record of ``source``, by lower-case name; None if none begins before ``end``."""
    line = b"\n"
    while line in (b"\r\n", b"\n"):
        begin = source.tell()
        line = source.readline()
    if not line or (end is not None and begin >= end):
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record here: {line[:40]!r}")
    headers: dict[str, str] = {}
    while (line := source.readline().rstrip(b"\r\n")) != b"":
        name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
        headers[name.strip().lower()] = value.strip()
    return headers


def header_columns(headers: dict[str, str]) -> dict:
    digest = headers.get("warc-payload-digest", "")
    length = headers.get("x-payload-length")
    return {
        "record_type": headers.get("warc-type"),
        "record_id": headers.get("warc-record-id"),
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"),
        "payload_digest": base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None,
        "payload_bytes": None if length is None else int(length),
    }


def body_payload(headers: dict[str, str], block: bytes) -> bytes | None:
    """The payload in a block: what follows the HTTP headers, or all of it; none in a revisit record."""
    if headers.get("warc-type") == "revisit":
        return None
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


@dataclass
class WrittenFile(WriterCommitMessage):
    name: str | None
    size: int
    cuts: list[int]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder, self.date = options["path"], options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, where = filesystem(self.folder)
        name, sink, at, cuts = f"part-{uuid.uuid4().hex}.warc", None, 0, [0]
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if sink is None:
                        fs.create_dir(where, recursive=True)
                        sink = fs.open_output_stream(f"{where}/{name}")
                    if at - cuts[-1] >= CUT_BYTES:
                        cuts.append(at)
                    raw = record(row, self.date)
                    sink.write(raw)
                    at += len(raw)
        finally:
            if sink is not None:
                sink.close()
        return WrittenFile(name if at else None, at, cuts)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, where = filesystem(self.folder)
        fs.create_dir(where, recursive=True)
        files = [{"name": m.name, "size": m.size, "cuts": m.cuts} for m in messages if m is not None and m.name]
        with fs.open_output_stream(f"{where}/manifest-{uuid.uuid4().hex}.json") as sink:
            sink.write(json.dumps(files).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, where = filesystem(self.folder)
        for m in messages:
            if m is not None and m.name:
                fs.delete_file(f"{where}/{m.name}")


@dataclass
class Slices(InputPartition):
    """(file, first byte, end byte) of a partition."""

    parts: list[tuple[str, int, int]]

    def __init__(self, parts: list[tuple[str, int, int]]):
        super().__init__(None)
        self.parts = parts


_COMPARE = {
    EqualTo: operator.eq,
    GreaterThan: operator.gt,
    GreaterThanOrEqual: operator.ge,
    LessThan: operator.lt,
    LessThanOrEqual: operator.le,
    StringStartsWith: str.startswith,
    StringEndsWith: str.endswith,
    StringContains: operator.contains,
}


def holds(f: Filter, row: dict) -> bool | None:
    """The value of a pushed predicate for a record's header columns, with SQL's null logic."""
    if isinstance(f, Not):
        inner = holds(f.child, row)
        return None if inner is None else not inner
    value = row[f.attribute[0]]
    if isinstance(f, IsNull | IsNotNull):
        return (value is None) == isinstance(f, IsNull)
    if isinstance(f, EqualNullSafe):
        return value == f.value
    if value is None:
        return None
    if isinstance(f, In):
        return True if value in [x for x in f.value if x is not None] else None if None in f.value else False
    return _COMPARE[type(f)](value, f.value)


def pushable(f: Filter) -> bool:
    if isinstance(f, Not):
        return pushable(f.child)
    known = isinstance(f, IsNull | IsNotNull | EqualNullSafe | In) or (type(f) in _COMPARE and f.value is not None)
    return known and len(f.attribute) == 1 and f.attribute[0] in _ARROW.names and f.attribute[0] != "payload"


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.with_payload = str(options.get("payload", "true")).lower() != "false"
        self.split = int(options.get("split_bytes", 16 << 20))
        self.batch_bytes = int(options.get("batch_bytes", 8 << 20))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            if pushable(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs as pafs

        fs, where = filesystem(self.folder)
        found = sorted(x.path for x in fs.get_file_info(pafs.FileSelector(where)) if x.is_file)
        manifests = [p for p in found if p.rpartition("/")[2].startswith("manifest-")]
        files: list[dict] = []
        for p in manifests:
            with fs.open_input_stream(p) as source:
                files += json.loads(source.read())
        if not manifests:
            files = [{"name": p.rpartition("/")[2], "size": fs.get_file_info(p).size, "cuts": [0]} for p in found if p.endswith(".warc")]
        slices: list[InputPartition] = []
        parts, size = [], 0
        for f in files:
            for a, b in zip(f["cuts"], [*f["cuts"][1:], f["size"]], strict=True):
                if parts and size + b - a > self.split:
                    slices.append(Slices(parts))
                    parts, size = [], 0
                parts.append((f["name"], a, b))
                size += b - a
        return [*slices, Slices(parts)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        fs, where = filesystem(self.folder)
        rows, size = [], 0
        for name, begin, end in partition.parts:
            with fs.open_input_file(f"{where}/{name}") as raw:
                source = io.BufferedReader(_Seekable(raw), 1 << 16)
                source.seek(begin)
                while (headers := read_headers(source, end)) is not None:
                    row, length = header_columns(headers), int(headers.get("content-length", 0))
                    if not all(holds(f, row) for f in self.filters):
                        source.seek(length, io.SEEK_CUR)
                        continue
                    if self.with_payload and row["record_type"] != "revisit":
                        row["payload"] = body_payload(headers, source.read(length))
                        size += length
                    else:
                        source.seek(length, io.SEEK_CUR)
                        row["payload"] = None
                    rows.append(row)
                    if size >= self.batch_bytes or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


class _Seekable(io.RawIOBase):
    """A pyarrow file as raw binary file."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        return self.file.seek(offset, whence)

    def tell(self) -> int:
        return self.file.tell()

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


class WarcSource(DataSource):
    """Options: path; for reading also payload, split_bytes and batch_bytes; for writing date."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("archives are only appended to: use mode('append')")
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to a session and let it push predicates down to Python sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


MIN_REVISIT_BYTES = 1000


def records(pages: DataFrame, *, least_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One record per row of ``pages(page_id, url, html)``, in the columns of ``SCHEMA``.

    Of the rows with equal payloads of at least ``least_bytes`` bytes those
    with the largest page_id are responses, the others revisit it; all smaller
    ones are responses. Null html is empty. In a group without any page_id
    all are responses. Groups are found on digests only.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    # The revisit decision must not rest on a digest that can be forged.
    strong = F.when(F.col("payload_bytes") >= least_bytes, F.sha2("payload", 256))
    groups = rows.select(strong.alias("same"), "page_id").where("same is not null").groupBy("same").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    shared = materialise(groups.where("n > 1 and first is not null").select("same", "first"), "shared")
    joined = rows.withColumn("same", strong).join(shared, "same", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        _record_id(F.col("page_id")).alias("record_id"),
        "target_uri",
        F.when(revisit, _record_id(F.col("first"))).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _record_id(page_id):
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _page_id(record_id):
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def archive(pages: DataFrame, folder: str | None = None, *, least_bytes: int = MIN_REVISIT_BYTES) -> str:
    """Write ``pages`` as WARC records below ``folder`` (by default in the shared folder) and return it."""
    spark = pages.sparkSession
    register(spark)
    folder = folder or scratch_path(spark, "warc")
    records(pages, least_bytes=least_bytes).write.format(FORMAT).mode("append").save(folder)
    return folder


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page record in an archive.

    Responses are read whole and their digest and length taken from the
    payload itself; of revisits only the headers are read.
    """
    register(spark)
    whole = spark.read.format(FORMAT).load(folder).where("record_type = 'response'")
    whole = whole.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    brief = spark.read.format(FORMAT).option("payload", "false").load(folder).where("record_type = 'revisit'")
    both = whole.drop("payload").unionByName(brief.drop("payload"))
    return both.select(_page_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", _page_id(F.col("refers_to")).alias("refers_to"))
