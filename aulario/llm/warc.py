"""WARC archives as a PySpark data source (``format("warc")``).

Reading: one input partition per archive file. A record's header block is parsed first; pushed
filters on header fields decide there whether the payload is touched at all. The payload of an
unwanted record is skipped, never decoded. ``payload`` says what is done with a wanted one:
``skip`` (default; lengths and digests come from the header), ``verify`` (read, measured and
hashed, not returned) or ``bytes`` (also returned).

Writing: every task writes archives of about ``roll_bytes`` each under names of its own and
reports them; the commit lists those of successful tasks in ``_archives``. Readers go by that list
where there is one, so files of lost or repeated tasks are never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from aulario.llm.common import filesystem, small_batches

SCHEMA = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, record_id string, payload binary"
)
_LIST = "_archives"
# Names and profile of the WARC format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BLOCK = 1 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _clean(value: str) -> str:
    """Header values are one line."""
    return " ".join(value.split())


def record(
    page_id: int | None, url: str | None, payload: bytes, is_revisit: bool, refers_to: int | None, date: str
) -> bytes:
    """One record: a response with the payload, or a revisit with the HTTP header alone."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if is_revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + digest(payload)),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    if is_revisit:
        head += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(refers_to)),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


class _Stream:
    """Buffered forward reader that can skip."""

    def __init__(self, raw) -> None:
        self.raw, self.buffer = raw, b""

    def head(self) -> bytes | None:
        """Bytes up to the next blank line; None at the end of the file."""
        self.buffer = self.buffer.lstrip(b"\r\n")
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            more = self.raw.read(_BLOCK)
            if not more:
                if self.buffer.strip():
                    raise ValueError("archive ends within a record header")
                return None
            self.buffer = (self.buffer + more).lstrip(b"\r\n")
        out, self.buffer = self.buffer[:end], self.buffer[end + 4 :]
        return out

    def take(self, n: int) -> bytes:
        parts, got = [self.buffer[:n]], min(n, len(self.buffer))
        self.buffer = self.buffer[n:]
        while got < n:
            more = self.raw.read(max(_BLOCK, n - got))
            if not more:
                raise ValueError("archive ends within a record")
            parts.append(more[: n - got])
            self.buffer = more[n - got :]
            got += len(parts[-1])
        return b"".join(parts)

    def skip(self, n: int) -> None:
        while n > len(self.buffer):
            n -= len(self.buffer)
            self.buffer = self.raw.read(_BLOCK)
            if not self.buffer:
                raise ValueError("archive ends within a record")
        self.buffer = self.buffer[n:]


def _number(text: str | None) -> int | None:
    return int(text) if text is not None else None


def records(raw, payload: str = "skip", wanted=lambda fields: True) -> Iterator[tuple]:
    """Rows of an open archive. ``wanted`` sees the header fields before any payload is read."""
    stream = _Stream(raw)
    while (head := stream.head()) is not None:
        version, *lines = head.decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        named = {}
        for line in lines:
            key, _, value = line.partition(":")
            named[key.strip().lower()] = value.strip()
        length = int(named["content-length"])
        said = named.get("warc-payload-digest", "").removeprefix("sha1:") or None
        fields = {
            "page_id": _number(named.get("x-page-id")),
            "url": named.get("warc-target-uri"),
            "record_type": named.get("warc-type"),
            "payload_bytes": _number(named.get("x-payload-length")),
            "payload_digest": said,
            "refers_to": _number(named.get("x-refers-to-page-id")),
            "record_id": named.get("warc-record-id"),
        }
        if not wanted(fields):
            stream.skip(length)
            continue
        body = None
        if payload == "skip" or fields["record_type"] != "response":
            stream.skip(length)
        else:
            block = stream.take(length)
            body = block[block.find(b"\r\n\r\n") + 4 :] if block.startswith(b"HTTP/") else block
            found = digest(body)
            if said is not None and said != found:
                raise ValueError(f"payload of {fields['record_id']} does not match its digest")
            fields |= {"payload_bytes": len(body), "payload_digest": found}
        yield (*fields.values(), body if payload == "bytes" else None)


_TESTS = {
    EqualTo: lambda a, b: a == b,
    In: lambda a, b: a in b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
}
_HEADER_FIELDS = {"page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "record_id"}


@dataclass
class ArchivePartition(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, folder: str, payload: str) -> None:
        if payload not in ("skip", "verify", "bytes"):
            raise ValueError("payload is skip, verify or bytes")
        self.folder, self.payload = folder, payload
        self.tests: list[tuple] = []

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            known = len(getattr(f, "attribute", ())) == 1 and f.attribute[0] in _HEADER_FIELDS
            if known and isinstance(f, IsNotNull):
                self.tests.append((f.attribute[0], None, None))
            elif known and type(f) in _TESTS:
                self.tests.append((f.attribute[0], type(f).__name__, f.value))
            else:
                yield f

    def partitions(self) -> list[ArchivePartition]:
        from pyarrow import fs

        system, root = filesystem(self.folder)
        if system.get_file_info(f"{root}/{_LIST}").type == fs.FileType.File:
            with system.open_input_stream(f"{root}/{_LIST}") as f:
                names = json.loads(f.read())
            return [ArchivePartition(f"{root}/{n}") for n in names]
        found = system.get_file_info(fs.FileSelector(root))
        return [ArchivePartition(i.path) for i in found if i.base_name.endswith((".warc", ".warc.gz"))]

    def read(self, partition: ArchivePartition | None) -> Iterator[tuple]:
        if partition is None:
            return
        tests = {k.__name__: v for k, v in _TESTS.items()}

        def wanted(fields: dict) -> bool:
            for name, kind, value in self.tests:
                if fields[name] is None or (kind is not None and not tests[kind](fields[name], value)):
                    return False
            return True

        system, _ = filesystem(self.folder)
        with system.open_input_stream(partition.path, compression=None) as raw:
            source = gzip.GzipFile(fileobj=raw) if partition.path.endswith(".gz") else raw
            yield from records(source, self.payload, wanted)


@dataclass
class Archives(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceWriter):
    """Expects ``page_id, url, payload, is_revisit, refers_to``."""

    def __init__(self, folder: str, roll_bytes: int, compress: bool, date: str) -> None:
        self.folder, self.roll_bytes, self.compress, self.date = folder, roll_bytes, compress, date

    def write(self, rows: Iterator) -> Archives:
        system, root = filesystem(self.folder)
        names: list[str] = []
        out, size = None, 0
        for row in rows:
            data = record(row.page_id, row.url, bytes(row.payload), row.is_revisit, row.refers_to, self.date)
            if self.compress:  # every record is a gzip member of its own
                data = gzip.compress(data, 1, mtime=0)
            if out is None:
                names.append(f"{uuid.uuid4().hex}.warc" + ".gz" * self.compress)
                out, size = system.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
            out.write(data)
            size += len(data)
            if size >= self.roll_bytes:
                out.close()
                out = None
        if out is not None:
            out.close()
        return Archives(names)

    def commit(self, messages: list) -> None:
        system, root = filesystem(self.folder)
        names = sorted(n for m in messages if m is not None for n in m.names)
        with system.open_output_stream(f"{root}/{_LIST}") as f:
            f.write(json.dumps(names).encode())


class WarcDataSource(DataSource):
    """Options: ``path``; reading ``payload``; writing ``roll_bytes``, ``gzip``, ``date``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "skip"))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        folder = self.options["path"]
        system, root = filesystem(folder)
        system.create_dir(root, recursive=True)
        return WarcWriter(
            folder,
            int(self.options.get("roll_bytes", 256 << 20)),
            self.options.get("gzip", "true") == "true",
            self.options.get("date", "1970-01-01T00:00:00Z"),
        )


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known and let filters reach it."""
    small_batches(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def with_revisits(pages: DataFrame, min_bytes: int = 0, salts: int = 16) -> DataFrame:
    """Records to write for ``pages`` (``page_id``, ``url``, ``html``): ``page_id, url, payload, is_revisit, refers_to``.

    Of equal payloads of at least ``min_bytes`` bytes the row with the smallest ``page_id`` is the
    response and the others revisit it. A null ``html`` is an empty payload; rows without a
    ``page_id`` revisit a row that has one, or are responses if none has; repeated rows of the
    smallest id are responses all. Only digests that occur twice are joined, each row with one
    of ``salts`` copies of its digest, so a payload that many pages share is spread.
    """
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    base = pages.select(
        "page_id",
        url.cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    )
    keyed = base.withColumn("_d", F.unhex(F.sha1("payload"))).withColumn(
        "_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts))
    )
    firsts = (
        keyed.filter(F.length("payload") >= min_bytes)
        .groupBy("_d")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1 and refers_to is not null")
        .select("_d", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")).alias("_salt"))
    )
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return (
        keyed.join(firsts, ["_d", "_salt"], "left")
        .withColumn("is_revisit", revisit)
        .select("page_id", "url", "payload", "is_revisit", F.when(revisit, F.col("refers_to")).alias("refers_to"))
    )


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, **options) -> None:
    register(pages.sparkSession)
    with_revisits(pages, min_bytes).write.format("warc").mode("append").options(**options).save(folder)


def read_warc(spark: SparkSession, folder: str, payload: str = "skip") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(folder)
