"""WARC archives as a PySpark data source.

A file holds one gzip member per record, and an index beside it tells where each member ends. The writer names a file
after its task's attempt, and only files that the job committed get into the folder's list, so tasks that ran twice
leave no records behind. The reader plans one partition per listed file or group of small files. It inflates a member
up to the blank line behind its headers, tests record type and headers, and goes on to the next member, or inflates the
rest where the payload is asked for.
"""

from __future__ import annotations

import base64
import io
import json
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage

from tidemark.llm.files import create, new_folder, open_file, store

SCHEMA = "page_id bigint, record_type string, url string, payload_digest string, payload_bytes bigint, refers_to bigint, payload binary"
SMALL = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])
LIST = "_records.json"
#: A file is closed beyond so many bytes; small files are read together up to as many.
FILE_BYTES = 128 << 20
LEVEL = 5
#: A member is inflated in steps of so many bytes until its headers are there; files are read in blocks of so many.
HEAD_BYTES, READ_BYTES = 1024, 256 << 10
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    tail = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(tail) if tail.lstrip("-").isdigit() else None


def record_bytes(page_id, record_type, url, digest, size, refers_to, payload) -> bytes:
    """One record, uncompressed. A revisit carries HTTP headers only. Control characters of a URL are percent-encoded."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    body = http + payload if record_type == "response" else http
    lines = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(quote(c) if c < " " or c == "\x7f" else c for c in url))
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    lines.append(f"WARC-Payload-Length: {size}")
    if record_type == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


class Member:
    """One record of a file: ``head`` holds its headers, ``whole`` inflates the rest as well."""

    def __init__(self, file, start: int, stop: int):
        self.file, self.at, self.stop = file, start, stop
        self.inflate, self.head = zlib.decompressobj(31), b""
        while b"\r\n\r\n" not in self.head:
            data = self.inflate.unconsumed_tail or self._read(HEAD_BYTES)
            if not data:
                raise ValueError("a record is cut off")
            self.head += self.inflate.decompress(data, HEAD_BYTES)

    def _read(self, most: int) -> bytes:
        self.file.seek(self.at)
        data = self.file.read(min(most, self.stop - self.at))
        self.at += len(data)
        return data

    def whole(self) -> bytes:
        record = self.head + self.inflate.decompress(self.inflate.unconsumed_tail + self._read(self.stop))
        if not self.inflate.eof:
            raise ValueError("a record is cut off")
        return record


def members(file, chunk: int = 1 << 20) -> Iterator[bytes]:
    """All gzip members of a file without an index, each inflated whole."""
    rest, inflate, parts = b"", zlib.decompressobj(31), []
    while True:
        data = rest or file.read(chunk)
        if not data:
            break
        parts.append(inflate.decompress(data))
        rest = b""
        if inflate.eof:
            yield b"".join(parts)
            rest, inflate, parts = inflate.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the last record is cut off")


def records(folder: str, name: str) -> Iterator[tuple[bytes, Callable[[], bytes]]]:
    """Of each record of a file, in order, its beginning with all headers, and a function that inflates it whole.

    Files that have no index, from other writers, are inflated whole.
    """
    system, path = store(folder)
    indexed = system.get_file_info(f"{path}/{name}.idx").type != fs.FileType.NotFound
    with open_file(folder, name) as raw, io.BufferedReader(raw, READ_BYTES) as file:
        if not indexed:
            for record in members(file):
                yield record, lambda record=record: record
            return
        with open_file(folder, name + ".idx") as index:
            ends = array("Q", index.read())
        start = 0
        for stop in ends:
            member = Member(file, start, stop)
            yield member.head, member.whole
            start = stop


def headers(record: bytes) -> tuple[dict[str, str], int]:
    """Header fields by lower-case name, and where the block begins."""
    end = record.index(b"\r\n\r\n")
    version, *lines = record[:end].decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]}")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, end + 4


def payload_of(record: bytes, at: int, fields: dict[str, str]) -> bytes:
    stop = at + int(fields["content-length"])
    return record[record.index(b"\r\n\r\n", at) + 4 : stop]


@dataclass
class Files(WriterCommitMessage):
    written: list[tuple[str, int]]


def listed(folder: str) -> list[list] | None:
    """Names and sizes of the files that finished jobs have written; None before the first."""
    system, path = store(folder)
    if system.get_file_info(f"{path}/{LIST}").type == fs.FileType.NotFound:
        return None
    with open_file(folder, LIST) as file:
        return json.loads(file.read())


class WarcWriter(DataSourceArrowWriter):
    """Appends to what the folder's list names, or starts a new list."""

    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite = folder, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        written, out, name, ends = [], None, "", array("Q")

        def close():
            out.close()
            with create(self.folder, name + ".idx") as index:
                index.write(ends.tobytes())
            written.append((name, ends[-1]))

        for batch in iterator:
            for row in zip(*(batch.column(n).to_pylist() if n != "payload" else batch.column(n) for n in SMALL.names)):
                if out is None:
                    name, ends = f"pages-{uuid.uuid4().hex}.warc.gz", array("Q")
                    out = create(self.folder, name)
                deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                data = deflate.compress(record_bytes(*row[:-1], row[-1].as_py() or b"")) + deflate.flush()
                out.write(data)
                ends.append((ends[-1] if ends else 0) + len(data))
                if ends[-1] >= FILE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        return Files(written)

    def commit(self, messages: list[Files | None]) -> None:
        before = [] if self.overwrite else listed(self.folder) or []
        with create(self.folder, LIST) as out:
            out.write(json.dumps(before + sorted(f for m in messages if m for f in m.written)).encode())

    def abort(self, messages: list[Files | None]) -> None:
        system, path = store(self.folder)
        for message in messages:
            for name, _ in message.written if message else ():
                system.delete_file(f"{path}/{name}")
                system.delete_file(f"{path}/{name}.idx")


@dataclass
class Archive(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    """Rows of the listed files; equality tests on headers are taken over from the query."""

    FIELDS = {"record_type", "page_id", "url", "payload_digest", "refers_to"}

    def __init__(self, folder: str, wanted: list[str]):
        self.folder, self.wanted = folder, wanted
        self.tests: list[tuple[str, frozenset | None]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in self.FIELDS and isinstance(f, EqualTo):
                self.tests.append((name, frozenset([f.value])))
            elif name in self.FIELDS and isinstance(f, In):
                self.tests.append((name, frozenset(f.value)))
            elif name in self.FIELDS and isinstance(f, IsNotNull):
                self.tests.append((name, None))
            else:
                yield f

    def partitions(self) -> list[Archive]:
        found = listed(self.folder)
        if found is None:
            raise ValueError(f"{self.folder} holds no finished archives")
        groups, size = [], FILE_BYTES
        for name, n in found:
            if size + n > FILE_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(name)
            size += n
        return [Archive(g) for g in groups] or [Archive([])]

    def passes(self, head: dict) -> bool:
        return all(head[n] is not None if allowed is None else head[n] in allowed for n, allowed in self.tests)

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([f for f in SMALL if f.name in self.wanted])
        rows, held = [], 0
        for name in partition.names:
            for begin, whole in records(self.folder, name):
                fields, at = headers(begin)
                head = {
                    "page_id": page_of(fields["warc-record-id"]), "record_type": fields["warc-type"], "url": fields.get("warc-target-uri"),
                    "payload_digest": base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex(),
                    "payload_bytes": int(fields["warc-payload-length"]), "refers_to": page_of(fields.get("warc-refers-to")),
                }
                if not self.passes(head):
                    continue
                if "payload" in self.wanted:
                    head["payload"] = payload_of(whole(), at, fields) if fields["warc-type"] == "response" else None
                    held += len(head["payload"] or b"")
                rows.append(head)
                if held > 8 << 20 or len(rows) >= 5_000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class Warc(DataSource):
    """``format("warc")`` with option ``path``. Reading a schema without ``payload`` leaves payloads undecoded."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema.fieldNames())

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if schema.fieldNames() != SMALL.names:
            raise ValueError(f"columns must be {SMALL.names}")
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known, and let Spark hand filters of the query to Python data sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """The rows to write: one response per distinct payload of at least ``least`` bytes, revisits for the others.

    The response is the row of the largest ``page_id``; repeated rows of that id are responses as well, since a record
    cannot revisit itself. Null ids are below all others, and payloads that only null ids have are all responses.
    Smaller payloads are all responses. A null ``html`` is an empty payload. Other columns than ``page_id``, ``url``
    and ``html`` are not read.
    """
    payload = F.coalesce(pages["html"].cast("binary"), F.lit(b""))
    rows = pages.select(pages["page_id"].cast("bigint").alias("page_id"), pages["url"].alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("bigint")})
    # Only digests that occur twice: combined before the shuffle, one row per digest after it.
    large = rows.where(F.col("payload_bytes") >= least)
    best = large.groupBy(F.col("payload_digest").alias("_digest")).agg(F.count(F.lit(1)).alias("_n"), F.max("page_id").alias("_best")).where("_n > 1")
    joined = rows.join(best, (rows["payload_digest"] == best["_digest"]) & (rows["payload_bytes"] >= least), "left")
    again = F.col("_best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_best"))
    return joined.select(
        "page_id", F.when(again, "revisit").otherwise("response").alias("record_type"), "url", "payload_digest", "payload_bytes",
        F.when(again, F.col("_best")).alias("refers_to"), F.when(~again, F.col("payload")).alias("payload"),
    )


def write_warc(rows: DataFrame, folder: str) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").mode("append").option("path", folder).save()


def read_warc(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """All records of a finished folder; without ``payload`` no payload is decoded."""
    register(spark)
    columns = SCHEMA if payload else SCHEMA.rpartition(",")[0]
    return spark.read.format("warc").schema(columns).option("path", folder).load()


def archived_pages(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in a new folder of the shared folder and read the records back.

    Length and digest of responses are taken anew from the payloads read; those of revisits from their headers. One
    read serves both. An empty table gives an empty archive and no rows; payloads of any length are records of one member.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_warc(with_revisits(pages), folder)
    archive, fresh = read_warc(spark, folder), F.col("record_type") == "response"
    return archive.select(
        "page_id", F.when(fresh, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(fresh, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to", "url",
    )
