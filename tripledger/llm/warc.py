"""WARC archives as a PySpark data source, and pages written with revisit records.

``spark.read.format("warc").load(folder)`` plans file partitions on the driver, pushes filters on
header columns down, reads a record's headers first and passes over the rest of records that no
filter wants; payloads are decoded only if the schema asks for them. Records are gzip members
whose header carries the member's length, so passing over one is a seek. Members without it and
plain WARC files are read too. One file is one unit of work, the writer starts a new one every
``maxFileBytes``.

A task writes files of its own name, and the commit writes a manifest with those of the tasks
that succeeded; files of lost or repeated tasks are not in it and are never read. Folders without
a manifest are read whole. Paths may be of any file system that PyArrow knows.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo,
                                    Filter, In, InputPartition, IsNotNull, StringContains, StringEndsWith,
                                    StringStartsWith, WriterCommitMessage)

SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, "
          "payload_digest string, content_type string, headers map<string,string>, payload_length long, "
          "payload binary")
FIELDS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
          "date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
          "content_type": "Content-Type"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TARGET_BYTES = 32 << 20
BATCH_BYTES = 8 << 20


def _open(path: str):
    """File system and plain path; ``file:/x`` is the same as ``file:///x``."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[5:]
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


# ---- reading records -------------------------------------------------------------------

class _Plain:
    def __init__(self, file):
        self.file = file

    def readline(self) -> bytes:
        return self.file.readline()

    def read(self, n: int) -> bytes:
        return self.file.read(n)

    def close(self, rest: int) -> None:
        self.file.seek(rest, io.SEEK_CUR)


class _Member:
    """One gzip member, inflated only as far as it is read."""

    def __init__(self, file):
        self.file, self.end, start = file, None, file.tell()
        flags = file.read(10)[3]
        if flags & 4:
            extra = file.read(struct.unpack("<H", file.read(2))[0])
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    self.end = start + struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size:]
        for bit in (8, 16):  # name and comment
            while flags & bit and file.read(1) not in (b"\0", b""):
                pass
        if flags & 2:
            file.read(2)
        self.inflate, self.buffer, self.done = zlib.decompressobj(-15), bytearray(), False

    def _more(self) -> None:
        if self.inflate.unconsumed_tail:
            data = self.inflate.unconsumed_tail
        else:
            data = self.file.read(1 << 14)
            if not data:
                raise EOFError("an archive ends inside a record")
        self.buffer += self.inflate.decompress(data, 1 << 16)
        if self.inflate.eof:
            self.done = True
            self.file.seek(8 - len(self.inflate.unused_data), io.SEEK_CUR)  # CRC and size follow

    def readline(self) -> bytes:
        while (at := self.buffer.find(b"\n")) < 0 and not self.done:
            self._more()
        return self.read(at + 1 if at >= 0 else len(self.buffer))

    def read(self, n: int) -> bytes:
        while len(self.buffer) < n and not self.done:
            self._more()
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def close(self, rest: int) -> None:
        if self.end is not None and not self.done:
            self.file.seek(self.end)
        while self.end is None and not self.done:
            self.buffer.clear()
            self._more()


def _headers(stream) -> dict[str, str]:
    found: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip()] = value.strip()
    return found


def _dechunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        parts.append(body[end + 2:end + 2 + size])
        at = end + 4 + size


def records(file, wanted, http: bool, payload: bool) -> Iterator[dict]:
    """Columns of the records that ``wanted`` accepts by their header columns."""
    while True:
        first = file.read(1)
        while first in (b"\r", b"\n"):
            first = file.read(1)
        if not first:
            return
        first += file.read(1)
        file.seek(-len(first), io.SEEK_CUR)
        stream = _Member(file) if first == b"\x1f\x8b" else _Plain(file)
        version = stream.readline()
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {file.tell()}: {version[:40]!r}")
        headers = _headers(stream)
        names = {k.lower(): v for k, v in headers.items()}
        left = int(names.get("content-length", "0"))
        row = {column: names.get(name.lower()) for column, name in FIELDS.items()}
        if wanted(row):
            row["headers"] = list(headers.items())
            row["payload_length"] = left
            inner: dict[str, str] = {}
            if (http or payload) and (row["content_type"] or "").startswith("application/http"):
                block = bytearray()
                while left > len(block) and (line := stream.readline()):
                    block += line
                    if line in (b"\r\n", b"\n"):
                        break
                left -= len(block)
                for line in bytes(block).split(b"\n")[1:]:
                    name, _, value = line.decode("latin-1").partition(":")
                    inner[name.strip().lower()] = value.strip()
                row["payload_length"] = int(inner.get("content-length", left))
            if payload and row["record_type"] != "revisit":
                body, left = stream.read(left), 0
                if inner.get("transfer-encoding", "").lower() == "chunked":
                    body = _dechunked(body)
                if inner.get("content-encoding", "").lower() in ("gzip", "deflate"):
                    body = zlib.decompress(body, 47)
                row["payload"], row["payload_length"] = body, len(body)
            yield row
        stream.close(left)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.options, self.names = dict(options), schema.fieldNames()
        self.arrow = pa.schema([(f, {"headers": pa.map_(pa.string(), pa.string()),
                                     "payload": pa.binary(), "payload_length": pa.int64()}.get(f, pa.string()))
                                for f in self.names])
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        """Takes what the header columns decide; the rest goes back to Spark."""
        kinds = (EqualTo, EqualNullSafe, In, IsNotNull, StringStartsWith, StringEndsWith, StringContains)
        for f in filters:
            if isinstance(f, kinds) and len(f.attribute) == 1 and f.attribute[0] in FIELDS:
                self.tests.append(f)
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        for f in self.tests:
            have = row[f.attribute[0]]
            if isinstance(f, EqualNullSafe):
                ok = have == f.value
            elif have is None:
                ok = False
            elif isinstance(f, EqualTo):
                ok = have == f.value
            elif isinstance(f, In):
                ok = have in f.value
            elif isinstance(f, StringStartsWith):
                ok = have.startswith(f.value)
            elif isinstance(f, StringEndsWith):
                ok = have.endswith(f.value)
            elif isinstance(f, StringContains):
                ok = f.value in have
            else:
                ok = True
            if not ok:
                return False
        return True

    def partitions(self):
        system, root = _open(self.options["path"])
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        manifests = [f.path for f in found if f.base_name.startswith("_manifest-")]
        files = {f.path: f.size for f in found
                 if f.is_file and f.base_name.lower().endswith((".warc", ".warc.gz"))}
        if manifests:
            listed = set()
            for path in manifests:
                with system.open_input_stream(path) as file:
                    listed |= set(json.loads(file.read()))
            files = {p: n for p, n in files.items() if p.rpartition("/")[2] in listed}
        target, packs, size = int(self.options.get("maxPartitionBytes", TARGET_BYTES)), [[]], 0
        for path, n in sorted(files.items()):
            if size and size + n > target:
                packs.append([])
                size = 0
            packs[-1].append(path)
            size += n
        return [Files(tuple(p)) for p in packs]

    def read(self, partition: Files):
        system, _ = _open(self.options["path"])
        payload = "payload" in self.names
        rows, held = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 17) as file:
                for row in records(file, self.wanted, "payload_length" in self.names, payload):
                    rows.append(row)
                    held += 500 + len(row.get("payload") or b"")
                    if held > BATCH_BYTES:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(f.name) for r in rows], f.type) for f in self.arrow], schema=self.arrow)


# ---- writing records -------------------------------------------------------------------

def member(data: bytes) -> bytes:
    """A gzip member with its own length in an extra field."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + b"sl" + struct.pack(
        "<HII", 8, total & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(row: dict) -> bytes:
    """One record; a revisit has the HTTP header of the whole payload and no payload."""
    payload = row.get("payload") or b""
    size = row.get("payload_length")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload) if size is None else size}\r\n\r\n").encode()
    block = http if row["record_type"] == "revisit" else http + payload
    lines = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]),
             ("WARC-Date", row.get("date") or "1970-01-01T00:00:00Z"),
             ("WARC-Target-URI", row.get("target_uri")), ("WARC-Refers-To", row.get("refers_to")),
             ("WARC-Profile", PROFILE if row["record_type"] == "revisit" else None),
             ("WARC-Payload-Digest", row.get("payload_digest")),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{n}: {' '.join(v.split())}\r\n" for n, v in lines if v)
    return b"WARC/1.1\r\n" + head.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.most = int(options.get("maxFileBytes", TARGET_BYTES))

    def write(self, iterator) -> Written:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for at in range(batch.num_rows):
                    if out is None:
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = system.open_output_stream(
                            f"{root}/{names[-1]}", compression=None), 0
                    row = {n: batch.column(i)[at].as_py() for i, n in enumerate(batch.schema.names)}
                    size += out.write(member(record(row))) or 0
                    if size > self.most:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages) -> None:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        old = system.get_file_info(fs.FileSelector(root)) if self.overwrite else []
        names = [n for m in messages if m for n in m.names]
        with system.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())
        for f in old:
            if f.base_name not in names and (f.base_name.startswith("_manifest-")
                                             or f.base_name.endswith(".warc.gz")):
                system.delete_file(f.path)

    def abort(self, messages) -> None:
        system, root = _open(self.path)
        for m in messages:
            for name in m.names if m else []:
                system.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make format ``warc`` known to the session, and let Spark push filters to it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# ---- pages -----------------------------------------------------------------------------

def page_records(pages: DataFrame, least: int = 100) -> DataFrame:
    """A WARC record per row of ``page_id``, ``url``, ``html``.

    Of equal payloads of at least ``least`` bytes the smallest page_id is a response and the
    others revisit it; rows that repeat that page_id are responses too. Null html is an empty
    payload. A page without an id is a response only where all of its group have none. An empty
    table gives no records.
    """
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), html.alias("payload")
                        ).withColumn("digest", F.sha2("payload", 256)).withColumn(
        "payload_length", F.octet_length("payload").cast("long"))
    first = rows.where(F.col("payload_length") >= least).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("members")).where("members > 1")
    joined = rows.join(first.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest"), "left")
    again = F.col("members").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))

    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        urn("page_id").alias("record_id"), F.col("url").alias("target_uri"),
        F.when(again, urn("first")).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"), "payload_length",
        F.when(~again, F.col("payload")).alias("payload"))


def page_of(urn: str):
    return F.expr(f"try_cast(regexp_extract({urn}, '^<urn:page:(.*)>$', 1) as bigint)")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` and
    ``payload`` from archives; of a response the size and digest are those of the bytes read."""
    back = spark.read.format("warc").schema(
        "record_type string, record_id string, refers_to string, payload_digest string, "
        "payload_length long, payload binary").load(path)
    whole = F.col("record_type") == "response"
    return back.select(
        page_of("record_id").alias("page_id"),
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length"))
        .alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.regexp_replace("payload_digest", "^sha256:", ""))
        .alias("payload_digest"), "record_type", page_of("refers_to").alias("refers_to"), "payload")
