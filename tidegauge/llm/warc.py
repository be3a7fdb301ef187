"""WARC archives as a Python data source, for writing and reading.

Every record is a gzip member of its own whose extra field ``sl`` states the member's length, so that a
reader can pass over a record without inflating it. Writing tasks name their files in commit messages;
the manifest that the driver then writes makes exactly these files the archive, so repeated or lost
tasks leave nothing behind that counts.

Reading plans one partition per archive file (writers start a new one every ``max_file_bytes``). Filters
on ``record_type`` and on header columns are pushed down and tested after the headers, the first few
hundred bytes of a record; the payload is inflated only for records that pass, and not at all with the
option ``payload`` set to false.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

MANIFEST = "manifest.json"
SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, page_id long, payload_bytes long, payload binary"
)
# fixed values: header names by column
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "page_id": "X-Page-Id",
    "payload_bytes": "X-Payload-Length",
}
NUMBERS = ("page_id", "payload_bytes")
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
HEAD = 4096  # compressed bytes read to get at a record's headers


def _one_line(value: str) -> str:
    return "".join(" " if c in "\r\n" else c for c in value)


def pack(record: dict) -> bytes:
    """A record as one gzip member. Keys of ``record`` as in HEADERS, and payload (bytes or None)."""
    body = b"" if record["record_type"] == "revisit" else record.get("payload") or b""
    block = HTTP + b"Content-Length: %d\r\n\r\n" % len(body) + body
    lines = ["WARC/1.0", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if record["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT}")
    lines += [f"{HEADERS[k]}: {_one_line(str(record[k]))}" for k in HEADERS if record.get(k) is not None]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = squeeze.compress(raw) + squeeze.flush()
    size = 10 + 2 + 12 + len(data) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HQ", 8, size)
    return head + data + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


@dataclass
class Archive(InputPartition):
    path: str


@dataclass
class Files(WriterCommitMessage):
    names: list


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, max_file_bytes: int):
        self.path, self.max_file_bytes = path, max_file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        names, out = [], None
        for batch in iterator:
            for record in batch.to_pylist():
                if out is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = store.open_output_stream(f"{base}/{names[-1]}", compression=None)
                out.write(pack(record))
                if out.tell() >= self.max_file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Files(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{MANIFEST}") as out:
            out.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, base = _store(self.path)
        for name in [n for m in messages if m for n in m.names]:
            store.delete_file(f"{base}/{name}")


def _parsed(raw: bytes) -> tuple[dict, int] | None:
    """Headers by column, and where the block begins; None if ``raw`` ends before."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = dict(line.split(": ", 1) for line in raw[:end].decode().split("\r\n")[1:] if ": " in line)
    record = {c: fields.get(h) for c, h in HEADERS.items()}
    return record | {c: int(record[c]) for c in NUMBERS if record[c] is not None}, end + 4


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload = path, payload
        self.tests: list[tuple[str, tuple]] = []
        self.present: list[str] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.tests.append((name, (f.value,)))
            elif name in HEADERS and isinstance(f, In):
                self.tests.append((name, tuple(f.value)))
            elif name in HEADERS and isinstance(f, IsNotNull):
                self.present.append(name)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, base = _store(self.path)
        with store.open_input_stream(f"{base}/{MANIFEST}") as f:
            names = json.loads(f.read())
        # one partition at least, as Spark asks for
        return [Archive(n) for n in names] or [Archive("")]

    def wanted(self, record: dict) -> bool:
        return all(record[c] in values for c, values in self.tests) and all(record[c] is not None for c in self.present)

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, base = _store(self.path)
        columns = [*HEADERS, "payload"]
        kinds = [pa.int64() if c in NUMBERS else pa.string() for c in HEADERS] + [pa.binary()]
        rows, size = [], 0
        with store.open_input_file(f"{base}/{partition.path}") as f:
            total, at = f.size(), 0
            while at < total:
                f.seek(at)
                first = f.read(min(HEAD, total - at))
                length = struct.unpack_from("<Q", first, 16)[0]
                at += length
                inflate = zlib.decompressobj(-15)
                raw = inflate.decompress(first[24 : length - 8], 2048)
                taken = min(len(first), length - 8)
                while (head := _parsed(raw)) is None:  # long headers
                    more = inflate.unconsumed_tail
                    if not more:
                        more = f.read(min(HEAD, length - 8 - taken))
                        taken += len(more)
                    raw += inflate.decompress(more, 2048)
                record, begin = head
                if not self.wanted(record):
                    continue
                if self.payload and record["record_type"] != "revisit":
                    raw += inflate.decompress(inflate.unconsumed_tail + f.read(length - 8 - taken))
                    body = raw.index(b"\r\n\r\n", begin) + 4
                    record["payload"] = raw[body:-4]
                rows.append([record.get(c) for c in columns])
                size += len(raw)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], columns)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], columns)


class WarcSource(DataSource):
    """Format ``warc``. Options: path; payload (default true); max_file_bytes (default 64 MB)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("max_file_bytes", 64 << 20)))


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let Spark push filters into Python sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, where: Column | None = None, payload: bool = True) -> DataFrame:
    register(spark)
    records = spark.read.format("warc").option("payload", str(payload).lower()).load(path)
    return records if where is None else records.where(where)


def page_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Records of pages (page_id, url, html), to be written as ``warc``.

    Of pages with equal payloads of at least ``least`` bytes, that with the largest page_id is the
    response, and the others revisit it; smaller ones are all responses. Null html is an empty payload.
    Rows that repeat the largest page_id are all responses, as are rows without page_id whose group
    has none.
    """
    html = F.coalesce("html", F.lit(""))
    sized = pages.select(
        "page_id",
        F.col("url").alias("target_uri"),
        html.cast("binary").alias("payload"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha1(html.cast("binary")).alias("payload_digest"),
    )
    keys = ["payload_digest", "payload_bytes"]
    large = sized.where(F.col("payload_bytes") >= least)
    groups = large.groupBy(*keys).agg(F.count("*").alias("copies"), F.max("page_id").alias("top")).where("copies > 1")
    rows = sized.join(groups, keys, "left")
    revisit = F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return rows.select(
        _page_urn(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(revisit, _page_urn(F.col("top"))).alias("refers_to"),
        "payload_digest",
        "page_id",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_warc(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").mode("append").option("path", path).save()


def page_archive(pages: DataFrame, path: str, least: int = 1000) -> DataFrame:
    """Write ``pages`` to an archive and say what stands in it, per page: page_id, payload_bytes,
    payload_digest, record_type, refers_to (page_id of the response that a revisit refers to). Length
    and digest of a response are those of the payload as read back."""
    spark = pages.sparkSession
    write_warc(page_records(pages, least), path)
    responses = read_warc(spark, path, F.col("record_type") == "response").select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = read_warc(spark, path, F.col("record_type") == "revisit", payload=False).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.regexp_extract("refers_to", r"^<urn:page:(-?[0-9]+)>$", 1).cast("long").alias("refers_to"),
    )
    return responses.union(revisits)
