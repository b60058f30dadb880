"""WARC archives: writer, and a PySpark Python data source that reads them.

``write_archives`` turns rows into WARC/1.1 records, one gzip member each, so that an archive can be
read from any record's start. Of records with equal payloads the one with the smallest id is a
response and the others are revisits that refer to it and carry HTTP headers only.

The ``warc`` source plans byte-balanced file partitions on the driver and reads them on executors.
``read_archives`` pushes filters on record_type and on the header columns down to it: a record's header
block is parsed first, and a record that fails is passed over without its block being decoded (gzip
members are inflated piece by piece all the same, as only that shows where they end). Without filters
on the payload, ``payload=false`` leaves payloads undecoded as well.

What a response is said to hold is taken from the payload that was read: its length and digest are
columns of the source. A revisit has neither; ``read_back`` looks them up in the response that it names.
An archive that ends inside a record, or whose lengths are no numbers, fails the read, with file and offset.

Files are reached through ``open`` for local and file:// paths, and through Arrow's file systems
for other schemes.

Defined cases: a null payload is the empty payload; a null id writes an empty id, reads back as null,
and never stands for a group that has an id; rows that repeat the smallest id are all responses; an
empty table gives no archives and no rows; other columns are never read. A payload that was altered in
its archive reads back with its own length and digest; a revisit whose response is missing or has another
digest than the revisit names has null for both.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith
from pyspark.sql.types import StructType

from ._shared import column, drop_path, map_arrow, materialize, prepare, scratch_path, slices, table

VERSION = "WARC/1.1"
#: Payloads of at least so many bytes are written once, and revisited after that.
MIN_REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
#: Gzip level of the records: archives are written once and read once.
LEVEL = 2
#: A reader's task takes archives of about so many bytes.
PARTITION_BYTES = 16 << 20
CHUNK = 1 << 20

#: Header columns of the source, with the WARC field that each holds.
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
SCHEMA = ", ".join(f"{c} string" for c in FIELDS) + ", content_length long, payload_bytes long, read_digest string, payload binary, path string, offset long"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a path, and the path within it."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) and not path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(row_id) -> str:
    return f"<urn:page:{'' if row_id is None else row_id}>"


def record(kind: str, record_id: str, uri: str, payload: bytes, payload_digest: str, refers_to: str | None = None) -> bytes:
    """One record. The HTTP headers give the full payload's length; a revisit ends after them."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{payload_digest}"]
    if refers_to:
        head += [f"WARC-Refers-To: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(rows: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES) -> int:
    """Write a record per row into archives below ``path``; the number of records.

    The driver renames what succeeded tasks have written, so lost executors and second attempts
    leave no archive that is read.
    """
    src = rows.select(F.col(id_col).alias("row_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    src = src.withColumn("sha", F.sha1(F.encode("payload", "utf-8")))
    # only payloads that occur twice are joined; a hot payload is pre-aggregated, and the join's skew is split
    twice = src.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("sha").agg(F.min("row_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 and first_id is not null")
    joined = src.join(twice.select("sha", "first_id"), "sha", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(path)
        fs.create_dir(f"{base}/_tmp", recursive=True)
        name, n, out = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0, None
        for b in slices(batches, "payload"):
            if out is None:
                out = fs.open_output_stream(f"{base}/_tmp/{name}", compression=None, buffer_size=CHUNK)
            for row_id, url, payload, sha, first in zip(*(column(b, c).to_pylist() for c in ("row_id", "url", "payload", "sha", "first_id")), strict=True):
                revisit = first is not None and first != row_id
                code = base64.b32encode(bytes.fromhex(sha)).decode()
                uri = "" if url is None else quote(url, safe="/:?#[]@!$&'()*+,;=%-._~")
                data = record("revisit" if revisit else "response", urn(row_id), uri, payload.encode(), code, urn(first) if revisit else None)
                out.write(gzip.compress(data, LEVEL, mtime=0))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"name": [name], "n": [n]})

    written = map_arrow(joined, run, "name string, n long").collect()  # a row a task
    fs, base = file_system(path)
    fs.create_dir(base, recursive=True)
    for r in written:
        fs.move(f"{base}/_tmp/{r.name}", f"{base}/{r.name}")
    if fs.get_file_info(f"{base}/_tmp").type == pafs.FileType.Directory:
        fs.delete_dir(f"{base}/_tmp")
    return sum(r.n for r in written)


@dataclass
class WarcPartition(InputPartition):
    files: tuple[str, ...]


class _Stream:
    """Bytes of an archive, plain or in gzip members, with as much look-ahead as a record needs."""

    def __init__(self, raw, gzipped: bool):
        self.raw, self.gzipped = raw, gzipped
        self.data, self.at = bytearray(), 0
        self.passed = 0
        self.inflate = zlib.decompressobj(31) if gzipped else None
        self.ended = self.begun = False

    def more(self) -> bool:
        if self.ended:
            return False
        chunk = self.raw.read(CHUNK)
        if not chunk:
            self.ended = True
            return False
        if self.at > CHUNK:
            del self.data[: self.at]
            self.passed += self.at
            self.at = 0
        while self.gzipped and chunk:
            self.data += self.inflate.decompress(chunk)
            self.begun = not self.inflate.eof
            if self.begun:
                break
            chunk = self.inflate.unused_data
            self.inflate = zlib.decompressobj(31)
        if not self.gzipped:
            self.data += chunk
        return True

    def until(self, mark: bytes) -> bytes | None:
        begin = self.at
        while True:
            end = self.data.find(mark, begin)
            if end >= 0:
                out = bytes(self.data[self.at : end])
                self.at = end + len(mark)
                return out
            offset = self.at
            begin = max(self.at, len(self.data) - len(mark) + 1)
            if not self.more():
                return None
            begin -= offset - self.at

    def take(self, n: int, keep: bool) -> bytes | None:
        """The next n bytes, or None if there are fewer; if they aren't wanted they are dropped as they come, and an empty string stands for them."""
        if keep:
            while len(self.data) - self.at < n and self.more():
                pass
            if len(self.data) - self.at < n:
                return None
            out = bytes(self.data[self.at : self.at + n])
            self.at += n
            return out
        while n:
            step = min(n, len(self.data) - self.at)
            self.at += step
            n -= step
            if n and not self.more():
                return None
        return b""

    def left(self) -> bytes:
        return bytes(self.data[self.at :])

    def whole(self) -> bool:
        """Whether no gzip member is cut short."""
        return not self.begun


def parse_headers(block: bytes) -> dict[str, str]:
    """Field names in lower case to values; a line that begins with white space continues the one before."""
    out, last = {}, None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            out[last] = value.strip()
    return out


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path", "")
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.partition_bytes = int(options.get("partitionbytes", options.get("partitionBytes", PARTITION_BYTES)))
        self.filters: list[tuple[str, str, tuple]] = []

    def partitions(self):
        fs, base = file_system(self.path)
        info = fs.get_file_info(base)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        files = sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and re.search(r"\.warc(\.gz)?$", f.path) and "/_tmp/" not in f.path)
        parts, own, size = [], [], 0
        for name, n in files:
            if own and size + n > self.partition_bytes:
                parts.append(WarcPartition(tuple(own)))
                own, size = [], 0
            own.append(name)
            size += n
        if own:
            parts.append(WarcPartition(tuple(own)))
        return parts or [WarcPartition(())]

    def _passes(self, row: dict) -> bool:
        for name, kind, values in self.filters:
            v = row[name]
            if v is None or kind == "in" and v not in values or kind == "starts" and not v.startswith(values[0]):
                return False
        return True

    def records(self, raw, path: str) -> Iterator[dict]:
        stream = _Stream(raw, path.endswith(".gz"))
        while True:
            start = stream.passed + stream.at
            block = stream.until(b"\r\n\r\n")
            if block is None:
                if stream.left().strip():
                    raise EOFError(f"{path} ends inside the headers of a record at {start}")
                if not stream.whole():
                    raise EOFError(f"{path} ends inside a gzip member after {start}")
                return
            fields = parse_headers(block)
            if not fields.get("content-length", "0").isdigit():
                raise ValueError(f"{path}: the record at {start} has Content-Length {fields['content-length']!r}")
            length = int(fields.get("content-length", 0))
            row = {c: fields.get(f.lower()) or None for c, f in FIELDS.items()}
            if row["payload_digest"]:
                row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
            wanted = self._passes(row)
            block = stream.take(length, wanted)
            if block is None:
                raise EOFError(f"{path} ends inside the record at {start}")
            stream.take(4, False)
            if not wanted:
                continue
            row |= {"content_length": length, "payload_bytes": None, "read_digest": None, "payload": None, "path": path, "offset": start}
            at = 0
            if (row["content_type"] or "").startswith("application/http"):
                end = block.find(b"\r\n\r\n")
                at = end + 4 if end >= 0 else length
            if row["record_type"] != "revisit":
                row["payload_bytes"] = length - at
                if self.payload:
                    row["payload"] = block[at:]
                    row["read_digest"] = digest(row["payload"])
            yield row

    def read(self, partition):
        fs, _ = file_system(self.path)
        schema = pa.schema([(c, pa.string()) for c in FIELDS] + [("content_length", pa.int64()), ("payload_bytes", pa.int64()), ("read_digest", pa.string()), ("payload", pa.binary()), ("path", pa.string()), ("offset", pa.int64())])
        rows, size = [], 0
        for path in partition.files:
            with fs.open_input_stream(path, compression=None) as raw:
                for row in self.records(raw, path):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 300
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class PushingReader(WarcReader):
    """Takes filters. Spark keeps what was pushed in the loaded table, where other queries over it would meet it: only on request."""

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in FIELDS and isinstance(f, EqualTo):
                self.filters.append((name, "in", (f.value,)))
            elif name in FIELDS and isinstance(f, In):
                self.filters.append((name, "in", tuple(f.value)))
            elif name in FIELDS and isinstance(f, StringStartsWith):
                self.filters.append((name, "starts", (f.value,)))
            elif name in FIELDS and isinstance(f, IsNotNull):
                self.filters.append((name, "set", ()))
            else:
                yield f


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(folder)``; options: payload (true), partitionBytes, pushdown (false).

    Filters run in Spark unless ``pushdown`` is true, and then a loaded table serves one query only; see ``read_archives``.
    """

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        pushdown = str(self.options.get("pushdown", "false")).lower() == "true"
        return (PushingReader if pushdown else WarcReader)(dict(self.options))


def read_archives(spark: SparkSession, path: str, where: Column | str | None = None, **options) -> DataFrame:
    """Records of the archives below ``path`` that pass ``where``.

    What ``where`` says of record type and headers is pushed down to the reader, if the session's
    ``spark.sql.python.filterPushdown.enabled`` is on (see ``prepare``). Filters that are put on the
    result later run in Spark, above the metric ``warc_records``, which must see every row: Spark keeps the
    filters once pushed to a Python source in the loaded table, where other queries over it would meet them.
    """
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc").option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    for k, v in options.items():
        reader = reader.option(k, v)
    records = reader.load(path)
    if where is not None:
        records = records.where(where)
    return records.observe("warc_records", F.count(F.lit(1)).alias("n"))


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """A row per response or revisit: its id, and length and digest of the full payload.

    A response's are those of the payload that was read. Revisits meet the response that they name by its
    id and digest; responses are pre-aggregated, and the join's skew is split.
    """
    got = read_archives(spark, path, F.col("record_type").isin("response", "revisit"))
    # the archives are read once; what is kept of a record is a few short columns
    got = materialize(got.select("record_id", "record_type", "refers_to", "target_uri", "payload_digest", "payload_bytes", "read_digest"), "warc-read")
    responses = got.where("record_type = 'response'")
    named = responses.groupBy(F.col("record_id").alias("r_id"), F.col("read_digest").alias("r_digest")).agg(F.max("payload_bytes").alias("r_bytes"))
    revisits = got.where("record_type = 'revisit'")
    found = revisits.join(named, (F.col("refers_to") == F.col("r_id")) & (F.col("payload_digest") == F.col("r_digest")), "left")
    columns = ["record_id", "record_type", "refers_to", "target_uri"]
    return responses.select(*columns, F.col("read_digest").alias("payload_digest"), "payload_bytes").unionByName(
        found.select(*columns, F.col("r_digest").alias("payload_digest"), F.col("r_bytes").alias("payload_bytes"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(prepare(spark), "warc")
    write_archives(table(spark, sf_dir, "pages"), path)

    def number(c: str):
        return F.nullif(F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1), F.lit("")).cast("long")

    got = read_back(spark, path)
    drop_path(spark, path)
    return got.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
