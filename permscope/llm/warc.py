"""Operator 6: WARC archives: a Python data source, and a writer with revisit records.

``spark.read.format("warc").load(dir_or_file)`` (after ``register``) plans one
partition per run of small files, reads ``.warc`` and ``.warc.gz`` (one gzip
member a record), and takes predicates on the header columns.  A record's
headers are parsed first; when a pushed predicate fails, or the option
``payload`` is ``false``, its payload is not decoded: a plain file is read past
it, and a gzip member that carries the skip-length field ("sl" in the gzip extra
field) is jumped over.

The writer makes one record a page.  Of pages with equal payloads of at least
``min_bytes`` bytes the smallest page_id is a ``response``, the others are
``revisit`` records that keep the HTTP headers (so the payload's length) and the
payload's digest.  Equal payloads are found on (SHA-256, length) with
pre-aggregated minima, and the pages join their decision by page_id, so a
payload that a third of all pages share is spread over all tasks.

Cases: null html is an empty payload; a null url gives no target URI (null when
read); control characters and spaces in a url are percent-encoded; a page with a
null page_id is a response; rows that repeat a page_id and payload are all of
the smallest one's type; an empty table writes no file and reads as no row;
columns other than the three named ones are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition,
                                    IsNotNull, IsNull, StringContains, StringEndsWith, StringStartsWith)

FILE_BYTES = 32 << 20       # a file is closed beyond this
PARTITION_BYTES = 64 << 20  # small files are read together up to this
CHUNK = 1 << 16
SCHEMA = ("record_id string, warc_type string, target_uri string, warc_date string, payload_digest string, "
          "refers_to string, http_status int, payload_bytes long, payload binary, file string, position long")
ARROW = pa.schema([(k, {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[t])
                   for k, t in (c.split() for c in SCHEMA.split(", "))])
# header of each column that predicates can be tested on before the payload is touched
HEADER = {"record_id": "warc-record-id", "warc_type": "warc-type", "target_uri": "warc-target-uri",
          "warc_date": "warc-date", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ------------------------------------------------------------------ records

def record(kind: str, record_id: str, uri: str | None, date: str, payload: bytes, digest: str,
           refers_to: str | None = None) -> bytes:
    """One WARC/1.1 record; a revisit keeps only the HTTP headers of its block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if uri is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """A gzip member whose extra field tells its compressed and plain size."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(data) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def _fields(block: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in block.split(b"\r\n")[1:]:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


class _Plain:
    """Records of an uncompressed file."""

    def __init__(self, stream, name: str):
        self.stream, self.name, self.data, self.base = stream, name, b"", 0

    def more(self) -> bool:
        got = self.stream.read(CHUNK)
        self.data += got
        return bool(got)

    def records(self) -> Iterator[tuple[int, dict, object]]:
        while True:
            while self.data[:1] in (b"\r", b"\n"):
                self.base, self.data = self.base + 1, self.data[1:]
            if not self.data and not self.more():
                return
            if self.data[:1] in (b"\r", b"\n"):
                continue
            while (end := self.data.find(b"\r\n\r\n")) < 0:
                if not self.more():
                    raise ValueError(f"{self.name}: header cut off at {self.base}")
            head = _fields(self.data[:end])
            size, start = int(head.get("content-length", 0)), self.base
            self.base, self.data = self.base + end + 4, self.data[end + 4:]
            taken = False

            def block() -> bytes:
                nonlocal taken
                taken = True
                while len(self.data) < size and self.more():
                    pass
                out, self.data = self.data[:size], self.data[size:]
                if len(out) < size:
                    raise ValueError(f"{self.name}: record cut off at {start}")
                return out

            yield start, head, block
            if not taken:  # read past the payload
                if size <= len(self.data):
                    self.data = self.data[size:]
                else:
                    self.stream.seek(self.base + size)
                    self.data = b""
            self.base += size


class _Gzip:
    """Records of a file with one gzip member a record."""

    def __init__(self, stream, name: str):
        self.stream, self.name = stream, name

    def records(self) -> Iterator[tuple[int, dict, object]]:
        at = 0
        while True:
            self.stream.seek(at)
            raw = self.stream.read(4096)
            if not raw:
                return
            if raw[:3] != b"\x1f\x8b\x08":
                raise ValueError(f"{self.name}: no gzip member at {at}")
            skip = None
            if raw[3] & 4:
                size = struct.unpack("<H", raw[10:12])[0]
                extra = raw[12:12 + size]
                if extra[:2] == b"sl" and size >= 12:
                    skip = struct.unpack("<I", extra[4:8])[0]
            z = zlib.decompressobj(31)
            data, read = z.decompress(raw, 8192), len(raw)

            def more() -> bool:
                nonlocal data, read
                if z.eof:
                    return False
                feed = z.unconsumed_tail
                if not feed:
                    feed = self.stream.read(CHUNK)
                    read += len(feed)
                    if not feed:
                        raise ValueError(f"{self.name}: member cut off at {at}")
                data += z.decompress(feed, 1 << 20)
                return True

            while (end := data.find(b"\r\n\r\n")) < 0 and more():
                pass
            if end < 0:
                raise ValueError(f"{self.name}: no WARC header at {at}")
            head = _fields(data[:end])

            def block() -> bytes:
                size = int(head.get("content-length", 0))
                while len(data) < end + 4 + size and more():
                    pass
                return data[end + 4:end + 4 + size]

            yield at, head, block
            if skip is None:
                while more():
                    data = data[-4:] if len(data) > 1 << 20 else data
                skip = read - len(z.unused_data)
            at += skip


# ------------------------------------------------------------------ data source

@dataclass
class _Files(InputPartition):
    names: list[str]

    def __init__(self, names: list[str]):
        super().__init__(names)
        self.names = names


def _passes(test: Filter, value: str | None) -> bool:
    if isinstance(test, IsNull):
        return value is None
    if isinstance(test, EqualNullSafe):
        return value == test.value
    if value is None:
        return False
    if isinstance(test, IsNotNull):
        return True
    if isinstance(test, EqualTo):
        return value == test.value
    if isinstance(test, In):
        return value in test.value
    if isinstance(test, StringStartsWith):
        return value.startswith(test.value)
    if isinstance(test, StringEndsWith):
        return value.endswith(test.value)
    return test.value in value


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.verify = str(options.get("verify", "false")).lower() == "true"
        self.tests: list[tuple[str, Filter]] = []

    def pushFilters(self, filters: list[Filter]):
        kinds = (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)
        for f in filters:
            if isinstance(f, kinds) and len(f.attribute) == 1 and f.attribute[0] in HEADER:
                self.tests.append((f.attribute[0], f))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.Directory:
            files = fs.get_file_info(pafs.FileSelector(root, recursive=True))
        elif info.type == pafs.FileType.File:
            files = [info]
        else:
            raise FileNotFoundError(self.path)
        out: list[InputPartition] = []
        room = 0
        for f in sorted(files, key=lambda x: x.path):
            base = f.path.rsplit("/", 1)[-1]
            if f.type != pafs.FileType.File or base[:1] in "._" or not base.endswith((".warc", ".warc.gz")):
                continue
            if not out or f.size > room:
                out.append(_Files([]))
                room = PARTITION_BYTES
            out[-1].names.append(f.path)
            room -= f.size
        return out

    def read(self, partition: _Files | None) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        rows, size = [], 0
        for name in partition.names if partition is not None else []:  # no file: no partition
            with fs.open_input_file(name) as stream:
                source = (_Gzip if name.endswith(".gz") else _Plain)(stream, name)
                for position, head, block in source.records():
                    field = {c: self._column(c, head) for c in HEADER}
                    if not all(_passes(test, field[c]) for c, test in self.tests):
                        continue
                    row = field | {"file": name, "position": position, "http_status": None, "payload_bytes": None,
                                   "payload": None}
                    if self.payload:
                        row |= self._payload(head, block(), name, position)
                    rows.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)

    @staticmethod
    def _column(name: str, head: dict) -> str | None:
        value = head.get(HEADER[name])
        if value is not None and name in ("record_id", "refers_to"):
            value = value.strip("<>")
        if value is not None and name == "payload_digest":
            value = value.removeprefix("sha1:")
        return value

    def _payload(self, head: dict, block: bytes, name: str, position: int) -> dict:
        if not head.get("content-type", "").startswith("application/http"):
            return {"payload": block, "payload_bytes": len(block)}
        top, _, body = block.partition(b"\r\n\r\n")
        status = top.split(b" ", 2)
        http = _fields(top)
        out = {"http_status": int(status[1]) if len(status) > 1 and status[1].isdigit() else None}
        if head.get("warc-type") == "revisit":
            length = http.get("content-length", "")
            return out | {"payload_bytes": int(length) if length.isdigit() else None}
        if self.verify and head.get("warc-payload-digest", "").startswith("sha1:"):
            if head["warc-payload-digest"][5:] != sha1_base32(body):
                raise ValueError(f"{name}: payload digest differs at {position}")
        return out | {"payload": body, "payload_bytes": len(body)}


class WarcDataSource(DataSource):
    """WARC archives under a directory, or one file; see the module's docstring for its options."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make format ``warc`` known to the session and let Spark push predicates to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


# ------------------------------------------------------------------ writer

def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> int:
    """Write one record a page under ``path``; returns the number of files."""
    pages = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                         F.col(f"`{url_col}`").cast("string").alias("url"),
                         F.encode(F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    pages = pages.withColumn("key", F.concat(F.sha2("payload", 256), F.lit(":"), F.octet_length("payload")))
    slim = pages.where(f"page_id is not null and octet_length(payload) >= {int(min_bytes)}").select("page_id", "key")
    first = slim.groupBy("key").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    again = slim.join(first.where("first != last"), "key").where("page_id != first").select("page_id", "key", "first").distinct()
    rows = pages.join(again, ["page_id", "key"], "left").select("page_id", "url", "payload", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        task, done, out, size = TaskContext.get().partitionId(), [], None, 0
        for b in batches:
            for page_id, url, payload, first in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "first"))):
                if out is None:
                    part = f"{root}/.{task:06d}-{len(done):04d}-{uuid.uuid4().hex}"
                    out, size = fs.open_output_stream(part), 0
                    done.append(part)
                digest = sha1_base32(payload)
                name = f"urn:x-page:{page_id}:{digest}"
                other = None if first is None else f"urn:x-page:{first}:{digest}"
                raw = gzip_member(record("response" if first is None else "revisit", name, url, date, payload, digest, other))
                out.write(raw)
                size += len(raw)
                if size > FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.record_batch([pa.array(done, pa.string())], names=["part"])

    # only files of tasks that ended well are named here; they get their names now
    parts = sorted(r["part"] for r in rows.mapInArrow(write, "part string").collect())
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)
    for k, part in enumerate(parts):
        fs.move(part, f"{root}/pages-{k:06d}.warc.gz")
    return len(parts)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` of archives of ``write_warc``."""
    register(spark)
    number = lambda c: F.regexp_extract(c, r"^urn:x-page:(-?\d+):", 1)
    return (spark.read.format("warc").option("verify", "true").load(path)
            .where(F.col("warc_type").isin("response", "revisit"))
            .select(F.expr("try_cast(regexp_extract(record_id, '^urn:x-page:(-?[0-9]+):', 1) as bigint)").alias("page_id"),
                    F.col("target_uri").alias("url"), "payload_bytes", "payload_digest",
                    F.col("warc_type").alias("record_type"),
                    F.when(number("refers_to") != "", number("refers_to").cast("long")).alias("refers_to"), "payload"))
