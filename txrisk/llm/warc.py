"""WARC as a PySpark Python data source (format name ``warc``), both ways.

Writing: every task writes its records, one gzip member each, to files of
its own in the target folder and rolls over to a new file at ``roll_bytes``.
The gzip header of a member carries its compressed and its plain length
(extra field ``sl``), so a reader can step over a record without inflating
it.  A manifest written on commit lists the files of successful tasks; what
a lost or repeated task left behind is not in it and never read.

Reading: the driver plans partitions from the manifest (or a folder
listing), many small files to a partition, up to ``split_bytes``.  Equality
and IN filters on the record type and the header columns are pushed down.  A
reader inflates only the head of a member, parses its headers, tests the
filters, and steps over the rest if the record is not wanted; payloads are
inflated only for ``payload=true`` and digests are then verified.

Columns: record_type, record_id, target_uri, refers_to, payload_digest
(``sha1:`` and base32), payload_bytes (as the HTTP headers declare it), and
payload (binary; null unless asked for, and for revisits).  Paths may use
any file system that pyarrow opens by URI.  A damaged member raises.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import time
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage,
)

from txrisk.llm.common import shared_folder

SCHEMA = ("record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
          "payload_bytes long, payload binary")
MANIFEST = "_records"
OVERWRITE = "-overwrite"
HEAD_BYTES = 4096
# FIXED VALUES: names of the header lines in a WARC 1.1 record.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a plain local path."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def digest_of(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value) -> str:
    """A header value: one line."""
    return " ".join(str(value).split())


def record_bytes(row: dict) -> bytes:
    """One record: WARC headers, HTTP headers, and a response's payload."""
    payload, row = row["payload"] or b"", dict(row)
    if row["payload_digest"] and len(row["payload_digest"]) == 40:  # as sha1() gives it
        row["payload_digest"] = "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    block = http + (payload if row["record_type"] == "response" else b"")
    lines = ["WARC/1.1", *(f"{name}: {_clean(row[key])}" for key, name in HEADERS.items() if row[key] is not None)]
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += [f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(plain: bytes, level: int = 1) -> bytes:
    """A gzip member whose extra field gives compressed and plain length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(plain) + packer.flush()
    end = struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)
    if len(body) + 32 >= 1 << 32 or len(plain) >= 1 << 32:  # no room for the lengths
        return b"\x1f\x8b\x08\0" + b"\0" * 4 + b"\0\xff" + body + end
    extra = b"sl" + struct.pack("<HII", 8, len(body) + 32, len(plain))
    return b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", len(extra)) + extra + body + end


@dataclass
class Written(WriterCommitMessage):
    files: list


def _write(system, name: str, raw: bytes) -> None:
    with system.open_output_stream(name, compression=None) as out:
        out.write(raw)


def manifests(system, folder: str) -> list[str]:
    """Manifests of the committed jobs that count: those since the last
    overwrite (names sort by time of commit; an overwrite's says so)."""
    found = sorted(i.path for i in system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
                   if i.base_name.startswith(MANIFEST))
    last = max((k for k, name in enumerate(found) if name.endswith(OVERWRITE)), default=0)
    return found[last:]


def committed(system, folder: str) -> list[list]:
    """[name, bytes] of every archive of the committed jobs."""
    out = []
    for name in manifests(system, folder):
        with system.open_input_stream(name, compression=None) as file:
            out += json.loads(file.read())
    return out


class Writer(DataSourceArrowWriter):
    """Archives of one job; its manifest, written at commit, makes them count.
    ``append`` adds a manifest; ``overwrite`` adds one that hides the earlier
    ones and then deletes what they named."""

    def __init__(self, options, overwrite: bool = False) -> None:
        self.path, self.roll, self.overwrite = options["path"], int(options.get("roll_bytes", 128 << 20)), overwrite

    def write(self, iterator) -> Written:
        system, folder = open_folder(self.path)
        system.create_dir(folder, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if out is None:
                    files.append([f"part-{uuid.uuid4().hex}.warc.gz", 0])
                    out, size = system.open_output_stream(f"{folder}/{files[-1][0]}", compression=None), 0
                size += out.write(member(record_bytes(dict(zip(batch.schema.names, row, strict=True)))))
                files[-1][1] = size
                if size >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        system, folder = open_folder(self.path)
        system.create_dir(folder, recursive=True)
        before = (manifests(system, folder), committed(system, folder)) if self.overwrite else ([], [])
        files = [f for m in messages if m for f in m.files]
        name = f"{folder}/{MANIFEST}-{time.time_ns():020d}-{uuid.uuid4().hex}{OVERWRITE if self.overwrite else ''}"
        _write(system, name, json.dumps(files).encode())
        for old in [*before[0], *(f"{folder}/{f[0]}" for f in before[1])]:
            system.delete_file(old)

    def abort(self, messages) -> None:
        """Nothing to undo: files outside a manifest are never read."""


@dataclass
class Files(InputPartition):
    names: list


class Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path, self.split = options["path"], int(options.get("split_bytes", 64 << 20))
        self.payload = str(options.get("payload", "false")).lower() == "true"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        """Take equality and IN on header columns; Spark keeps the others."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in HEADERS:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted[name] & values if name in self.wanted else values
            else:
                yield f

    def partitions(self) -> list:
        system, folder = open_folder(self.path)
        if manifests(system, folder):
            files = committed(system, folder)
        else:
            found = system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
            files = [[f.path[len(folder.rstrip("/")) + 1:], f.size] for f in found if f.path.endswith((".warc.gz", ".warc"))]
        out, size = [Files([])], 0
        for name, n in sorted(files):
            if out[-1].names and size + n > self.split:
                out.append(Files([]))
                size = 0
            out[-1].names.append(name)
            size += n
        return out

    def read(self, partition: Files):
        system, folder = open_folder(self.path)
        for name in partition.names:
            rows: list[tuple] = []
            weight = 0
            with system.open_input_file(f"{folder}/{name}") as source:
                for row in (_plain(source, self) if name.endswith(".warc") else _members(source, self)):
                    rows.append(row)
                    weight += 500 + len(row[6] or b"")
                    if weight > 8 << 20:
                        yield _batch(rows)
                        rows, weight = [], 0
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string()] * 5 + [pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=[c.split()[0] for c in SCHEMA.split(", ")])


def _parse(head: bytes) -> tuple[dict, int]:
    """Header fields (lower-case names) and where the block begins."""
    end = head.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("WARC header is not complete")
    lines = head[:end].decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines[1:]:
        key, _, value = line.partition(":")
        fields[key.strip().lower()] = value.strip()
    return fields, end + 4


def _passes(fields: dict, wanted: dict) -> bool:
    return all(fields.get(HEADERS[k].lower()) in v for k, v in wanted.items())


def _row(fields: dict, block: bytes, with_payload: bool) -> tuple:
    split = block.find(b"\r\n\r\n")
    http, _ = _parse(block) if split >= 0 else ({}, 0)
    kind, payload = fields.get("warc-type"), None
    if with_payload and kind == "response":
        payload = block[split + 4:]
        if digest_of(payload) != fields.get("warc-payload-digest", digest_of(payload)):
            raise ValueError(f"payload digest of {fields.get('warc-record-id')} does not match")
    size = http.get("content-length")
    return (*(fields.get(h.lower()) for h in HEADERS.values()), int(size) if size else None, payload)


def _header_head(inflate, data: bytes, grow) -> tuple[bytes, dict, int]:
    """Inflate until the WARC headers (and the HTTP headers) are there."""
    plain = inflate(data, HEAD_BYTES)
    while plain.count(b"\r\n\r\n") < 2:
        more = grow()
        if not more:
            break
        plain += more
    return plain, *_parse(plain)


def _members(source, reader: Reader):
    """Rows of a file of gzip members, stepping over unwanted ones."""
    size, at = source.size(), 0
    while at < size:
        source.seek(at)
        head = source.read(64)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError("not a gzip member")
        known = None
        if head[3] & 4:
            extra = head[12: 12 + struct.unpack("<H", head[10:12])[0]]
            if extra[:2] == b"sl":
                known = struct.unpack("<II", extra[4:12])
        unpack = zlib.decompressobj(31)

        def feed(limit=HEAD_BYTES, unpack=unpack):
            """More plain bytes of this member, at most ``limit`` at a time."""
            while not unpack.eof:
                packed = unpack.unconsumed_tail or source.read(1 << 14)
                got = unpack.decompress(packed, limit)
                if got:
                    return got
                if not packed:
                    raise ValueError("truncated gzip member")
            return b""
        plain, fields, begin = _header_head(unpack.decompress, head, feed)
        wanted = _passes(fields, reader.wanted)
        if (wanted and reader.payload) or known is None:
            parts = [plain]
            while more := feed(1 << 20):
                parts.append(more)
            plain = b"".join(parts)
            at = source.tell() - len(unpack.unused_data)
        else:
            at += known[0]
        if wanted:
            length = int(fields.get("content-length", 0))
            yield _row(fields, plain[begin: begin + length], reader.payload)


def _plain(source, reader: Reader):
    """Rows of an uncompressed file, stepping over unwanted blocks."""
    size, at = source.size(), 0
    while at < size:
        source.seek(at)
        head = source.read(HEAD_BYTES)
        while b"\r\n\r\n" not in head and (more := source.read(HEAD_BYTES)):
            head += more
        fields, begin = _parse(head)
        length = int(fields.get("content-length", 0))
        if _passes(fields, reader.wanted):
            take = length if reader.payload else min(length, HEAD_BYTES)
            block = head[begin: begin + take]
            block += source.read(take - len(block))
            yield _row(fields, block, reader.payload)
        at += begin + length + 4


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)

    def writer(self, schema, overwrite) -> Writer:
        return Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def page_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """WARC rows of (page_id, url, html): of equal payloads of at least
    ``least_bytes`` the smallest page_id is the response, others revisit it.

    Null html is an empty payload; a null page_id sorts last.  Rows that
    repeat a page_id with the same payload share one role.  The record id
    carries the page_id."""
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")) \
        .withColumns({"sha": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    groups = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("sha").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id")).alias("head"), F.count("*").alias("m")) \
        .where("m > 1").select(F.col("sha").alias("_sha"), F.col("head.page_id").alias("head_id"))
    marked = rows.join(groups, F.col("sha") == F.col("_sha"), "left")
    revisit = F.col("_sha").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head_id"))
    return marked.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), record_id(F.col("page_id")).alias("record_id"),
        F.col("url").cast("string").alias("target_uri"), F.when(revisit, record_id(F.col("head_id"))).alias("refers_to"),
        F.col("sha").alias("payload_digest"), "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"))


def record_id(page_id: Column) -> Column:
    """URN with the 64 bits of the page_id (a version-8 UUID; nil for null)."""
    bits = F.lower(F.lpad(F.hex(page_id.cast("long")), 16, "0"))
    return F.coalesce(
        F.concat(F.lit("<urn:uuid:"), F.substring(bits, 1, 8), F.lit("-"), F.substring(bits, 9, 4), F.lit("-8"),
                 F.substring(bits, 13, 3), F.lit("-8"), F.substring(bits, 16, 1), F.lit("00-000000000000>")),
        F.lit("<urn:uuid:00000000-0000-0000-0000-000000000000>"))


def page_id_of(column: Column) -> Column:
    """The page_id in a record id (null where there is none)."""
    digits = F.regexp_replace(column, r"^<urn:uuid:(.{8})-(.{4})-8(.{3})-8(.)00-0{12}>$", "$1$2$3$4")
    return F.when(F.length(digits) == 16, F.conv(digits, 16, -10).cast("long"))


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages' records, then read the archives back (payloads
    inflated and their digests verified): one row per page."""
    spark = pages.sparkSession
    register(spark)
    folder = path or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    page_records(pages).write.format("warc").option("path", folder).mode("append").save()
    back = spark.read.format("warc").option("path", folder).option("payload", "true").load()
    return back.select(
        page_id_of(F.col("record_id")).alias("page_id"),
        F.coalesce(F.octet_length("payload"), F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
        page_id_of(F.col("refers_to")).alias("refers_to"))
