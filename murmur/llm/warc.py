r"""WARC archives as a Python data source, and the writing of pages with revisit records.

Reading plans one partition per archive file (those that the last commit lists, or all *.warc and
*.warc.gz). Predicates on record type and header columns are pushed down: of each record the headers
are parsed first, and the payload of a record that fails them, or any payload with the option
`payload` = "false", is never decoded. Compressed archives hold one gzip member per record, whose
extra field "sl" gives its compressed length, so that a reader inflates the headers only and goes
on to the next member; members without it are inflated piece by piece. Paths go through Arrow's file
systems. A task writes a file of its own name; only files of committed tasks are listed.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull,
                                    StringStartsWith, WriterCommitMessage)

from murmur.llm.common import small, stored

#: Column -> WARC header.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "refers_to": "WARC-Refers-To",
           "payload_digest": "WARC-Payload-Digest", "content_type": "Content-Type"}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_length long, payload binary"
COMMITTED = "_committed"
PIECE = 1 << 16


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a path with or without scheme."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if re.match(r"[a-z][a-z0-9+.-]*:", path) else f"file://{path}")


def _header(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(row: dict) -> bytes:
    """One record: an HTTP response with its payload, or a revisit with the HTTP headers alone."""
    payload, n = row["payload"] or b"", row["payload_length"] or 0
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    if row["record_type"] != "revisit":
        block += payload
    lines = ["WARC/1.1", *(f"{HEADERS[c]}: {_header(row[c])}" for c in HEADERS if c != "content_type" and row.get(c) is not None)]
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    """A gzip member whose extra field "sl" holds its own length and that of the data (uint32 each)."""
    body = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = body.compress(data) + body.flush()
    size = 10 + 2 + 12 + len(packed) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + packed + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class Plain:
    """The bytes of one record in an uncompressed archive."""

    def __init__(self, file):
        self.file, self.left = file, b""

    def more(self) -> bytes:
        return self.file.read(PIECE)

    def rest(self, skip: int) -> None:
        self.file.seek(skip, 1)


class Inflated:
    """The inflated bytes of one gzip member, as far as they are asked for."""

    def __init__(self, file, start: int):
        self.file, self.start = file, start
        self.z = zlib.decompressobj(31)
        self.fed = b""

    def more(self, first: bool = False) -> bytes:
        if self.z.eof:
            return b""
        data = self.z.unconsumed_tail or self.file.read(2048 if first else PIECE)
        if not data:
            return b""
        return self.z.decompress(data, 2048 if first else PIECE) or self.more()


def read_archive(file, wanted, payloads: bool):
    """Yield the columns of each wanted record of an open archive."""
    size = file.size()
    at = 0
    while at < size:
        file.seek(at)
        lead = file.read(2)
        file.seek(at)
        zipped = lead == b"\x1f\x8b"
        if zipped:
            length = _member_length(file.read(24))
            file.seek(at)
            source = Inflated(file, at)
            data = source.more(first=True)
        else:
            length, source, data = None, Plain(file), file.read(PIECE)
        first = True
        while True:  # the records of a member, or one record of a plain archive
            while not data.strip(b"\r\n") and (data := source.more()):
                pass
            data = data.lstrip(b"\r\n") if zipped else data
            if not data.strip(b"\r\n"):
                if not zipped and first:
                    return
                break
            first = False
            while b"\r\n\r\n" not in data:
                more = source.more()
                if not more:
                    raise ValueError(f"truncated record header after byte {at}")
                data += more
            head, _, data = data.partition(b"\r\n\r\n")
            fields = {}
            for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
                key, _, value = line.partition(":")
                fields[key.strip().lower()] = value.strip()
            row = {c: fields.get(h.lower()) for c, h in HEADERS.items()}
            n = int(fields.get("content-length", 0))
            if wanted(row):
                http = (row["content_type"] or "").startswith("application/http")
                take = payloads and row["record_type"] != "revisit"
                parts, got = [data], len(data)
                while got < n and (take or http and b"\r\n\r\n" not in b"".join(parts)):
                    more = source.more()
                    if not more:
                        raise ValueError(f"truncated record block after byte {at}")
                    parts.append(more)
                    got += len(more)
                data = b"".join(parts)
                block = data[:n]
                row["payload_length"], row["payload"] = n, None
                if http:
                    front, _, body = block.partition(b"\r\n\r\n")
                    said = re.search(rb"(?im)^content-length:\s*(\d+)", front)
                    row["payload_length"] = int(said[1]) if said else n - len(front) - 4
                    block = body
                if take:
                    row["payload"] = block
                yield row
            if not zipped or length:
                break
            left = n  # bytes of the block that are still ahead
            while left > len(data):
                left -= len(data)
                data = source.more()
                if not data:
                    raise ValueError(f"truncated record block after byte {at}")
            data = data[left:]
        if not zipped:
            at += len(head) + 4 + n + 4
        elif length:
            at += length
        elif not source.z.eof:
            raise ValueError(f"truncated member at byte {at}")
        else:
            at = file.tell() - len(source.z.unused_data)


def _member_length(start: bytes) -> int | None:
    if len(start) < 24 or not start[3] & 4 or start[12:14] != b"sl":
        return None
    return struct.unpack_from("<I", start, 16)[0] or None


@dataclass
class Archive(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.payloads = options["path"], options.get("payload", "true").lower() != "false"
        self.tests: list[tuple] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, EqualNullSafe, In, IsNotNull, IsNull, StringStartsWith)):
                self.tests.append((type(f).__name__, column, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        fs, root = filesystem(self.path)
        files = fs.get_file_info(pafs.FileSelector(root))
        lists = [i.path for i in files if i.base_name.startswith(COMMITTED)]
        names = [] if lists else [i.base_name for i in files if re.search(r"\.warc(\.gz)?$", i.base_name)]
        for path in lists:  # one of each append
            with fs.open_input_stream(path) as f:
                names += json.loads(f.read())
        names = sorted(names)
        return [Archive(f"{self.path}/{n}") for n in names]

    def wanted(self, row: dict) -> bool:
        for kind, column, value in self.tests:
            has = row[column]
            if not (has == value if kind in ("EqualTo", "EqualNullSafe") else has in value if kind == "In" else has is not None if kind == "IsNotNull"
                    else has is None if kind == "IsNull" else has is not None and has.startswith(value)):
                return False
        return True

    def read(self, partition):
        if partition is None:  # an empty archive
            return
        schema = pa.schema([(c, pa.string()) for c in HEADERS] + [("payload_length", pa.int64()), ("payload", pa.binary())])
        fs, path = filesystem(partition.path)
        rows, held = [], 0
        with fs.open_input_file(path) as file:
            for row in read_archive(file, self.wanted, self.payloads):
                rows.append(row)
                held += len(row["payload"] or b"") + 500
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        name, out = f"part-{uuid.uuid4().hex}.warc.gz", None
        for batch in iterator:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(member(record(row)))
        if out:
            out.close()
        return Written([name] if out else [])

    def commit(self, messages):
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{COMMITTED}-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps(sorted(n for m in messages if m for n in m.names)).encode())

    def abort(self, messages):
        fs, root = filesystem(self.path)
        for m in messages:
            for n in m.names if m else []:
                fs.delete_file(f"{root}/{n}")


class Warc(DataSource):
    """`spark.read.format("warc")` and `df.write.format("warc")`; columns: SCHEMA."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_pages(pages: DataFrame, path: str, least: int = 1000, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record per row of `pages` below `path`.

    The payload is the html in UTF-8 (null: empty). Of rows with equal payloads of at least `least`
    bytes those with the largest id are response records, the others revisit it; all smaller ones
    are responses. Payloads are told apart by their SHA-256, which is grouped with partial aggregation;
    only groups of several rows are joined back, broadcast if their counted number is small. Rows
    repeated with the largest id are responses each. A null id is written as an empty one and comes
    last. Other columns are ignored; an empty table gives an empty archive.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("target_uri"), html.alias("html"))
    rows = rows.withColumn("payload_length", F.octet_length("html").cast("long"))
    rows = rows.withColumn("same", F.when(F.col("payload_length") >= least, F.unhex(F.sha2("html", 256))))
    groups = rows.where("same is not null").groupBy("same").agg(F.max("page_id").alias("first"), F.count("*").alias("c")).where("c > 1").select("same", "first")
    rows = rows.join(small(stored(groups, "payloads"), 200_000), "same", "left")
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    rows.select(F.when(revisits, "revisit").otherwise("response").alias("record_type"), name("page_id").alias("record_id"), "target_uri", F.lit(date).alias("date"),
                F.when(revisits, name("first")).alias("refers_to"), F.concat(F.lit("sha1:"), F.sha1("html")).alias("payload_digest"), F.lit(None).cast("string").alias("content_type"),
                "payload_length", F.when(~revisits, F.col("html").cast("binary")).alias("payload")).write.format("warc").mode("append").save(path)
