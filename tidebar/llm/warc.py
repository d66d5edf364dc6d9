"""WARC archives as a Spark data source, `format("warc")`, for reading and writing.

Writing: each task writes files of its own, one gzip member per record; a commit then lists
them in a manifest, so files of failed or repeated attempts are never read. Reading: a
partition is a file, or several small ones. Filters on header columns are pushed down: a
record's headers are parsed first, and the payload of a record that no filter wants, or of
any record where `payload` is not asked for, is passed over without being inflated, by the
lengths that the member's extra field holds (`sl`, as the WARC standard describes it).

Paths are URIs that pyarrow's file systems open (file, hdfs, s3, gs) or local paths.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)

from tidebar.session import materialize, scratch_dir

#: Columns of a record: what the headers say, then the payload.
SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, page_id long, "
    "payload_digest string, payload_bytes long, refers_to long, refers_to_record string, payload binary"
)
#: WARC header names of those columns. Those that begin with X are extensions of our own.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "page_id": "X-Page-Id",
    "payload_bytes": "X-Payload-Length",
    "refers_to": "X-Refers-To-Page-Id",
    "refers_to_record": "WARC-Refers-To",
}
LONGS = ("page_id", "payload_bytes", "refers_to")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A task begins a new file beyond this size; small files are read together up to it.
FILE_BYTES = 64 << 20

_CHUNK = 1 << 16


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _clean(value) -> str:
    """A header value on one line."""
    return " ".join(str(value).split())


def record(fields: dict) -> bytes:
    """A record as one gzip member that states its lengths. fields: by column of SCHEMA."""
    payload = fields.get("payload") or b""
    head = ["WARC/1.1"]
    for column, name in HEADERS.items():
        value = fields.get(column)
        if value is not None:
            head.append(f"{name}: {'sha1:' if column == 'payload_digest' else ''}{_clean(value)}")
    if fields.get("record_type") == "revisit":
        head.append(f"WARC-Profile: {PROFILE}")
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"
    deflate = zlib.compressobj(3, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    size = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    start = b"\x1f\x8b\x08\x04" + b"\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return start + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


@dataclass
class _Files(WriterCommitMessage):
    names: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Files:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        out, written = None, []
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or written[-1][1] >= FILE_BYTES:
                    if out:
                        out.close()
                    written.append((f"part-{uuid.uuid4().hex}.warc.gz", 0))
                    out = fs.open_output_stream(f"{root}/{written[-1][0]}", compression=None)
                data = record(row)
                out.write(data)
                written[-1] = (written[-1][0], written[-1][1] + len(data))
        if out:
            out.close()
        return _Files(written)

    def commit(self, messages: list) -> None:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        listed = [] if self.overwrite else _manifest(fs, root) or []
        listed += [list(x) for m in messages if m for x in m.names]
        with fs.open_output_stream(f"{root}/_manifest.new") as f:
            f.write(json.dumps(listed).encode())
        fs.move(f"{root}/_manifest.new", f"{root}/_manifest.json")

    def abort(self, messages: list) -> None:
        fs, root = filesystem(self.path)
        for name, _ in (x for m in messages if m for x in m.names):
            fs.delete_file(f"{root}/{name}")


def _manifest(fs: pa.fs.FileSystem, root: str) -> list | None:
    if fs.get_file_info(f"{root}/_manifest.json").type == pa.fs.FileType.NotFound:
        return None
    with fs.open_input_stream(f"{root}/_manifest.json") as f:
        return json.loads(f.read())


class _Member:
    """One gzip member, or one plain record, at the present place of a file."""

    def __init__(self, stream, base: int, gzipped: bool) -> None:
        self.stream, self.base, self.gzipped = stream, base, gzipped
        self.length = None
        self.inflate = zlib.decompressobj(31) if gzipped else None
        self.held = b""
        if gzipped:
            start = stream.read(24)
            stream.seek(base)
            if len(start) == 24 and start[3] == 4 and start[12:14] == b"sl":
                packed, plain = struct.unpack("<II", start[16:24])
                # both are modulo 2^32; only a record well below that is known to be so long
                self.length = packed if plain < 1 << 31 and packed < 1 << 31 else None

    def read(self, size: int) -> bytes:
        """Up to `size` more bytes of the record; empty at its end."""
        if not self.gzipped:
            return self.stream.read(size)
        while not self.inflate.eof:
            data = self.held or self.stream.read(_CHUNK)
            if not data and not self.inflate.unconsumed_tail:
                raise EOFError("a gzip member is cut short")
            got = self.inflate.decompress(data, size)
            self.held = self.inflate.unconsumed_tail
            if got:
                return got
        return b""

    def end(self, plain_end: int) -> int:
        """Where the next record begins; passes over what was not read."""
        if not self.gzipped:
            return plain_end
        if self.length:
            return self.base + self.length
        while self.read(_CHUNK):
            pass
        return self.stream.tell() - len(self.inflate.unused_data)


def _headers(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with a space continues one."""
    fields, last = {}, None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            fields[last] = value.strip()
    return fields


def _columns(fields: dict[str, str]) -> dict:
    out = {c: fields.get(name.lower()) for c, name in HEADERS.items()}
    for name in LONGS:
        out[name] = int(out[name]) if out[name] is not None else None
    if out["payload_digest"]:
        out["payload_digest"] = out["payload_digest"].rpartition(":")[2]
    return out


def records(stream, gzipped: bool, wanted, payloads: bool) -> Iterator[dict]:
    """Records of a file by column; payload only if asked for, and only where `wanted(columns)`."""
    base, size = 0, stream.size()
    while base < size:
        stream.seek(base)
        member = _Member(stream, base, gzipped)
        held, lead, at = b"", 0, -1
        while at < 0:
            got = member.read(1 << 12)
            if not got:
                break
            held += got
            lead = len(held) - len(held.lstrip(b"\r\n"))  # what ends the record before
            at = held.find(b"\r\n\r\n", lead)
        if at < 0:
            if held.strip():
                raise ValueError(f"no WARC header at byte {base}")
            base = member.end(base + max(1, len(held)))
            continue
        block = held[lead:at]
        if not block.startswith(b"WARC/"):
            raise ValueError(f"no WARC header at byte {base}")
        fields = _headers(block)
        length = int(fields.get("content-length", 0))
        columns = _columns(fields)
        if wanted(columns):
            if payloads:
                body = io.BytesIO()
                body.write(held[at + 4 : at + 4 + length])
                while body.tell() < length:
                    got = member.read(min(_CHUNK, length - body.tell()))
                    if not got:
                        raise EOFError(f"the record at byte {base} is cut short")
                    body.write(got)
                columns["payload"] = body.getvalue()
            yield columns
        base = member.end(base + at + 4 + length)


class WarcReader(DataSourceReader):
    def __init__(self, schema, options: dict) -> None:
        self.path = options["path"].rstrip("/")
        self.names = schema.fieldNames()
        self.tests: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if isinstance(f, EqualTo) and column in HEADERS and f.value is not None:
                self.tests.append((column, (f.value,)))
            elif isinstance(f, In) and column in HEADERS:
                self.tests.append((column, tuple(f.value)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = filesystem(self.path)
        info = fs.get_file_info(root)
        if info.type == pa.fs.FileType.File:
            return [InputPartition([root])]
        listed = _manifest(fs, root)
        if listed is None:
            found = fs.get_file_info(pa.fs.FileSelector(root, recursive=True))
            found = [x for x in found if x.is_file and x.path.endswith((".warc", ".warc.gz"))]
            files = [(x.path, x.size) for x in found]
        else:
            files = [(f"{root}/{name}", size) for name, size in listed]
        packs, size = [], FILE_BYTES
        for path, own in sorted(files):
            if size + own > FILE_BYTES // 4:
                packs.append([])
                size = 0
            packs[-1].append(path)
            size += own
        return [InputPartition(p) for p in packs] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fs, _ = filesystem(self.path)

        def wanted(columns: dict) -> bool:
            return all(columns[name] in values for name, values in self.tests)

        for path in partition.value:
            with fs.open_input_file(path) as stream:
                for row in records(stream, path.endswith(".gz"), wanted, "payload" in self.names):
                    yield tuple(row.get(n) for n in self.names)


class WarcDataSource(DataSource):
    """See the module. Options: path; schema: any of SCHEMA's columns, all by default."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def base32_sha1(payload: bytes) -> str:
    return b32encode(hashlib.sha1(payload).digest()).decode()


def digest_column(payload):
    """Upper-case base32 of the SHA-1 of a column's UTF-8, from its hex digits by tens."""
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), digits, letters)


def _uuid(name):
    """A UUID from the MD5 of a name, the same when a task runs again."""
    pattern = "^(.{8})(.{4})(.{4})(.{4})(.{12})$"
    return F.regexp_replace(F.md5(name.cast("binary")), pattern, "$1-$2-$3-$4-$5")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def page_records(pages: DataFrame) -> DataFrame:
    """The WARC record of each page, columns of SCHEMA.

    Of pages with equal payloads (html in UTF-8, null: empty) that with the smallest page_id
    is a response with the payload, as is a repeated row of it; the others are revisits that
    name it, by page and by record id, and hold none. A null page_id is a revisit if a page with an id has its payload,
    else a response. Only digests and ids are aggregated; payloads are shuffled once.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("target_uri"),
        payload.alias("payload"),
        digest_column(payload).alias("payload_digest"),
    )
    first = own.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"))
    # a table, so that the join can split the pages of a payload that very many share
    first = materialize(first, scratch_dir(pages.sparkSession, "digests"))
    revisit = ~F.col("page_id").eqNullSafe(F.col("first_id"))

    def record_id(*parts) -> Column:
        return F.concat(F.lit("<urn:uuid:"), _uuid(F.concat_ws(" ", *parts)), F.lit(">"))

    of_revisit = record_id("page_id", "target_uri", "payload_digest")
    return own.join(first, "payload_digest").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, of_revisit).otherwise(record_id(F.lit("response"), "page_id", "payload_digest")).alias("record_id"),
        "target_uri",
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        "page_id",
        "payload_digest",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
        F.when(revisit, record_id(F.lit("response"), "first_id", "payload_digest")).alias("refers_to_record"),
        F.when(~revisit, F.col("payload").cast("binary")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str) -> None:
    """Archive `pages` under `path`; see `page_records`. An empty table gives an empty archive."""
    register(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The records of an archive; without `payload` among `columns` no payload is inflated.

    Spark hands filters to Python sources only with the setting below, which it reads when the
    result is planned, so it stays on in this session.
    """
    register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("warc")
    if columns:
        types = dict(c.split() for c in SCHEMA.split(", "))
        reader = reader.schema(", ".join(f"{c} {types[c]}" for c in columns))
    return reader.load(path)
