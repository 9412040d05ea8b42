"""WARC archives as a Python data source, and an archive writer that stores equal payloads once.

Reading: a partition is a file. The record type and header columns that a filter names are checked as soon as a record's headers are parsed; of a gzip member only the first bytes are inflated for that, and where the writer has left the member's length in its header (the skip-length field of the WARC annex) the rest of an unwanted record is passed over unread. Other members are inflated as a stream and hold any number of records: a file that is one member is read to its last record, a piece at a time. What isn't a record, or is cut off, is an error, never passed over. Writing: a task writes files of its own, of up to FILE_BYTES each; the driver commits by one list of the files that count, so files of lost attempts are never read.

Spark keeps the planned reader of a loaded DataFrame, pushed filters included, so each differently filtered scan loads the archives anew: call read_warc() for it.

Pages are shuffled by payload only if payloads occur twice at all; where the copies' table is small, of a counted size, not even then. One payload that very many pages share is left to the adaptive splitting of skewed joins.

Defined results: a null html is an empty payload; a null page_id is smaller than any other; of repeated rows (equal page_id and payload) all are responses if one is; a null url leaves out the target header, and control characters in a url are percent-encoded; an empty table gives an empty archive, and that no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage

from .common import Scratch

FILE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
MIN_BYTES = 0
HEAD = 4096
#: Payloads with copies, at 50 bytes each, that are broadcast.
MOST_BROADCAST = 100_000
SCHEMA = "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long, headers map<string,string>, payload binary"
_HEADER = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
_ARROW = pa.schema([(c, pa.string()) for c in _HEADER] + [("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
MANIFEST = "_files.json"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, record_id: str, uri: str | None, refers_to: str | None, payload: bytes) -> bytes:
    """A response or revisit record of an HTTP reply with this payload; the digest and length of a revisit are of the payload that it doesn't repeat."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in uri))
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response"]
    if kind != "revisit":
        block += payload
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member with its own length in the skip-length field."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    length = 24 + len(body) + 8
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, length, len(data) & 0xFFFFFFFF) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class FilePartition(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    files: list


def parse_head(head: bytes) -> tuple[dict, int] | None:
    """The headers and where the block starts; None: head is too short."""
    end = head.find(b"\r\n\r\n")
    if end < 0:
        return None
    if not head.startswith(b"WARC/"):
        raise ValueError("not a record")
    lines = head[:end].decode("utf-8", "replace").split("\r\n")
    headers = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if not field(headers, "Content-Length", "").isdigit():
        raise ValueError("a record without its length")
    return headers, end + 4


def field(headers: dict, name: str, default=None):
    """A header, whatever the case of its name."""
    got = headers.get(name)
    return got if got is not None else next((v for k, v in headers.items() if k.lower() == name.lower()), default)


class Pieces:
    """A stream's bytes, a part at a time. pull() gives the next piece, nothing at the end; jump(n), if there is one, passes n bytes over unread."""

    def __init__(self, pull, data: bytes = b"", jump=None):
        self.pull, self.data, self.jump = pull, data, jump

    def fill(self, n: int) -> bool:
        parts, have = [self.data], len(self.data)
        while have < n and (piece := self.pull()):
            parts.append(piece)
            have += len(piece)
        self.data = b"".join(parts)
        return have >= n

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise ValueError("a record is cut off")
        got, self.data = self.data[:n], self.data[n:]
        return got

    def skip(self, n: int) -> None:
        if self.jump and n > len(self.data):
            self.jump(n - len(self.data))
            self.data = b""
            return
        while n > 0:
            part = self.take(min(n, max(len(self.data), 1)))
            n -= len(part)


def records(pieces: Pieces, wanted):
    """(headers, block) of the wanted records one after the other."""
    while True:
        while pieces.fill(1) and pieces.data[:1] in b"\r\n":
            pieces.data = pieces.data.lstrip(b"\r\n")
        if not pieces.data:
            return
        n = HEAD
        while (parsed := parse_head(pieces.data)) is None:
            if not pieces.fill(n) and parse_head(pieces.data) is None:
                raise ValueError("a record without headers")
            n *= 4
        headers, at = parsed
        pieces.skip(at)
        n = int(field(headers, "Content-Length"))
        if wanted(headers):
            yield headers, pieces.take(n)
        else:
            pieces.skip(n)


def inflated(stream, data: bytes):
    """A function that gives the inflated pieces of gzip members one after the other, from data and then the stream."""
    opener = None

    def pull() -> bytes:
        nonlocal data, opener
        while True:
            if not data and not (data := stream.read(1 << 16)):
                if opener is not None:
                    raise ValueError("a member is cut off")
                return b""
            opener = opener or zlib.decompressobj(31)
            piece = opener.decompress(data, 1 << 20)
            data = opener.unconsumed_tail
            if opener.eof:
                data, opener = opener.unused_data, None
            if piece:
                return piece

    return pull


def own_length(raw: Pieces) -> tuple[int, int, int]:
    """Of the member that raw stands at: its length and that of its data, as its header names them (0: it doesn't), and where the data starts."""
    if raw.data[:3] != b"\x1f\x8b\x08":
        raise ValueError("not a gzip member")
    if raw.data[3] != 4 or not raw.fill(12):  # nothing but extra fields
        return 0, 0, 0
    end = 12 + struct.unpack_from("<H", raw.data, 10)[0]
    raw.fill(end)
    at = 12
    while at + 4 <= min(end, len(raw.data)):
        name, n = raw.data[at : at + 2], struct.unpack_from("<H", raw.data, at + 2)[0]
        if name == b"sl" and n == 8:
            return (*struct.unpack_from("<II", raw.data, at + 4), end)
        at += 4 + n
    return 0, 0, 0


def raw_pieces(stream) -> Pieces:
    def jump(n: int) -> None:
        if stream.tell() + n > stream.size():
            raise ValueError("a record is cut off")
        stream.seek(n, 1)

    return Pieces(lambda: stream.read(1 << 16), jump=jump)


def members(stream, wanted):
    """(headers, block) of the wanted records of a .warc.gz stream; wanted(headers) is asked before a block is inflated."""
    raw = raw_pieces(stream)
    while raw.fill(10):
        length, size, start = own_length(raw)
        if not length:
            break
        parsed, n = None, HEAD
        while parsed is None:
            raw.fill(min(length, start + n))
            head = zlib.decompressobj(-15).decompress(raw.data[start : min(length, start + n)], 16 * n)
            parsed = parse_head(head)
            if parsed is None and n >= length:
                raise ValueError("a record without headers")
            n *= 4
        headers, at = parsed
        if (at + int(field(headers, "Content-Length")) + 4) & 0xFFFFFFFF != size:  # more than one record
            break
        if wanted(headers):
            data = zlib.decompress(raw.take(length)[start:-8], -15)
            yield headers, Pieces(lambda: b"", data[at:]).take(int(field(headers, "Content-Length")))
        else:
            raw.skip(length)
    if raw.data:
        yield from records(Pieces(inflated(stream, raw.data)), wanted)


def plain_records(stream, wanted):
    """As members(), of an uncompressed .warc stream."""
    return records(raw_pieces(stream), wanted)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.batch = int(options.get("batch", "512"))
        self.equal: list[tuple[str, tuple]] = []
        self.prefix: list[tuple[str, str]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in _HEADER and isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.equal.append((name, (f.value,)))
            elif name in _HEADER and isinstance(f, In):
                self.equal.append((name, tuple(f.value)))
            elif name in _HEADER and isinstance(f, StringStartsWith):
                self.prefix.append((name, f.value))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        system, root = _open(self.path)
        found = {x.base_name: x for x in system.get_file_info(fs.FileSelector(root)) if x.is_file}
        names = [x for x in found if x.endswith((".warc", ".warc.gz"))]
        if MANIFEST in found:
            with system.open_input_stream(posixpath.join(root, MANIFEST)) as s:
                names = json.loads(s.read())
        return [FilePartition(posixpath.join(self.path.rstrip("/"), x)) for x in sorted(names)]

    @staticmethod
    def value(headers: dict, name: str):
        got = field(headers, _HEADER[name])
        if got is None:
            return None
        return got.removeprefix("sha1:") if name == "payload_digest" else got.strip("<>") if name in ("record_id", "refers_to") else got

    def wanted(self, headers: dict) -> bool:
        return all(self.value(headers, k) in v for k, v in self.equal) and all((self.value(headers, k) or "").startswith(v) for k, v in self.prefix)

    def row(self, headers: dict, block: bytes) -> tuple:
        got = [self.value(headers, k) for k in _HEADER]
        payload, size = block, len(block)
        if "application/http" in field(headers, "Content-Type", ""):
            http, _, payload = block.partition(b"\r\n\r\n")
            named = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
            size = int(named.get(b"content-length", len(payload)))
        if got[0] == "revisit":
            payload = None
        elif self.verify and (size != len(payload) or got[4] != digest(payload)):
            raise ValueError(f"{got[1]}: the payload isn't what its headers say")
        return (*got, size, list(headers.items()), payload if self.payload else None)

    def read(self, partition):
        if partition is None:  # a folder without archives
            return
        system, path = _open(partition.path)
        with system.open_input_file(path) as stream:
            rows = []
            for headers, block in (members if path.endswith(".gz") else plain_records)(stream, self.wanted):
                rows.append(self.row(headers, block))
                if len(rows) >= self.batch:
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)


class WarcWriter(DataSourceArrowWriter):
    """Rows of record_type, record_id, target_uri, refers_to, payload."""

    def __init__(self, options):
        self.path, self.most = options["path"], int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator):
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("record_type", "record_id", "target_uri", "refers_to", "payload")]
                for row in zip(*cols):
                    if out is None or size >= self.most:
                        if out:
                            out.close()
                        files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = system.open_output_stream(posixpath.join(root, files[-1]), compression=None), 0
                    data = member(record(*row[:4], row[4] or b""))
                    out.write(data)
                    size += len(data)
        finally:
            if out:
                out.close()
        return Written(files)

    def commit(self, messages):
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        at = posixpath.join(root, MANIFEST)
        known = []
        if system.get_file_info(at).is_file:
            with system.open_input_stream(at) as s:
                known = json.loads(s.read())
        with system.open_output_stream(at + ".new") as s:
            s.write(json.dumps(sorted({*known, *(f for m in messages if m for f in m.files)})).encode())
        system.move(at + ".new", at)

    def abort(self, messages):
        system, root = _open(self.path)
        for f in (f for m in messages if m for f in m.files):
            system.delete_file(posixpath.join(root, f))


class WarcSource(DataSource):
    """Format "warc". Options: payload (false: the payload column stays null), verify (true: lengths and digests are checked), file_bytes."""

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
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def archive_pages(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes a record per page; of equal payloads of min_bytes or more the one of the largest page_id is the response, the others revisit it."""
    spark = pages.sparkSession
    register(spark)
    scratch = Scratch(spark, "warc")
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("target_uri"), payload.alias("payload"), F.sha1(payload).alias("sha1"))
    # one small row for each payload that occurs twice or more
    first = rows.groupBy("sha1").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("sha1").alias("of"), "first")
    first = scratch.table(first, "first")
    first = F.broadcast(first) if first.count() <= MOST_BROADCAST else first.hint("merge")
    joined = rows.join(first, rows["sha1"] == first["of"], "left")
    revisit = F.col("of").isNotNull() & (F.length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    out = joined.select(F.when(revisit, "revisit").otherwise("response").alias("record_type"), name("page_id").alias("record_id"), "target_uri", F.when(revisit, name("first")).alias("refers_to"), "payload")
    out.write.format("warc").mode("append").save(path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the archived records; payloads are checked against their headers."""
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1)
    page = lambda c: F.when(number(c) != "", number(c).cast("long"))
    df = read_warc(spark, path, payload="false", verify="true").where(F.col("record_type").isin("response", "revisit"))
    return df.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
