"""WARC archives: a writer, and a reader that salvages what follows damage."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.shared import Batches, landed, shared_path

#: Bytes after which a writer begins a new archive, of a read, and that a plain record's header is looked for in at first.
ARCHIVE_BYTES, READ_BYTES, HEADER_BYTES = 64 << 20, 1 << 20, 1 << 16
GZIP = b"\x1f\x8b\x08"
VERSION = re.compile(rb"(?:^|(?<=\n))WARC/\d\.\d\r?\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
OUT = ("path string, offset bigint, length bigint, error string, type string, record_id string, uri string, date string, "
       "refers_to string, payload_digest string, payload_bytes bigint, payload binary")
FIELDS = [f.split()[0] for f in OUT.split(", ")]


def record(kind: str, record_id: str, uri: str, date: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One record. A revisit keeps the HTTP headers, which tell the payload's length, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block_digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
             f"WARC-Target-URI: {re.sub('[' + chr(0) + '-' + chr(32) + ']', '%20', uri)}", "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{block_digest}", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict, int] | str:
    """The record at the start of the data and where it ends, or what is wrong with it. Digests are checked."""
    version = VERSION.match(data)
    if not version:
        return "no version line"
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return "no end of header"
    head = {}
    for line in data[version.end():end].decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        head[name.strip().lower()] = value.strip()
    size = head.get("content-length", "")
    if not size.isdigit():
        return "no content length"
    at = end + 4
    block = data[at:at + int(size)]
    if len(block) < int(size) or data[at + int(size):at + int(size) + 4] != b"\r\n\r\n":
        return "wrong content length"
    if "warc-block-digest" in head and head["warc-block-digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
        return "wrong block digest"
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
    try:
        digest = base64.b32decode(digest).hex()
    except ValueError:
        return "unreadable payload digest"
    if head.get("warc-type") != "revisit" and digest and hashlib.sha1(payload).hexdigest() != digest:
        return "wrong payload digest"
    strip = lambda s: s[1:-1] if s and s[:1] == "<" else s
    return {"type": head.get("warc-type"), "record_id": strip(head.get("warc-record-id")), "uri": head.get("warc-target-uri"),
            "date": head.get("warc-date"), "refers_to": strip(head.get("warc-refers-to")), "payload_digest": digest or None,
            "payload_bytes": int(stated[1]) if stated else len(payload), "payload": payload}, at + int(size) + 4


class Buffered:
    """A window on a stream: bytes from ``start`` on, read as they are asked for, dropped when passed."""

    def __init__(self, stream):
        self.stream, self.start, self.data, self.ended = stream, 0, b"", False

    def more(self) -> bool:
        got = self.stream.read(READ_BYTES)
        self.ended = not got
        self.data += got
        return bool(got)

    def upto(self, n: int) -> bytes:
        while len(self.data) < n and not self.ended:
            self.more()
        return self.data

    def skip(self, n: int) -> None:
        self.data, self.start = self.data[n:], self.start + n


def member(source: Buffered, longest: int) -> tuple[bytes, int] | str:
    """The unpacked gzip member at the window's start and its packed length, or what is wrong with it."""
    unpack, parts, at, size = zlib.decompressobj(31), [], 0, 0
    while not unpack.eof:
        if at >= len(source.data) and not source.more():
            return "cut member"
        try:
            part = unpack.decompress(source.data[at:at + READ_BYTES], longest - size + 1)
        except zlib.error as e:
            return f"broken member: {e}"
        used = len(source.data[at:at + READ_BYTES]) - len(unpack.unconsumed_tail) - len(unpack.unused_data)
        at += used
        size += len(part)
        parts.append(part)
        if size > longest:
            return "member too long"
    return b"".join(parts), at


def salvage(stream, path: str = "", longest: int = 1 << 30) -> Iterator[dict]:
    """Records of an archive, packed by member or plain, and a row with ``error`` for each gap of bytes that hold none.

    After a failed check the search goes on from the next byte for a member or version line
    whose record passes its own checks; the bytes between are one gap. ``longest`` bounds a
    record, so that damage can't fill the memory.
    """
    source = Buffered(stream)
    gap, why = None, None

    def lost(end: int) -> dict:
        return dict.fromkeys(FIELDS) | {"path": path, "offset": gap, "length": end - gap, "error": why}

    while source.upto(HEADER_BYTES):
        packed = source.data.startswith(GZIP)
        if packed:
            got = member(source, longest)
            if not isinstance(got, str):
                data, used = got
                got = parse(data)
                if not isinstance(got, str):
                    got = (got[0], used) if got[1] == len(data) else "bytes after the record"
        else:
            if VERSION.match(source.data):
                seen = 0
                while (end := source.data.find(b"\r\n\r\n", max(0, seen - 3), longest)) < 0 and len(source.data) < longest and not source.ended:
                    seen = len(source.data)
                    source.upto(2 * seen)
                size = re.search(rb"(?i)\ncontent-length:\s*(\d{1,12})\r\n", source.data[:end + 4])
                if end >= 0 and size and int(size[1]) <= longest:
                    source.upto(end + 4 + int(size[1]) + 4)
            got = parse(source.data)
        if not isinstance(got, str):
            if gap is not None:
                yield lost(source.start)
                gap = None
            row, used = got
            yield {"path": path, "offset": source.start, "length": used, "error": None} | row
            source.skip(used)
            continue
        if gap is None:
            gap, why = source.start, got
        # the next byte that can begin a record
        while True:
            found = [i for i in (source.data.find(GZIP, 1), source.data.find(b"WARC/", 1)) if i > 0]
            if found:
                source.skip(min(found))
                break
            keep = min(len(source.data), 4)
            source.skip(len(source.data) - keep if not source.ended else len(source.data))
            if source.ended or not source.more():
                source.skip(len(source.data))
                break
    if gap is not None:
        yield lost(source.start)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """``(type, record_id, uri, date, refers_to, payload binary)`` to archives in the folder; returns ``(path, records, bytes)``.

    Each task writes files of its own names, so an attempt that is lost or runs twice leaves a
    file that the result does not name.
    """
    def run(batches: Batches) -> Batches:
        fs, base = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, done = None, ([], [], [])
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, records = fs.open_output_stream(f"{base}/{name}", compression=None), 0
                pack = zlib.compressobj(5, zlib.DEFLATED, 31)
                out.write(pack.compress(record(row["type"], row["record_id"], row["uri"] or "", row["date"], row["payload"] or b"", row["refers_to"])) + pack.flush())
                records += 1
                if out.tell() >= ARCHIVE_BYTES:
                    done[0].append(f"{folder}/{name}"), done[1].append(records), done[2].append(out.tell())
                    out = out.close()
        if out is not None:
            done[0].append(f"{folder}/{name}"), done[1].append(records), done[2].append(out.tell())
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.string()), pa.array(done[1], pa.int64()), pa.array(done[2], pa.int64())], ["path", "records", "bytes"])

    columns = pages.select("type", "record_id", "uri", "date", "refers_to", "payload")
    return landed(columns.mapInArrow(run, "path string, records bigint, bytes bigint"), "archives")


def read_archives(paths: DataFrame, longest: int = 1 << 30) -> DataFrame:
    """``(path)`` rows to records and gaps (rows with ``error``), each archive read as a stream."""
    def run(batches: Batches) -> Batches:
        kinds = {"offset": pa.int64(), "length": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(f, kinds.get(f, pa.string())) for f in FIELDS])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = pa.fs.FileSystem.from_uri(path)
                with fs.open_input_stream(name, compression=None) as stream:
                    rows, size = [], 0
                    for row in salvage(stream, path, longest):
                        rows.append(row)
                        size += len(row["payload"] or b"")
                        if size > READ_BYTES or len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    return paths.select("path").mapInArrow(run, OUT)


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 least_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages as records. Of equal payloads of at least ``least_bytes`` the largest id is the response, others revisit it.

    Null html is an empty payload, a null url an empty one. Rows that repeat an id repeat its
    record: where it is the response, each is one. Rows without an id are responses.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.when((F.length("payload") >= least_bytes) & F.col("id").isNotNull(), F.sha1("payload")))
    first = (rows.where("digest is not null").groupBy("digest").agg(F.max("id").alias("first"), F.min("id").alias("least"))
             .where("first <> least").select("digest", "first"))
    # rows without a digest match nothing; a key of their own each keeps them from meeting in one task
    spread = F.coalesce("digest", F.concat(F.lit("-"), F.xxhash64("id", "uri", "payload").cast("string")))
    joined = rows.withColumn("digest", spread).join(first, "digest", "left")
    revisit = F.col("first") != F.col("id")
    name = lambda c: F.concat(F.lit("urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")))
    return joined.select(F.when(revisit, "revisit").otherwise("response").alias("type"), name(F.col("id")).alias("record_id"), "uri",
                         F.lit(date).alias("date"), F.when(revisit, name(F.col("first"))).alias("refers_to"), "payload")


def archive_round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Pages written to archives in the shared folder and read back: the reader's rows."""
    spark = pages.sparkSession
    written = write_archives(page_records(pages, **columns), shared_path(spark, "warc"))
    # one archive a task: the largest are bounded by the writer
    return read_archives(written.repartition(max(1, written.count()), "path"))


def page_of(record_id) -> F.Column:
    return F.nullif(F.regexp_extract(record_id, "^urn:x-page:(-?[0-9]+)$", 1), F.lit("")).cast("long")
