"""WARC archives: a writer of compressed records and a salvage reader that recovers what damage leaves."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stackweave.llm.batches import text_slices
from stackweave.session import Scratch, hadoop_path
from stackweave.sources.stacks import tasks_for

VERSION = b"WARC/1.1"
#: An archive is closed after so many bytes; one task reads one archive, as a stream.
ARCHIVE_BYTES, CHUNK = 64 << 20, 1 << 16
#: Shares into which the pages of one payload are dealt.
SALTS = 64
MEMBER = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record with its two closing line ends; a revisit has the head of the answer only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    # A line end inside an address would end the header.
    address = re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m.group()):02X}", url or "")
    lines = [
        VERSION.decode(), f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_name(page_id)}",
        "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {address}", "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{payload_digest(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def owners(pages: DataFrame, least: int = 0, salts: int = SALTS) -> DataFrame:
    """``pages(page_id, url, html)`` with ``revisit`` and ``owner``, the page that keeps its payload.

    Of equal payloads of ``least`` bytes or more, the one with the largest page_id is the owner.
    Payloads are equal if SHA-256, SHA-1 and length are. Groups are formed by salted shares first, and
    pages find their owner by (payload, share), so copies of one page are spread over many tasks. A null
    html is empty; a null page_id owns a payload only among nulls; rows that repeat the owner's id are
    responses too.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    rows = rows.withColumn("same", F.concat_ws(":", F.sha2("html", 256), F.sha1("html"), F.octet_length("html")))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)))
    shares = rows.groupBy("same", "salt").agg(F.max("page_id").alias("top"))
    tops = shares.groupBy("same").agg(F.max("top").alias("owner"))
    places = shares.join(tops, "same").select("same", "salt", "owner")
    revisit = (F.octet_length("html") >= least) & F.coalesce(F.col("page_id") < F.col("owner"), F.col("page_id").isNull() & F.col("owner").isNotNull())
    return rows.join(places, ["same", "salt"]).select("page_id", "url", "html", "owner", revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row of ``pages(page_id, url, html, owner, revisit)`` under ``folder``.

    Returns the archives ``(path, bytes)``; it must be stored, which runs the job. Names are new for every
    task attempt and listed only if the attempt succeeds, so a lost executor leaves no half archive in the list.
    ``folder`` is a URI that pyarrow's file systems open on every node (file, hdfs, s3, gs).
    """
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_uri(folder)
        files.create_dir(root, recursive=True)
        out, name, size, done = None, "", 0, []
        for batch in batches:
            for row in (r for part in text_slices(batch, "html") for r in part.to_pylist()):
                payload = row["html"].encode()
                data = member(record(row["page_id"], row["url"], payload, payload_digest(payload), row["owner"], row["revisit"]))
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)  # members are packed already
                out.write(data)
                size += len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((name, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size))
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n, _ in done], pa.string()), pa.array([s for _, s in done], pa.int64())], schema=schema)

    return pages.mapInArrow(run, "path string, bytes long")


class Window:
    """A moving view of a stream: bytes from ``start`` on, read further when asked for."""

    def __init__(self, stream, start: int):
        self.stream, self.start, self.data, self.ended = stream, start, bytearray(), False
        self.size = stream.seek(0, 2)
        stream.seek(start)

    def more(self) -> bool:
        got = b"" if self.ended else self.stream.read(CHUNK)
        self.ended = self.ended or not got
        self.data += got
        return bool(got)

    def need(self, n: int) -> bool:
        while len(self.data) < n and self.more():
            pass
        return len(self.data) >= n

    def peek(self, at: int, n: int) -> bytes:
        """``n`` bytes from ``at`` on, counted from the window's start, without reading up to there."""
        if at + n <= len(self.data):
            return bytes(self.data[at : at + n])
        self.stream.seek(self.start + at)
        found = self.stream.read(n)
        self.stream.seek(self.start + len(self.data))
        return found

    def drop(self, n: int) -> None:
        self.start += n
        del self.data[:n]


def header(lines: bytes) -> tuple[dict[str, str] | None, int, str]:
    """Fields of a header block and the length of the block that follows, or why it failed."""
    version, *rest = bytes(lines).split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.\d", version):
        return None, 0, "broken version line"
    fields = {}
    for line in rest:
        name, colon, value = line.partition(b":")
        if not colon:
            return None, 0, "broken header line"
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"[0-9]+", fields.get("content-length", "")):
        return None, 0, "no length"
    return fields, int(fields["content-length"]), ""


def checked(fields: dict[str, str], block: bytes) -> tuple[dict[str, object] | None, str]:
    """A record of its header's fields and its block; both digests must be right."""
    expected = fields.get("warc-block-digest", "")
    if expected.startswith("sha1:") and expected[5:] != payload_digest(block):
        return None, "block digest differs"
    head, split, payload = block.partition(b"\r\n\r\n")
    kind = fields.get("warc-type", "")
    if not split or not head.startswith(b"HTTP/"):
        payload = block
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and digest and digest != payload_digest(payload):
        return None, "payload digest differs"
    told = re.search(rb"(?i)\ncontent-length:\s*(\d+)", head)
    length = len(payload) if kind != "revisit" else int(told.group(1)) if told else None
    return {
        "record_id": fields.get("warc-record-id"), "record_type": kind, "url": fields.get("warc-target-uri"),
        "payload_digest": digest or (payload_digest(payload) if kind == "response" else None), "payload_bytes": length,
        "refers_to": fields.get("warc-refers-to"), "payload": payload if kind != "revisit" else None,
    }, ""


def plain(window: Window) -> tuple[dict[str, object] | None, int, str]:
    """The record at the window's start, the bytes it takes, and why it failed.

    All checks are made: version, length, closing line ends, both digests. A header may be of any length; each new
    part of the stream is searched for its end once. A length that does not lead to closing line ends, or
    beyond the archive, is found out by looking there, so no more than one whole record is ever held.
    """
    window.need(10)
    if not re.match(rb"WARC/1\.\d\r\n", window.data[:10]):
        return None, 0, "broken version line"
    seen = 0
    while (end := window.data.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
        seen = len(window.data)
        if not window.more():
            return None, 0, "header without end"
    fields, size, why = header(window.data[:end])
    if fields is None:
        return None, 0, why
    total = end + 8 + size
    if window.start + total > window.size:
        return None, 0, "record cut off"
    if window.peek(total - 4, 4) != b"\r\n\r\n":
        return None, 0, "record without closing lines"
    window.need(total)
    made, why = checked(fields, bytes(window.data[end + 4 : total - 4]))
    return made, total, why


def unpack(window: Window) -> tuple[bytes | None, int, str]:
    """The whole gzip member at the window's start: content, compressed bytes, and why it failed."""
    inflate, at, parts = zlib.decompressobj(31), 0, []
    while True:
        if at >= len(window.data) and not window.more():
            return None, 0, "member cut off"
        try:
            parts.append(inflate.decompress(window.data[at : at + CHUNK]))
        except zlib.error as error:
            return None, 0, f"member damaged: {error}"
        at = min(len(window.data), at + CHUNK)
        if inflate.eof:
            return b"".join(parts), at - len(inflate.unused_data), ""


def at_start(window: Window) -> tuple[dict[str, object] | None, int, str]:
    """The valid record at the window's start, packed or plain, the bytes it takes, or the reason of failure."""
    window.need(8)
    if window.data.startswith(MEMBER):
        content, size, why = unpack(window)
        if content is None:
            return None, 0, why
        inner = Window(io.BytesIO(content), 0)
        made, used, why = plain(inner) if content.startswith(b"WARC/1.") else (None, 0, "no version line")
        if made is None or used != len(content):
            return None, 0, why or "member without one whole record"
        return made, size, ""
    if not window.data.startswith(b"WARC/1."):
        return None, 0, "no member and no version line"
    return plain(window)


def salvage(stream) -> Iterator[tuple[str, int, int, object]]:
    """Records of a stream as ("record", offset, bytes, fields), and gaps as ("gap", offset, bytes, reason).

    Where a record fails its checks, the next place is sought where a member or a version line begins *and*
    the record there passes all checks. What lies between is one gap, with the first reason found.
    """
    window = Window(stream, 0)
    lost, reason = 0, ""
    while window.need(1):
        made, used, why = at_start(window)
        if made is not None:
            if window.start > lost:
                yield "gap", lost, window.start - lost, reason
            yield "record", window.start, used, made
            window.drop(used)
            lost, reason = window.start, ""
            continue
        reason = reason or why
        while True:
            places = [p for p in (window.data.find(MEMBER, 1), window.data.find(b"WARC/1.", 1)) if p > 0]
            if places:
                window.drop(min(places))
                break
            window.drop(max(0, len(window.data) - 6))  # a sign may be cut at the end
            if not window.more():
                window.drop(len(window.data))
                break
    if window.start > lost:
        yield "gap", lost, window.start - lost, reason


def open_uri(uri: str):
    """The file system of a URI as Spark writes it, and the path there."""
    return pafs.FileSystem.from_uri(f"file://{uri[5:]}" if uri.startswith("file:/") and not uri.startswith("file://") else uri)


RECORD = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("bytes", T.LongType()),
    T.StructField("reason", T.StringType()), T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("refers_to", T.StringType()), T.StructField("payload", T.BinaryType()),
])


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps of ``archives(path, bytes)``, packed per record or plain: one row each.

    ``kind`` is ``record`` or ``gap``; a gap is the quarantined bytes from ``offset`` on with their reason. A task
    reads its archives as streams and holds one record at a time, whatever lengths damaged headers claim. ``payloads=False`` leaves payloads out after
    the checks. An empty list gives no rows.
    """
    schema = to_arrow_schema(RECORD)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                files, path = open_uri(uri)
                held, size = [], 0
                with files.open_input_file(path) as stream:
                    for kind, offset, used, what in salvage(stream):
                        made = {"kind": kind, "path": uri, "offset": offset, "bytes": used}
                        made |= {"reason": what} if kind == "gap" else what
                        if not payloads:
                            made["payload"] = None
                        size += len(made.get("payload") or b"")
                        held.append(made)
                        if size > CHUNK * 64 or len(held) >= 2000:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    # Paths are short and archives are not: a given number of partitions is not folded into one.
    return archives.repartition(tasks_for(archives.count()), "path").mapInArrow(run, RECORD)


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, bytes)`` of the archives in a folder; only names and lengths are read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
    return found.select("path", F.col("length").alias("bytes"))


def round_trip(pages: DataFrame, scratch: Scratch, least: int = 0) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)``, read the archives back: a row per record.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to``, all as read. A null html is an empty
    payload, a null page_id stays null; rows that repeat the page_id that owns a payload are responses like it. Addresses
    and payloads may be of any length. An empty table gives no rows; other columns are ignored.
    """
    files, handle = hadoop_path(scratch.spark, f"{scratch.root}/archives")
    folder = files.makeQualified(handle).toString()
    archives = scratch.write(write_archives(owners(pages, least), folder))
    found = read_archives(archives, payloads=False).where("kind = 'record'")
    number = lambda name: F.regexp_extract(F.col(name), r"^<urn:page:(-?\d+)>$", 1)
    ids = {name: F.when(number(name) != "", number(name)).cast("long") for name in ("record_id", "refers_to")}
    return found.select(ids["record_id"].alias("page_id"), "payload_bytes", "payload_digest", "record_type", ids["refers_to"].alias("refers_to"))
