"""WARC archives: written by Spark, read back by a reader that salvages damaged files.

Writing. Every record is a gzip member of its own. Spark's text writer puts the
members one after another: it ends each value with a separator, and a member ends
with a zero byte (the top byte of its length) that the separator supplies. So files
come through Spark's commit protocol on any file system, and a lost task leaves none.

Reading. Spark's text reader cuts files into stretches at what may be the beginning of
a member (its three magic bytes) or, in archives without compression, of a record
(the version line). A file's stretches pass one task as a stream, in order. A record
is as many stretches as it says; each is checked (gzip checksum, lengths, digests).
After a failed check the search goes on at the next stretch, so later records are
recovered, and bytes that belong to no valid record are logged as gaps.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmaster.operators.joins import join_back
from kinmaster.session import materialise, scratch_path, spread

MIN_BYTES = 1000
ROWS_AT_ONCE = 200
# Formats of WARC 1.1, HTTP and gzip.
VERSION = b"WARC/1.1"
ANY_VERSION = b"WARC/1."
MEMBER = b"\x1f\x8b\x08"
LINE, END = b"\r\n", b"\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = zlib.compressobj(wbits=31).flush()
RECORD_COLUMNS = (
    "file string, offset bigint, length bigint, reason string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_bytes bigint, payload_digest string, headers map<string,string>, payload binary"
)


# --- writing ------------------------------------------------------------------------


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(url: str) -> str:
    """A url as a header value: what would end the line or a word is escaped."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def record_bytes(record_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One WARC record: a ``response``, or a ``revisit`` without the payload if it refers to another record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:record:{record_id}>")]
    headers += [("WARC-Date", date), ("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block))]
    if url is not None:
        headers.append(("WARC-Target-URI", _uri(url)))
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:record:{refers_to}>"), ("WARC-Profile", IDENTICAL)]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers)]
    return LINE.join(lines) + END + block + END


def member(record: bytes) -> bytes:
    """The record as a gzip member that ends with a zero byte.

    The last byte is zero below 16 MB; to longer ones an empty member is added.
    """
    packer = zlib.compressobj(level=6, wbits=31)
    data = packer.compress(record) + packer.flush()
    return data if data[-1] == 0 else data + EMPTY_MEMBER


def archive_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", min_bytes: int = MIN_BYTES
) -> DataFrame:
    """(record_id, url, payload, refers_to): what is to be written for each page.

    Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the
    largest id is stored; the others refer to it. Only digests are grouped, and the
    join back can be split, so one payload may be that of a third of all pages.
    """
    payload = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.when(F.length("payload") >= min_bytes, F.sha1("payload")))
    groups = (
        rows.where("digest IS NOT NULL").groupBy("digest")
        .agg(F.max("page").alias("stored"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    # Written first, so that Spark knows its size: few repeated payloads are broadcast and no page moves.
    joined = join_back(rows, materialise(groups, "repeated"), "digest", "digest", "left")
    other = F.col("stored").isNotNull() & ~F.col("page").eqNullSafe(F.col("stored"))
    return joined.select(
        F.coalesce(F.col("page").cast("string"), F.lit("")).alias("record_id"), "url", "payload",
        F.when(other, F.col("stored").cast("string")).alias("refers_to"),
    )


def write_warc(
    pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", min_bytes: int = MIN_BYTES,
    id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
) -> None:
    """Write a record for every row of ``pages`` into archives in the folder ``path``.

    A null payload is empty, a null url is left out, a null id is an empty one and the
    smallest of all. Rows that repeat the largest id of a payload are all responses, rows
    with another id revisit it. No pages make a folder without records. Other columns
    are not stored, whatever their names. Files are named by Spark and each is a
    sequence of gzip members, one a record.
    """
    import pyarrow as pa

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(first, ROWS_AT_ONCE)
                out = [
                    member(record_bytes(i, url, payload, refers, date))[:-1]
                    for i, url, payload, refers in zip(*(some.column(c).to_pylist() for c in range(4)), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    records = archive_records(spread(pages), id_col, url_col, text_col, min_bytes)
    packed = records.select("record_id", "url", "payload", "refers_to").mapInArrow(pack, "member binary")
    packed.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


# --- reading ------------------------------------------------------------------------


@dataclass
class Record:
    """A record that passed its checks."""

    headers: dict[str, str]
    block: bytes

    @property
    def type(self) -> str | None:
        return self.headers.get("warc-type")

    def name(self, header: str) -> str | None:
        value = self.headers.get(header)
        return value.strip("<>").removeprefix("urn:record:") if value is not None else None

    def http(self) -> tuple[dict[str, str], bytes] | None:
        """HTTP headers and payload of a block that is an HTTP message."""
        if not self.headers.get("content-type", "").startswith("application/http"):
            return None
        head, found, payload = self.block.partition(END)
        return (_headers(head.split(LINE)[1:]), payload) if found else None


class Broken(Exception):
    """A check that failed."""


def _headers(lines: Sequence[bytes]) -> dict[str, str]:
    """Header lines by lower-case name; a line that begins with white space continues the one before."""
    out: dict[str, str] = {}
    last = None
    for line in lines:
        text = line.decode("utf-8", "replace")
        if last is not None and text[:1] in (" ", "\t"):
            out[last] += " " + text.strip()
        else:
            name, colon, value = text.partition(":")
            if not colon:
                raise Broken("header line without a colon")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def _digest_fits(stated: str, data: bytes) -> bool:
    """Does a stated SHA-1, in base 32 or hex, fit? Other kinds are not checked."""
    kind, _, value = stated.partition(":")
    if kind.lower() != "sha1":
        return True
    digest = hashlib.sha1(data)
    return value.upper() == base64.b32encode(digest.digest()).decode() or value.lower() == digest.hexdigest()


def _checked(record: Record) -> Record:
    stated = record.headers.get("warc-block-digest")
    if stated and not _digest_fits(stated, record.block):
        raise Broken("block digest differs")
    http = record.http()
    stated = record.headers.get("warc-payload-digest")
    if stated and http and record.type != "revisit" and not _digest_fits(stated, http[1]):
        raise Broken("payload digest differs")
    return record


class PlainReader:
    """One record from bytes that begin with a version line."""

    def __init__(self, left: int):
        self.left, self.data, self.end = left, bytearray(), None
        self.head: dict[str, str] = {}
        self.body = 0

    def feed(self, data: bytes) -> tuple[list[Record], int] | None:
        """(records, bytes to spare) once the record is whole; None if more is needed."""
        seen = max(len(self.data) - 3, 0)
        self.data += data
        if not self.data.startswith(ANY_VERSION):
            raise Broken("no record begins here")
        if self.end is None:
            at = self.data.find(END, seen)
            if at < 0:
                return None
            self.head = _headers(bytes(self.data[:at]).split(LINE)[1:])
            size = self.head.get("content-length", "")
            if not (size.isascii() and size.isdigit()):
                raise Broken("no content length")
            self.body = at + len(END)
            self.end = self.body + int(size) + len(END)
            if self.end > self.left:
                raise Broken("longer than the file")
        if len(self.data) < self.end:
            return None
        if self.data[self.end - len(END):self.end] != END:
            raise Broken("length does not fit")
        record = Record(self.head, bytes(self.data[self.body:self.end - len(END)]))
        return [_checked(record)], len(self.data) - self.end


def plain_records(data: bytes) -> list[Record]:
    """All records of ``data``, which must be nothing else."""
    out: list[Record] = []
    while data:
        reader = PlainReader(len(data))
        found = reader.feed(data)
        if found is None:
            raise Broken("cut short")
        out += found[0]
        data = data[len(data) - found[1]:]
    return out


class MemberReader:
    """The records of one gzip member; its checksum and length are checked by the decoder."""

    def __init__(self, left: int):
        self.decoder = zlib.decompressobj(wbits=31)
        self.out: list[bytes] = []

    def feed(self, data: bytes) -> tuple[list[Record], int] | None:
        try:
            self.out.append(self.decoder.decompress(data))
        except zlib.error as error:
            raise Broken(f"not a gzip member: {error}") from error
        if not self.decoder.eof:
            return None
        return plain_records(b"".join(self.out)), len(self.decoder.unused_data)


@dataclass
class Found:
    """A record with its place, or a gap with the reason."""

    offset: int
    length: int
    record: Record | None = None
    reason: str | None = None


@dataclass
class _Gap:
    found: list[Found] = field(default_factory=list)

    def add(self, offset: int, length: int, reason: str) -> None:
        """Gaps that touch are one; its reason is the first."""
        if self.found and self.found[0].offset + self.found[0].length == offset:
            self.found[0].length += length
        else:
            self.found.append(Found(offset, length, reason=reason))

    def take(self) -> list[Found]:
        out, self.found = self.found, []
        return out


def salvage(stretches: Iterator[bytes], size: int, reader: Callable[[int], PlainReader | MemberReader]) -> Iterator[Found]:
    """Records and gaps of a file of ``size`` bytes, given in stretches.

    Every byte is in exactly one of the results (several records of one member share its place).
    """
    waiting: deque[tuple[int, bytes]] = deque()
    gap, read = _Gap(), 0
    while True:
        if not waiting:
            data = next(stretches, None)
            if data is None:
                break
            waiting.append((read, data))
            read += len(data)
            if not data:
                waiting.popleft()
                continue
        start = waiting[0][0]
        attempt, used, done = reader(size - start), 0, None
        try:
            while done is None:
                if used == len(waiting):
                    data = next(stretches, None)
                    if data is None:
                        raise Broken("cut short")
                    waiting.append((read, data))
                    read += len(data)
                done = attempt.feed(waiting[used][1])
                used += 1
        except Broken as broken:
            offset, data = waiting.popleft()
            if gap.found and gap.found[0].offset + gap.found[0].length != offset:
                yield from gap.take()
            gap.add(offset, len(data), str(broken))
            continue
        yield from gap.take()
        records, spare = done
        last_offset, last = waiting[used - 1]
        end = last_offset + len(last) - spare
        for record in records:
            yield Found(start, end - start, record)
        if spare:
            gap.add(end, spare, "no record begins here")
        for _ in range(used):
            waiting.popleft()
    if read < size:
        if gap.found and gap.found[0].offset + gap.found[0].length != read:
            yield from gap.take()
        gap.add(read, size - read, "cut short")
    yield from gap.take()


def _row(file: str, found: Found, with_payload: bool) -> dict:
    row = {"file": file, "offset": found.offset, "length": found.length, "reason": found.reason}
    record = found.record
    if record is None:
        return row
    http = record.http()
    stated = record.headers.get("warc-payload-digest", "")
    row |= {
        "record_type": record.type, "record_id": record.name("warc-record-id"), "target_uri": record.headers.get("warc-target-uri"),
        "refers_to": record.name("warc-refers-to"), "headers": list(record.headers.items()),
    }
    if record.type == "revisit":
        length = http[0].get("content-length", "") if http else ""
        row["payload_bytes"] = int(length) if length.isascii() and length.isdigit() else None
        row["payload_digest"] = _hex(stated)
    else:
        payload = http[1] if http else record.block
        row |= {"payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest()}
        row["payload"] = payload if with_payload else None
    return row


def _hex(stated: str) -> str | None:
    """A stated SHA-1 in lower-case hex."""
    kind, _, value = stated.partition(":")
    if kind.lower() != "sha1":
        return None
    if len(value) == 40:
        return value.lower()
    try:
        return base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


def _cut(data: bytes, marker: bytes) -> Iterator[bytes]:
    """``data`` in stretches that begin with the marker, apart from the first."""
    at = 0
    while True:
        following = data.find(marker, at + 1)
        if following < 0:
            yield data[at:]
            return
        yield data[at:following]
        at = following


def read_warc(spark: SparkSession, path: str, compressed: bool = True, with_payload: bool = True) -> DataFrame:
    """All records and gaps of the archives in ``path``, a row each.

    A row with a ``reason`` is a quarantined gap (file, offset, length); any other is a
    record with its type, names, headers, payload, and length and hex SHA-1 of the payload (of a
    revisit those it states; of a record that is not HTTP those of its block). ``compressed`` says whether
    the files are gzip members or plain records. A file is read by one task as a stream, which holds
    the record at hand; only files whose name ends in ``.gz`` are held whole, as Spark's
    text reader would unpack those itself. Empty files and folders have no rows.
    """
    import pyarrow as pa

    marker, reader = (MEMBER, MemberReader) if compressed else (ANY_VERSION, PlainReader)
    names = [c.split()[0] for c in RECORD_COLUMNS.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(),
             pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def batches_of(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        some: list[dict] = []
        for row in rows:
            some.append(row)
            if len(some) == ROWS_AT_ONCE:
                yield _batch(some)
                some = []
        if some:
            yield _batch(some)

    def _batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types, strict=True)], names)

    def read_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((f.as_py(), s.as_py(), v.as_py()) for b in batches for f, s, v in zip(*b.columns, strict=True))
        ahead = next(rows, None)

        def of_file(file: str) -> Iterator[bytes]:
            nonlocal ahead
            first = True
            while ahead is not None and ahead[0] == file:
                data = ahead[2] if first else marker + ahead[2]
                first, ahead = False, next(rows, None)
                yield data

        def found() -> Iterator[dict]:
            while ahead is not None:
                file, size = ahead[0], ahead[1]
                for f in salvage(of_file(file), size, reader):
                    yield _row(file, f, with_payload)

        yield from batches_of(found())

    def read_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for batch in batches:
                for file, data in zip(*batch.columns, strict=True):
                    content = data.as_py()
                    for f in salvage(_cut(content, marker), len(content), reader):
                        yield _row(file.as_py(), f, with_payload)

        yield from batches_of(found())

    text = spark.read.option("lineSep", marker.decode("latin-1")).option("encoding", "ISO-8859-1").option("pathGlobFilter", "*[!z]")
    cut = text.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("data"),
    )
    # A split holds its stretches in order, and splits are ordered by where they begin.
    ordered = cut.repartition("file").sortWithinPartitions("file", "block", "at").select("file", "size", "data")
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return ordered.mapInArrow(read_stretches, RECORD_COLUMNS).unionByName(whole.mapInArrow(read_whole, RECORD_COLUMNS))


def records(read: DataFrame) -> DataFrame:
    """The records among the rows of ``read_warc``."""
    return read.where("reason IS NULL").drop("reason")


def gaps(read: DataFrame) -> DataFrame:
    """(file, offset, length, reason) of the quarantined bytes."""
    return read.where("reason IS NOT NULL").select("file", "offset", "length", "reason")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What archives of all pages hold, read back from them."""
    path = scratch_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    read = materialise(read_warc(spark, path, with_payload=False).drop("payload", "headers"), "warc_index")
    return records(read).select(
        F.col("record_id").try_cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").try_cast("bigint").alias("refers_to"),
    )


OP11_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), s AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS stored FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN stored IS NULL OR page_id IS NOT DISTINCT FROM stored THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN stored IS NOT NULL AND page_id IS DISTINCT FROM stored THEN stored END AS refers_to
FROM s
"""
