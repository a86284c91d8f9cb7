"""WARC archives: a writer that stores equal payloads once, and a reader that salvages damaged files.

Writer: one gzip member per record, one archive per task. Of records with equal payloads (of at least
``min_bytes``) the one with the largest page_id is a ``response``, the others are ``revisit`` records that
name it; all shorter ones are responses. A record's id is ``<urn:page:N>``.

Reader: a record counts when its version line, header and length are whole, and its block digest (if it names one)
is right. Members are unpacked as streams: of a member of several records each good one counts, also before a damaged
end; after a bad one the unpacked bytes are searched for the next version line of a good record, and the gap names
its bytes within the member. A damaged member of one record, or without a good one, is one gap. Where a check fails elsewhere, the reader searches
on from the next byte for a gzip member that begins with a version line, or for a version line of an
uncompressed record, that passes all checks; it goes on from there and reports the bytes between
as a gap with the reason. What a good record holds is never searched, so a payload may hold WARC text.

Defined results: a null html is an empty payload; empty payloads are equal to each other, so all but one are
revisits when ``min_bytes`` is 0; a null url is the empty target; control characters and spaces in a url
are percent-encoded in the header; rows with the same page_id and payload are all responses, or all
revisits; a null page_id counts as the smallest and is ``<urn:page:>``; an empty table gives no archive.
An empty archive gives no rows, an archive without any valid record one gap.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from urllib.parse import quote

from lakeshelf.llm.common import scratch_path, shuffle_partitions, small_batches, stored
from lakeshelf.llm.shared_files import created, opened_at

VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")


def digest(data: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- writing


def _record(kind: str, page_id, url, html, refers_to, refers_url, size, sha1_hex, date: str) -> bytes:
    payload = b"" if html is None else html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    target = lambda u: quote(u or "", safe="!#$%&'()*+,/:;=?@[]~-._")
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", name(page_id)), ("WARC-Date", date), ("WARC-Target-URI", target(url)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()),
        ("WARC-Block-Digest", "sha1:" + digest(block)),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to)), ("WARC-Refers-To-Target-URI", target(refers_url))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    pack = zlib.compressobj(5, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def revisit_plan(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, refers_to, refers_url of the pages whose payload another page stores."""
    ids = pages.select(
        F.col("page_id").cast("long"), "url",
        F.sha2(F.coalesce("html", F.lit("")), 256).alias("payload"), F.octet_length(F.coalesce("html", F.lit(""))).alias("size"),
    )
    ids = stored(ids.where(F.col("size") >= min_bytes), "warc-payloads")  # digests, no html
    groups = ids.groupBy("payload", "size").agg(
        F.max(F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("order"), "page_id", "url")).alias("kept"),
        F.count(F.lit(1)).alias("copies"),
    ).where("copies > 1").select("payload", "size", F.col("kept.page_id").alias("refers_to"), F.col("kept.url").alias("refers_url"))
    return (
        ids.join(groups, ["payload", "size"]).where("NOT page_id <=> refers_to")
        .groupBy("page_id", "payload").agg(F.first("refers_to").alias("refers_to"), F.first("refers_url").alias("refers_url"))
    )


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, date: str | None = None) -> DataFrame:
    """Write page_id, url, html; one row per archive: path, records."""
    spark = pages.sparkSession
    small_batches(spark, 128)
    folder = folder or scratch_path(spark, "warc")
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    plan = revisit_plan(pages, min_bytes).withColumnsRenamed({"page_id": "_id", "payload": "_payload"})
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    body = F.coalesce("html", F.lit(""))
    is_revisit = F.col("refers_payload").isNotNull()
    joined = rows.join(
        plan.withColumn("refers_payload", F.col("_payload")),
        rows["page_id"].eqNullSafe(F.col("_id")) & (F.sha2(body, 256) == F.col("_payload")), "left",
    ).select(
        F.when(is_revisit, "revisit").otherwise("response").alias("kind"), "page_id", "url",
        F.when(~is_revisit, F.col("html")).alias("html"), "refers_to", "refers_url",
        F.octet_length(body).alias("size"), F.sha1(body.cast("binary")).alias("sha1"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, n = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        with created(path) as out:
            while first is not None:
                for row in zip(*(c.to_pylist() for c in first.columns)):
                    out.write(_member(_record(*row, date)))
                    n += 1
                first = next(batches, None)
        yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64())})

    return stored(joined.mapInArrow(write, "path string, records long"), "warc-archives")


# ---------------------------------------------------------------- reading


class _Bad(Exception):
    """A check that failed; the text is the reason."""


class _Archive:
    def __init__(self, file):
        self.file, self.size = file, file.size()

    def at(self, pos: int, n: int) -> bytes:
        return self.file.read_at(min(n, self.size - pos), pos) if pos < self.size else b""

    def member(self, pos: int, most: int | None = None) -> tuple[bytes, int]:
        """What the gzip member at ``pos`` holds (its first ``most`` bytes only, if given) and where it ends."""
        unpack, out, got, here = zlib.decompressobj(31), [], 0, pos
        while not unpack.eof:
            chunk = self.at(here, 1 << 16)
            if not chunk:
                raise _Bad("member ends early")
            here += len(chunk)
            try:
                data = unpack.decompress(chunk, 0 if most is None else max(1, most - got))
            except zlib.error as error:
                raise _Bad(f"member is damaged: {error}") from None
            out.append(data)
            got += len(data)
            if most is not None and got >= most:
                break
        return b"".join(out), here - len(unpack.unused_data)


def _parsed(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """Header, block and end of the record at ``at``."""
    line = _VERSION_LINE.match(data, at)
    if not line:
        raise _Bad("no version line")
    end = data.find(b"\r\n\r\n", line.end())
    if end < 0:
        raise _Bad("header ends early")
    header = {}
    for field in data[line.end() : end].decode("utf-8", "replace").split("\r\n"):
        key, colon, value = field.partition(":")
        if not colon:
            raise _Bad("header field without a colon")
        header[key.strip().lower()] = value.strip()
    length = header.get("content-length", "")
    if not re.fullmatch(r"\d{1,18}", length):
        raise _Bad("no length")
    begin, stop = end + 4, end + 4 + int(length)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise _Bad("block ends early or its length is wrong")
    block = data[begin:stop]
    want = header.get("warc-block-digest", "")
    if want.startswith("sha1:") and want[5:] != digest(block):
        raise _Bad("block fails its digest")
    return header, block, stop + 4


def _plain(archive: _Archive, pos: int) -> tuple[dict, bytes, int]:
    """The uncompressed record at ``pos``: its header is read first, then as much as its length says."""
    head = archive.at(pos, 1 << 13)
    while b"\r\n\r\n" not in head:
        more = archive.at(pos + len(head), 1 << 16)
        if not more or not _VERSION_LINE.match(head):
            raise _Bad("no version line" if not _VERSION_LINE.match(head) else "header ends early")
        head += more
    length = re.search(rb"(?im)^content-length:\s*(\d{1,18})\s*$", head[: head.index(b"\r\n\r\n")])
    if not length:
        raise _Bad("no length")
    total = head.index(b"\r\n\r\n") + 8 + int(length[1])
    if pos + total > archive.size:
        raise _Bad("block ends early")
    header, block, end = _parsed(archive.at(pos, total), 0)
    return header, block, pos + end


class _Stream:
    """What the gzip member at ``pos`` holds, a piece at a time."""

    def __init__(self, archive: _Archive, pos: int):
        self.archive, self.here, self.unpack = archive, pos, zlib.decompressobj(31)
        self.data, self.base = bytearray(), 0  # what is held, and where that is in the member
        self.tail, self.ended, self.bad = b"", False, None

    def more(self) -> None:
        piece = self.tail or self.archive.at(self.here, 1 << 16)
        if not piece:
            self.ended, self.bad = True, "member ends early"
            return
        if not self.tail:
            self.here += len(piece)
        before = self.unpack.copy()
        try:
            self.data += self.unpack.decompress(piece, 1 << 20)
        except zlib.error as error:
            self.ended, self.bad = True, f"member is damaged: {error}"
            try:  # what comes before the damaged byte
                for k in range(len(piece)):
                    self.data += before.decompress(piece[k : k + 1])
            except zlib.error:
                pass
            return
        self.tail, self.ended = self.unpack.unconsumed_tail, self.unpack.eof
        if self.ended:
            self.here -= len(self.unpack.unused_data)

    def record(self, at: int) -> tuple[dict, bytes, int]:
        """Header, block and end of the record at ``at`` of what is held; reads on as far as it needs."""
        while len(self.data) < at + 10 and not self.ended:
            self.more()
        if not _VERSION_LINE.match(self.data, at):
            raise _Bad("no version line")
        seen = at
        while (end := self.data.find(b"\r\n\r\n", seen)) < 0 and not self.ended:
            seen = max(at, len(self.data) - 3)
            self.more()
        length = re.search(rb"(?im)^content-length:\s*(\d{1,18})\s*$", self.data[at:end]) if end >= 0 else None
        stop = end + 8 + int(length[1]) if length else len(self.data)
        while len(self.data) < stop and not self.ended:
            self.more()
        header, block, size = _parsed(bytes(self.data[at:stop]), 0)
        return header, block, at + size

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.base += n

    def items(self) -> Iterator[tuple]:
        """("record", header, block) and ("gap", start, stop, reason) within the member."""
        while True:
            while not self.data and not self.ended:
                self.more()
            if not self.data:
                return
            began, at, reason = self.base, 0, ""
            while True:
                try:
                    header, block, end = self.record(at)
                    break
                except _Bad as bad:
                    reason = reason or str(bad)
                while not (found := _VERSION_LINE.search(self.data, at + 1)) and not self.ended:
                    self.drop(max(0, len(self.data) - 10))
                    at = -1
                    self.more()
                if not found:
                    yield "gap", began, self.base + len(self.data), self.bad or reason
                    self.drop(len(self.data))
                    return
                at = found.start()
            if reason:
                yield "gap", began, self.base + at, reason
            self.drop(end)
            if not self.data and not self.ended:
                self.more()
            yield "record", header, block


def _is_valid(archive: _Archive, pos: int) -> bool:
    """Whether the member at ``pos`` holds a good record, or an uncompressed one begins there."""
    if archive.at(pos, 2) == b"\x1f\x8b":
        return any(x[0] == "record" for x in _Stream(archive, pos).items())
    try:
        _plain(archive, pos)
        return True
    except _Bad:
        return False


def _end_of(archive: _Archive, pos: int) -> int:
    """Where the member at ``pos`` ends, or if it is damaged, where the next good one begins."""
    stream = _Stream(archive, pos)
    while not stream.ended:
        stream.more()
        stream.drop(len(stream.data))
    return _next_valid(archive, pos + 1) if stream.bad else stream.here


def _member_items(archive: _Archive, pos: int, stream: _Stream) -> Iterator[tuple]:
    end, gaps, any_record, last = None, [], False, 0
    for item in stream.items():
        if item[0] == "record" and stream.bad and not (any_record or gaps or stream.data):
            break  # a member of one record, and damaged
        if item[0] == "gap":
            gaps.append(item[1:])
            if not any_record:
                continue
        if end is None:
            end = stream.here if stream.ended and not stream.bad else _end_of(archive, pos)
        for a, b, reason in gaps:
            yield "gap", pos, end, f"{reason}; bytes {a} to {b} of the member", None
            last = b if reason == stream.bad else last
        gaps = []
        if item[0] == "record":
            any_record = True
            yield "record", pos, end, *item[1:]
    if not any_record:
        reason = stream.bad or (gaps[0][2] if gaps else "empty member")
        yield "gap", pos, _next_valid(archive, pos + 1), reason, None
    elif stream.bad and not last:
        yield "gap", pos, end, f"{stream.bad}; from byte {stream.base} of the member", None


# a version line need not begin a line here: the byte before it may be the damaged one, and all checks follow
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


def _next_valid(archive: _Archive, pos: int) -> int:
    """The first place from ``pos`` on where a valid member or record begins; the end if there is none."""
    while pos < archive.size:
        window = archive.at(pos, 1 << 20)
        for m in _START.finditer(window):
            place = pos + m.start()
            try:
                if m[0][:1] == b"\x1f" and not archive.member(place, 16)[0].startswith(b"WARC/1."):
                    continue
                if _is_valid(archive, place):
                    return place
            except _Bad:
                continue
        pos += len(window) if pos + len(window) >= archive.size else len(window) - 16
    return archive.size


def salvage(file) -> Iterator[tuple]:
    """("record", offset, end, header, block) and ("gap", start, end, reason, None), in order of bytes."""
    archive, pos = _Archive(file), 0
    while pos < archive.size:
        if archive.at(pos, 2) == b"\x1f\x8b":
            for item in _member_items(archive, pos, _Stream(archive, pos)):
                yield item
            pos = item[2]
            continue
        try:
            header, block, end = _plain(archive, pos)
        except _Bad as bad:
            end = _next_valid(archive, pos + 1)
            yield "gap", pos, end, str(bad), None
        else:
            yield "record", pos, end, header, block
        pos = end


_READ = pa.schema([
    ("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("gap_reason", pa.string()), ("record_type", pa.string()),
    ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to_id", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()),
])
READ_SCHEMA = (
    "path string, start long, stop long, gap_reason string, record_type string, record_id string, target_uri string, "
    "refers_to_id string, payload_bytes long, payload_digest string, payload binary"
)


def _row(path: str, item: tuple, with_payload: bool) -> tuple:
    kind, start, stop, header, block = item
    if kind == "gap":
        return (path, start, stop, header, *[None] * 7)
    http, blank, payload = block.partition(b"\r\n\r\n")
    if not header.get("content-type", "").startswith("application/http") or not blank:
        http, payload = b"", block
    record_type, size, named = header.get("warc-type"), len(payload), header.get("warc-payload-digest", "")
    if record_type == "revisit":  # the payload is elsewhere; its length is in the stored response header
        length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        size, hashed = int(length[1]) if length else None, named.removeprefix("sha1:") or None
    else:
        hashed = digest(payload)
    return (
        path, start, stop, None, record_type, header.get("warc-record-id"), header.get("warc-target-uri"),
        header.get("warc-refers-to"), size, hashed, payload if with_payload and record_type != "revisit" else None,
    )


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Read the archives named in ``path``: a row per record, and a row with ``gap_reason`` per quarantined gap."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows, held = [], 0
                with opened_at(path) as file:
                    for item in salvage(file):
                        rows.append(_row(path, item, with_payload))
                        held += len(rows[-1][-1] or b"") + 500
                        if held > 1 << 22:
                            yield _rows(rows)
                            rows, held = [], 0
                if rows:
                    yield _rows(rows)

    small_batches(archives.sparkSession, 128)
    spread = archives.select("path").repartition(max(1, shuffle_partitions(archives.sparkSession)), "path")
    return spread.mapInArrow(read, READ_SCHEMA)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _READ)], schema=_READ)


def records(read: DataFrame) -> DataFrame:
    return read.where("gap_reason IS NULL").drop("gap_reason")


def gaps(read: DataFrame) -> DataFrame:
    """The quarantine log: path, start, stop, gap_reason."""
    return read.where("gap_reason IS NOT NULL").select("path", "start", "stop", "gap_reason")


def page_of(record_id):
    """page_id of a record id that the writer made."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
