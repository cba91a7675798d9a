"""WARC archives: writing pages, and a reader that salvages damaged files.

Archives are written and read by tasks, one file at a time, through the file
system that the folder's address names; records are gzip members of their own.
The reader checks each member and record (gzip checksum, version line, lengths,
closing line ends, block and payload digests). Where a check fails it looks for
the next place where a member or, in plain files, a version line begins a record
that can be read, goes on from there, and reports the bytes between as a gap.
A member that fails is unpacked up to the damage, and the records before it that a
digest confirms are kept. Memory is bounded by the largest record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm.shared import materialise, require_columns, require_text
from foldwise.operators.lookup import attach, fit_lookup

REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20
PIECE = 1 << 16
KEEP_BYTES = 4 << 20
CUT_SHORT = "member is cut short"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_GZIP = b"\x1f\x8b\x08"

ENTRY = ("file string, start bigint, end bigint, kind string, reason string, type string, record_id string, "
         "uri string, refers_to string, payload_bytes bigint, payload_digest string, payload binary")


def digest_text(hex_digest: str) -> str:
    """SHA-1 in the form archives use: base32 with its name."""
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def digest_hex(value: str | None) -> str | None:
    """Bare lower-case hex of a SHA-1 field in base32 or hex; None for anything else."""
    name, _, digits = (value or "").partition(":")
    if name.lower() != "sha1":
        return None
    try:
        raw = bytes.fromhex(digits) if len(digits) == 40 else base64.b32decode(digits.upper())
    except ValueError:
        return None
    return raw.hex() if len(raw) == 20 else None


def _line(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(
    record_id: str, uri: str | None, payload: bytes, digest: str, date: str, refers_to: str | None = None,
) -> bytes:
    """One record; with ``refers_to`` a revisit without payload, else a response."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (b"" if refers_to else payload)
    head = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{_line(record_id)}>"),
            ("WARC-Date", date)]
    if uri is not None:
        head.append(("WARC-Target-URI", _line(uri)))
    head.append(("WARC-Payload-Digest", digest_text(digest)))
    head.append(("WARC-Block-Digest", digest_text(hashlib.sha1(block).hexdigest())))
    if refers_to:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_line(refers_to)}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + _END


def _member(record: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def write_warc(
    df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
    min_bytes: int = REVISIT_BYTES, date: str = "2024-01-01T00:00:00Z", scheme: str = "urn:page:", packed: bool = True,
) -> DataFrame:
    """Write one record per row and return the files, as rows (file, records, bytes).

    The payload is the text in UTF-8, null as an empty one. Of rows with equal
    payloads of at least ``min_bytes`` bytes the one with the largest key is a
    response and the others are revisits that refer to it. Rows with a null key
    are responses that nothing refers to; rows that repeat the largest key are
    all responses. A null url gives a record without a target. Files are named
    anew by every attempt of a task; those returned belong to attempts that
    succeeded, so a lost executor leaves nothing that is read.
    """
    require_columns(df, [key])
    require_text(df, url, payload)
    body = F.coalesce(F.col(payload), F.lit(""))
    pages = df.select(F.col(key).cast("bigint").alias("id"), F.col(url).alias("url"), body.alias("body"))
    marked = pages.withColumns({"digest": F.sha1(F.col("body").cast("binary")), "size": F.octet_length("body")})
    copies = marked.filter((F.col("size") >= min_bytes) & F.col("id").isNotNull()).groupBy("digest").agg(
        F.max("id").alias("owner"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    later = F.when(F.col("id") < F.col("owner"), F.col("owner"))
    # bodies stay where they are while the owners are few; of many, the hot ones are still broadcast
    rows = attach(marked, fit_lookup(copies, ["digest"], ["owner"], rows="n")).select(
        "id", "url", "body", "digest", later.alias("owner"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, records, size = None, "", 0, 0

        def report() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records]), pa.array([size])],
                                              ["file", "records", "bytes"])

        for batch in batches:
            for i in range(batch.num_rows):
                page, target, text, digest, owner = (c[i].as_py() for c in batch.columns)
                if out is None:
                    part = TaskContext.get().partitionId()
                    name = f"{folder}/part-{part:05d}-{uuid.uuid4().hex}.warc{'.gz' if packed else ''}"
                    out, records, size = store.open_output_stream(f"{base}/{name.rpartition('/')[2]}", compression=None), 0, 0
                refers = None if owner is None else f"{scheme}{owner}"
                record = record_bytes(f"{scheme}{page}", target, text.encode(), digest, date, refers)
                data = _member(record) if packed else record
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= FILE_BYTES:
                    yield report()
                    out = None
        if out is not None:
            yield report()

    return materialise(rows.mapInArrow(run, "file string, records bigint, bytes bigint"))


class Damage(Exception):
    """A member or record that fails a check."""


@dataclass
class Record:
    type: str
    record_id: str | None
    uri: str | None
    refers_to: str | None
    payload: bytes | None
    payload_digest: str | None
    confirmed: bool = False  # by a digest in its header


def _headers(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name:
            raise Damage("header line without a name")
        out[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return out


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def parse_record(read: Callable[[int, int], bytes], at: int, limit: int) -> tuple[Record, int]:
    """The record at an offset and the offset after it; Damage if any check fails. Nothing lies beyond the limit."""
    head = read(at, PIECE)
    if not head.startswith((b"WARC/1.0\r\n", b"WARC/1.1\r\n")):
        raise Damage("no version line")
    while (close := head.find(_END)) < 0:
        more = read(at + len(head), PIECE)
        if not more or len(head) > 64 * PIECE:
            raise Damage("header without an end")
        head += more
    fields = _headers(head[head.index(b"\r\n") + 2: close])
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damage("no content length")
    start, length = at + close + 4, length.lstrip("0") or "0"
    # an impossible length is neither read nor, with many digits, converted
    if len(length) > 18 or start + int(length) + 4 > limit:
        raise Damage("record is cut short")
    size = int(length)
    block = read(start, size + 4)
    if len(block) < size + 4:
        raise Damage("record is cut short")
    if block[size:] != _END:
        raise Damage("record does not end after its length")
    block = block[:size]
    wanted = digest_hex(fields.get("warc-block-digest"))
    if wanted is not None and hashlib.sha1(block).hexdigest() != wanted:
        raise Damage("block digest differs")
    kind, payload = fields.get("warc-type", ""), block
    if fields.get("content-type", "").startswith("application/http"):
        cut = block.find(_END)
        if cut < 0:
            raise Damage("http header without an end")
        payload = block[cut + 4:]
    digest = digest_hex(fields.get("warc-payload-digest"))
    # the payload is the whole block or what follows a header that no digest covers
    confirmed = wanted is not None or (digest is not None and kind != "revisit" and payload is block)
    if kind == "revisit":
        payload = None
    else:
        own = hashlib.sha1(payload).hexdigest()
        if digest is not None and own != digest:
            raise Damage("payload digest differs")
        digest = own
    return Record(kind, _bare(fields.get("warc-record-id")), fields.get("warc-target-uri"),
                  _bare(fields.get("warc-refers-to")), payload, digest, confirmed), start + size + 4


def _unpack(read: Callable[[int, int], bytes], at: int, most: int | None = None) -> tuple[bytes, int]:
    """The content of the gzip member at an offset and the offset after it."""
    opened, parts, have, here = zlib.decompressobj(31), [], 0, at
    while not opened.eof:
        piece = read(here, PIECE)
        if not piece:
            raise Damage("member is cut short")
        here += len(piece)
        try:
            parts.append(opened.decompress(piece))
        except zlib.error as error:
            raise Damage(f"member cannot be unpacked: {error}") from None
        have += len(parts[-1])
        if most is not None and have >= most:
            break
    return b"".join(parts), here - len(opened.unused_data)


class _Member:
    """The content of the gzip member at an offset, read forward, up to its end or its damage."""

    def __init__(self, read: Callable[[int, int], bytes], at: int):
        self.file, self.begin = read, at
        self.size, self.end, self.damage = 0, at, None
        kept: list[bytes] | None = []
        for part in self._parts():
            self.size += len(part)
            if kept is not None:
                kept = kept + [part] if self.size <= KEEP_BYTES else None
        self.held, self.base = bytearray(b"".join(kept or ())), 0
        self.more = iter(()) if kept is not None else self._parts()

    def _parts(self) -> Iterator[bytes]:
        opened, here = zlib.decompressobj(31), self.begin
        while not opened.eof:
            piece = self.file(here, PIECE)
            if not piece:
                self.damage = CUT_SHORT
                return
            here += len(piece)
            while piece and not opened.eof:
                before = opened.copy()
                try:
                    part = opened.decompress(piece, PIECE)
                except zlib.error as error:
                    self.damage = f"member cannot be unpacked: {error}"
                    yield from self._bytewise(before, piece)
                    return
                piece = opened.unconsumed_tail
                yield part
        self.end = here - len(opened.unused_data)

    @staticmethod
    def _bytewise(opened, piece: bytes) -> Iterator[bytes]:
        """What can be unpacked before the byte that fails."""
        try:
            for i in range(len(piece)):
                yield opened.decompress(piece[i: i + 1])
        except zlib.error:
            return

    def read(self, at: int, n: int) -> bytes:
        if at < self.base:
            # a search went on from an earlier place
            self.held, self.base, self.more = bytearray(), 0, self._parts()
        while self.base + len(self.held) < at + n:
            part = next(self.more, None)
            if part is None:
                break
            self.held += part
            far = min(at - self.base, len(self.held)) - KEEP_BYTES
            if far > KEEP_BYTES:
                del self.held[:far]
                self.base += far
        return bytes(self.held[at - self.base: at - self.base + n])


def _search(read: Callable[[int, int], bytes], at: int, size: int, mark: bytes, good: Callable[[int], bool]) -> int:
    """The first place from ``at`` on where the mark stands and ``good`` holds, or the end."""
    while at < size:
        piece = read(at, PIECE + len(mark) - 1)
        found = piece.find(mark)
        while found >= 0:
            if good(at + found):
                return at + found
            found = piece.find(mark, found + 1)
        at += PIECE
    return size


def _plain(read: Callable[[int, int], bytes], size: int) -> Iterator[tuple[int, int, Record | str]]:
    def good(at: int) -> bool:
        try:
            parse_record(read, at, size)
        except Damage:
            return False
        return True

    at = 0
    while at < size:
        try:
            record, end = parse_record(read, at, size)
            yield at, end, record
        except Damage as damage:
            end = _search(read, at + 1, size, b"WARC/1.", good)
            yield at, end, str(damage)
        at = end


def _before_damage(member: _Member) -> Iterator[tuple[int, int, Record]]:
    """The records of a failing member before the first one that no digest confirms.

    Digests cover no headers. If every record is confirmed and the checksum still
    differs, some header is wrong, it cannot be told which, and none is given; in
    a member that is only cut short nothing is wrong before its end.
    """
    def bad(found: Record | str) -> bool:
        return isinstance(found, str) or not found.confirmed

    if member.damage != CUT_SHORT and not any(bad(found) for _, _, found in _plain(member.read, member.size)):
        return
    for entry in _plain(member.read, member.size):
        if bad(entry[2]):
            return
        yield entry


def _gzipped(read: Callable[[int, int], bytes], size: int) -> Iterator[tuple[int, int, Record | str]]:
    def good(at: int) -> bool:
        try:
            return _unpack(read, at, most=7)[0].startswith(b"WARC/1.")
        except Damage:
            return False

    at = 0
    while at < size:
        member = _Member(read, at)
        end = _search(read, at + 1, size, _GZIP, good) if member.damage else member.end
        inside = _plain(member.read, member.size)
        if member.damage:
            inside = _before_damage(member)
        for _, _, found in inside:
            yield at, end, found
        if member.damage:
            yield at, end, member.damage
        elif not member.size:
            yield at, end, "empty member"
        at = end


def entries(read: Callable[[int, int], bytes], size: int) -> Iterator[tuple[int, int, Record | str]]:
    """(start, end, record or reason of a gap) in file order; offsets are those in the file.

    Inside a gzip member that unpacks well but holds a damaged record, the gap
    has the offsets of the member. One that fails gives the confirmed records
    before its damage and, with the same offsets, one gap for the rest.
    """
    packed = read(0, 3) == _GZIP
    if not packed and size and not read(0, 5) == b"WARC/":
        # the begin is damaged: decide by what comes first
        gz, plain = (_search(read, 0, size, m, lambda _: True) for m in (_GZIP, b"WARC/1."))
        packed = gz < plain
    return _gzipped(read, size) if packed else _plain(read, size)


def read_warc(files: DataFrame, file: str = "file", payload: bool = True) -> DataFrame:
    """Rows of all archives in ``files``: records and gaps, in the columns of ``ENTRY``.

    A file is read by one task. Gaps have ``kind`` 'gap', the byte range and the
    reason; records have 'record'. Of a revisit, ``payload`` and
    ``payload_bytes`` are null; ``resolved`` adds the size. Empty files give no
    rows; null addresses are skipped; a repeated address is read again.
    """
    files = materialise(files.filter(F.col(file).isNotNull()).select(F.col(file).alias("file")))
    spread = files.repartition(max(1, min(files.count(), 20_000)))
    names = [f.split()[0] for f in ENTRY.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, path = fs.FileSystem.from_uri(name)
                with store.open_input_file(path) as opened:
                    size = opened.size()
                    rows, held = [], 0
                    for start, end, found in entries(lambda a, n: opened.read_at(n, a) if a < size else b"", size):
                        if isinstance(found, str):
                            rows.append((name, start, end, "gap", found, *[None] * 7))
                        else:
                            body = found.payload
                            rows.append((name, start, end, "record", None, found.type, found.record_id, found.uri,
                                         found.refers_to, None if body is None else len(body), found.payload_digest,
                                         body if payload else None))
                            held += len(body or b"") if payload else 100
                        if held >= 4 << 20 or len(rows) >= 10_000:
                            yield _batch(rows, names)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, names)

    return spread.mapInArrow(run, ENTRY)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"start": pa.int64(), "end": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows))], names)


def find_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses of the archives below a folder, without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.warc*").load(folder).select(F.col("path").alias("file"))


def gaps(found: DataFrame) -> DataFrame:
    """The quarantined byte ranges: (file, start, end, reason)."""
    return found.filter(F.col("kind") == "gap").select("file", "start", "end", "reason")


def resolved(found: DataFrame) -> DataFrame:
    """Records with the payload size of revisits filled from the response they refer to.

    Revisits are counted per response first, so a response that many refer to is
    joined once; a revisit whose response was lost keeps a null size.
    """
    records = materialise(found.filter(F.col("kind") == "record").drop("kind", "reason", "payload"))
    wanted = records.filter(F.col("type") == "revisit").groupBy(F.col("payload_digest").alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
    sizes = records.filter(F.col("type") == "response").groupBy(F.col("payload_digest").alias("__d")).agg(
        F.max("payload_bytes").alias("__size")).join(wanted, "__d")
    asked = records.withColumn("__asked", F.when(F.col("type") == "revisit", F.col("payload_digest")))
    joined = attach(asked, fit_lookup(sizes, ["__d"], ["__size"], rows="__n"), ["__asked"])
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "__size")).drop("__asked", "__size")
