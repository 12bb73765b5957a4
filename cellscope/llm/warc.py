"""WARC archives: a writer with revisit records and a salvage reader.

`write` gives every page one record in gzip members of their own (or plain records). Of pages
with equal payloads the one with the largest page_id is a `response`, the others are `revisit`
records that refer to it and carry no payload. Each task writes its own files under fresh names
and reports them; only files in the manifest, which Spark commits, belong to the archive, so files
of lost or repeated tasks are never read.

`read` checks every record: gzip checksum, version line, Content-Length, the blank lines behind
the block, block digest and, for responses, payload digest. After a failed check it searches for
the next gzip member or version line from which a whole record passes the checks, goes on there
and logs the bytes between as a gap. A gzip member may hold several records, and a header may have
any length. Files are read in parallel, as streams: memory holds one member or plain record.

Files are opened through Arrow's file systems (local and shared folders, HDFS, object stores).

Defined results: a null html is the empty payload; null urls are left out of the header; line
ends and control characters in urls are percent-encoded; a null page_id is written with an empty
page part and read back as null, and is the response only if all its payload's pages are null;
repeated rows with the largest page_id are all responses; an empty table gives an archive without
records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.llm.common import fresh_path, staged

VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
ROLL_BYTES = 256 << 20
CHUNK = 1 << 20
#: Bytes of a plain record's header that are read at first; longer ones are read on.
MAX_HEADER = 1 << 16
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
_URN = re.compile(rb"<urn:x-page:(-?\d*)>")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# writing ---------------------------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
           date: str = DATE) -> bytes:
    """One record. A revisit's block is the HTTP head alone; its Content-Length and the payload
    digest are those of the full payload."""
    name = lambda i: f"<urn:x-page:{'' if i is None else i}>"
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
             + (b"" if revisit else payload))
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(page_id)),
            ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to))]
    head += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in head), b"", block, b"", b""])


def member(data: bytes) -> bytes:
    """A gzip member of its own, without a time stamp."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def with_responses(pages: DataFrame) -> DataFrame:
    """`pages` (page_id, url, payload) with `refers_to` and `revisit`. Payloads shared by several
    pages are found by an aggregate over digests and joined back; the join can be split, so a
    payload that a third of all pages have isn't one task's work."""
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       body.alias("payload")).withColumn("sha", F.sha1("payload"))
    shared = staged(src.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
                    .where("n > 1").select(F.col("sha").alias("s"), "refers_to"), "shared-payloads")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return (src.join(shared, F.col("sha") == F.col("s"), "left")
            .select("page_id", "url", "payload", F.when(revisit, F.col("refers_to")).alias("refers_to"),
                    revisit.alias("revisit")))


def write(pages: DataFrame, path: str, compressed: bool = True, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write a record for every row of `pages` (page_id, url, html) to files under `path`; returns
    the manifest: file, records, bytes. The manifest is a table, not a plan: files are written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        out, name, records, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"file": [f"{path}/{name}"], "records": [records], "bytes": [size]})

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to", "revisit"))):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc" + ".gz" * compressed
                    out, records, size = fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                data = record(*row)
                data = member(data) if compressed else data
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= roll_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return staged(with_responses(pages).mapInArrow(run, "file string, records long, bytes long"), "manifest")


# reading ---------------------------------------------------------------------------------------

class _Bad(Exception):
    """A record that fails a check; `end` is known if its extent could still be told."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


class _Bytes:
    """Forward reading from any offset of a file, in chunks."""

    def __init__(self, f, size: int):
        self.f, self.size, self.at, self.buf = f, size, 0, b""

    def get(self, offset: int, n: int) -> bytes:
        """Up to n bytes at offset."""
        if not (self.at <= offset and offset + n <= self.at + len(self.buf)):
            self.f.seek(offset)
            self.at, self.buf = offset, self.f.read(min(max(n, CHUNK), max(0, self.size - offset)))
        return self.buf[offset - self.at:offset - self.at + n]

    def next_start(self, offset: int) -> int:
        """The next gzip member or version line at or behind offset, or the file's size."""
        while offset < self.size:
            chunk = self.get(offset, CHUNK)
            m = _START.search(chunk)
            if m:
                return offset + m.start()
            offset += max(1, len(chunk) - len(VERSION))
        return self.size


def _inflate(src: _Bytes, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at `at`, and where it ends. Checksum errors raise."""
    d, parts, pos = zlib.decompressobj(31), [], at
    while not d.eof:
        chunk = src.get(pos, 1 << 16)
        if not chunk:
            raise _Bad("member cut off")
        try:
            parts.append(d.decompress(chunk))
        except zlib.error as e:
            raise _Bad(f"member damaged: {e}") from None
        pos += len(chunk)
    return b"".join(parts), pos - len(d.unused_data)


def _parse(head: bytes) -> dict[str, bytes]:
    lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.\d", lines[0]):
        raise _Bad("no version line")
    fields = {}
    for line in lines[1:]:
        k, sep, v = line.partition(b":")
        if not sep:
            raise _Bad("header line without a name")
        fields[k.strip().lower().decode("latin-1")] = v.strip()
    if not re.fullmatch(rb"\d{1,15}", fields.get("content-length", b"")):
        raise _Bad("no Content-Length")
    return fields


def _sha1_matches(field: bytes | None, data: bytes) -> bool:
    return field is None or not field.startswith(b"sha1:") or field[5:].decode("latin-1") == digest(data)


def _page(field: bytes | None) -> int | None:
    m = _URN.fullmatch(field or b"")
    return int(m[1]) if m and m[1] not in (b"", b"-") else None


def _checked(fields: dict[str, bytes], block: bytes, end: int) -> dict:
    if not _sha1_matches(fields.get("warc-block-digest"), block):
        raise _Bad("block digest differs", end)
    kind = fields.get("warc-type", b"").decode("latin-1")
    http, sep, body = block.partition(b"\r\n\r\n")
    out = {"record_type": kind, "page_id": _page(fields.get("warc-record-id")),
           "refers_to": _page(fields.get("warc-refers-to")) if kind == "revisit" else None,
           "payload_bytes": len(block), "payload": block, "payload_digest": None}
    claimed = fields.get("warc-payload-digest", b"")
    if fields.get("content-type", b"").startswith(b"application/http") and sep:
        length = re.search(rb"(?i)^content-length:\s*(\d+)\s*$", http, re.M)
        out["payload"] = None if kind == "revisit" else body
        out["payload_bytes"] = int(length[1]) if kind == "revisit" and length else len(body)
    if kind == "revisit":
        out["payload_digest"] = claimed[5:].decode("latin-1") if claimed.startswith(b"sha1:") else None
    else:
        out["payload_digest"] = digest(out["payload"])
        if not _sha1_matches(claimed or None, out["payload"]):
            raise _Bad("payload digest differs", end)
    return out


def _of_member(data: bytes) -> tuple[list[dict], str]:
    """The records of a sound member's content that pass all checks, and why others don't."""
    found, why, at = [], "", 0
    while at < len(data):
        end = None
        try:
            if not data.startswith(b"WARC/", at):
                raise _Bad("no version line")
            body = data.find(b"\r\n\r\n", at) + 4
            if body < 4:
                raise _Bad("no end of header")
            fields = _parse(data[at:body - 4])
            stop = body + int(fields["content-length"])
            if data[stop:stop + 4] != b"\r\n\r\n" or not (stop + 4 == len(data) or data.startswith(b"WARC/1.", stop + 4)):
                raise _Bad("block is not Content-Length long")
            end = stop + 4      # whatever is wrong now, the record's extent is known
            found.append(_checked(fields, data[body:stop], end))
        except _Bad as e:
            why = why or str(e)
            end = end or data.find(b"WARC/1.", at + 1)
        at = end if end > 0 else len(data)
    return found, why or "empty member" * (not found)


def _head(src: _Bytes, at: int) -> bytes:
    """The header of the plain record at `at`, however long; what can't be one is told early."""
    size, seen = MAX_HEADER, 0
    while True:
        start = src.get(at, size)
        if not start.startswith(b"WARC/"):
            raise _Bad("neither member nor version line")
        head, sep, _ = start.partition(b"\r\n\r\n")
        if sep:
            return head
        whole = start.rfind(b"\r\n")
        if whole < 0 or len(start) < size:
            raise _Bad("no end of header")
        if whole >= seen:       # lines that were not there yet
            lines = start[seen:whole].split(b"\r\n")
            if not seen and not re.fullmatch(rb"WARC/1\.\d", lines.pop(0)):
                raise _Bad("no version line")
            if not all(b":" in x for x in lines):
                raise _Bad("header line without a name")
            seen = whole + 2
        size *= 2


def _next(src: _Bytes, at: int) -> tuple[list[dict], str, int]:
    """The records of the member or the plain record at `at`, after all checks, why others in the
    member fail, and where the next member or record starts."""
    if src.get(at, 3) == MAGIC:
        data, end = _inflate(src, at)
        found, why = _of_member(data)
        if not found:
            raise _Bad(why, end)
        return found, why, end
    head = _head(src, at)
    fields = _parse(head)
    n, body = int(fields["content-length"]), at + len(head) + 4
    if body + n + 4 > src.size:
        raise _Bad("record cut off")
    block = src.get(body, n)
    if src.get(body + n, 4) != b"\r\n\r\n":
        raise _Bad("block is not Content-Length long")
    # a plain record's length can't be trusted once its digest differs: search from its start
    return [_checked(fields, block, None)], "", body + n + 4


def salvage(f, size: int) -> Iterator[tuple[str, int, int, dict | str]]:
    """('record', start, end, fields) for every record that passes, and ('gap', start, end,
    reason) for the bytes between. Records of one member all have its start and end; a gap has
    them too if other records of the member fail."""
    src, at, gap, why = _Bytes(f, size), 0, None, ""
    while at < size:
        try:
            found, bad, end = _next(src, at)
        except _Bad as e:
            if gap is None:
                gap, why = at, str(e)
            # a whole but wrong member is passed over; else any member or version line may be next
            at = e.end if e.end is not None else src.next_start(at + 1)
            continue
        if gap is not None:
            yield "gap", gap, at, why
            gap = None
        for x in found:
            yield "record", at, end, x
        if bad:
            yield "gap", at, end, bad
        at = end
    if gap is not None:
        yield "gap", gap, size, why


SCHEMA = ("file string, status string, start long, `end` long, reason string, page_id long, payload_bytes long, "
          "payload_digest string, record_type string, refers_to long, payload binary")


def read_all(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records and gaps of the files that `manifest` names (column file), by `status`."""
    names = [x.split()[0].strip("`") for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string() if n in ("file", "status", "reason", "payload_digest", "record_type")
                             else pa.binary() if n == "payload" else pa.int64()) for n in names])
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                fs, name = pafs.FileSystem.from_uri(uri)
                held, size = [], 0
                with fs.open_input_file(name) as f:
                    for status, start, end, x in salvage(f, f.size()):
                        row = {"file": uri, "status": status, "start": start, "end": end}
                        row |= {"reason": x} if status == "gap" else \
                            {k: v for k, v in x.items() if with_payload or k != "payload"}
                        held.append(row)
                        size += len(row.get("payload") or b"") + 200
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    # files, not rows, are dealt out: as many partitions as files, so that small ones don't share a task
    return manifest.select("file").repartition(max(1, manifest.count())).mapInArrow(run, SCHEMA)


def records(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    found = read_all(manifest, with_payload).where("status = 'record'").drop("status", "reason")
    return found if with_payload else found.drop("payload")


def gaps(manifest: DataFrame) -> DataFrame:
    """file, start, end and reason of every quarantined stretch of bytes."""
    return read_all(manifest).where("status = 'gap'").select("file", "start", "end", "reason")


def files_under(spark: SparkSession, path: str) -> DataFrame:
    """A manifest of foreign archives: the files under a folder."""
    fs, root = pafs.FileSystem.from_uri(path)
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    names = [(f"{path.rstrip('/')}/{x.path[len(root):].lstrip('/')}",) for x in found
             if x.is_file and re.search(r"\.warc(\.gz)?$", x.path)]
    return spark.createDataFrame(names, "file string")


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, read back from archives
    of all rows of `pages`."""
    manifest = write(pages, fresh_path(pages.sparkSession, "warc"))
    return records(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
