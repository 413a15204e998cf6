"""WARC archives: a deduplicating writer and a splittable reader.

The writer makes one ``.warc.gz`` per task in a shared folder; every record is a
gzip member of its own.  A payload that an earlier page has becomes a revisit
record.  Only the files listed in the returned manifest count, so a task that
is run again leaves nothing wrong behind.

The reader deals byte ranges of the files to tasks.  A task looks for the gzip
magic from the start of its range, takes a candidate for a member only if it
decodes to a WARC header and the next member (or the end of the file) follows
right after it, and owns the records that start inside its range.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from murmur.llm.common import stored
from murmur.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
MIN_REVISIT = 100               # payload bytes from which copies become revisits
SPLIT = 16 << 20
MAX_TASKS = 100_000              # of a reading stage; each takes several ranges beyond
CHUNK = 1 << 20
HEAD = 1 << 14                  # compressed bytes that a candidate's header is sought in


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _clean(value: str) -> str:
    """A header value: line breaks and other control characters as %XX."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(page: str, url: str | None, digest: str, size: int, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC/1.1 record as a gzip member.  ``page`` and ``refers_to`` are page ids."""
    kind = "revisit" if refers_to is not None else "response"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + (b"" if refers_to is not None else payload)
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(body)}"]
    if url is not None:
        head.insert(3, f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    data = "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def revisits(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """``pages`` as (page, url, payload, digest, size, refers_to).

    Of equal payloads of ``MIN_REVISIT`` bytes or more, the smallest page id is the
    response; rows that share that id are responses all.  Null ids are never
    referred to and are revisits of a non-null one only.
    """
    p = pages.select(F.col(key).alias("page"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    first = (p.where(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
             .where("n > 1 AND first IS NOT NULL").select(F.col("digest").alias("d"), "first"))
    return (p.join(first, p.digest == first.d, "left")
            .withColumn("refers_to", F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")))
            .select("page", "url", "payload", "digest", "size", "refers_to"))


def write(pages: DataFrame, folder: str, key: str = "page_id", payload: str = "html") -> DataFrame:
    """Write the archives into ``folder`` (a shared path or URI) now; returns the
    stored manifest: ``path``, ``bytes``, ``records`` of each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _filesystem(folder)
        filesystem.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, total, records = None, 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page", "url", "digest", "size", "payload", "refers_to"))):
                page, url, digest, size, body, refers_to = (x.as_py() for x in row)
                data = record(str(page), url, digest, size, body, None if refers_to is None else str(refers_to))
                out = out or filesystem.open_output_stream(f"{base}/{name}", compression=None)
                out.write(data)
                total, records = total + len(data), records + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": pa.array([total], pa.int64()),
                                              "records": pa.array([records], pa.int64())})

    return stored(revisits(pages, key, payload).mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


class _Bytes:
    """Forward window over a file: ``at`` is the current place."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.at, self.data, self.off = file, size, at, b"", 0
        file.seek(at)

    def peek(self, n: int, ahead: int = 0) -> bytes:
        """Up to ``n`` bytes from ``ahead`` bytes after the current place (fewer at the end of the file)."""
        want = self.off + ahead + n
        if want > len(self.data) and self.at - self.off + len(self.data) < self.size:
            parts = [self.data[self.off:]]
            have, self.off = len(parts[0]), 0
            while have < ahead + n and (more := self.file.read(max(CHUNK, ahead + n - have))):
                parts.append(more)
                have += len(more)
            self.data = b"".join(parts)
        return self.data[self.off + ahead:self.off + ahead + n]

    def skip(self, n: int) -> None:
        self.at += n
        self.off += n


def _starts_record(data: bytes) -> bool:
    """Whether ``data`` begins with a gzip member whose text begins a WARC header."""
    if not data.startswith(MAGIC):
        return False
    try:
        return zlib.decompressobj(31).decompress(data, 64).startswith(VERSION)
    except zlib.error:
        return False


def _member(window: _Bytes) -> tuple[bytes, int] | None:
    """Text and length of the member at the window's place; None if it is none."""
    unpack, out, used = zlib.decompressobj(31), [], 0
    try:
        while not unpack.eof:
            piece = window.peek(HEAD, used)
            if not piece:
                return None
            out.append(unpack.decompress(piece))
            used += len(piece) - len(unpack.unused_data)
    except zlib.error:
        return None
    return b"".join(out), used


def records_of(file, size: int, start: int, end: int) -> Iterator[bytes]:
    """Texts of the records that start in ``[start, end)`` of an open file."""
    window, synced = _Bytes(file, size, start), start == 0
    while window.at < min(end, size):
        if not synced:
            data = window.peek(HEAD)
            at = data.find(MAGIC)
            if at < 0:                                      # keep two bytes: a magic may lie across
                window.skip(max(1, len(data) - 2))
                continue
            window.skip(at)
            if window.at >= end:
                return
        found = _member(window) if _starts_record(window.peek(HEAD)) else None
        if found is not None:
            text, used = found
            after = window.peek(HEAD, used)
            if not after or _starts_record(after):
                yield text
                window.skip(used)
                synced = True
                continue
        if synced:
            raise ValueError(f"no record at byte {window.at}")
        window.skip(1)


def parse(text: bytes) -> dict:
    """Headers (lower-case names) and ``payload`` of a record."""
    head, _, block = text.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    out = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    body = block[:int(out["content-length"])]
    http = out.get("content-type", "").startswith("application/http")
    out["payload"] = body.partition(b"\r\n\r\n")[2] if http else body
    return out


def agrees(digest: str | None, payload: bytes) -> bool:
    """Whether a payload has its header's digest (``algorithm:value``, hexadecimal or base 32); unknown ones pass."""
    algorithm, _, value = (digest or "").partition(":")
    if algorithm.lower() not in ("sha1", "sha256", "md5"):
        return True
    got = hashlib.new(algorithm.lower(), payload).digest()
    return value.lower() == got.hex() or value.rstrip("=").upper() == base64.b32encode(got).decode().rstrip("=")


def read(manifest: DataFrame, split: int = SPLIT) -> DataFrame:
    """Records of the archives in ``manifest(path, bytes)``: ``page``, ``url``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to`` and ``payload`` (null for a revisit).

    Any archive of gzip members can be read, with records of any type; those without an HTTP block have the whole block
    as payload.  Length and SHA-256 are taken from the payload, which must agree with the digest and length of its
    header, if any; a revisit has those of its header (a digest by another algorithm with its name, no length if none is
    given).  ``page`` and ``refers_to`` are record ids without brackets and, for our own archives, without prefix.

    Ranges of ``split`` bytes are dealt evenly over as many partitions as there are ranges; an empty manifest gives no rows.
    """
    schema = ("page string, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to string, payload binary")
    arrow = pa.schema([("page", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])

    def row(text: bytes) -> dict:
        r = parse(text)
        digest, size, kind = r.get("warc-payload-digest"), r.get("x-payload-length"), r.get("warc-type")
        name = lambda x: x.strip("<>").removeprefix("urn:page:") if x else None
        out = {"page": name(r.get("warc-record-id")), "url": r.get("warc-target-uri"), "record_type": kind, "refers_to": name(r.get("warc-refers-to"))}
        if kind == "revisit":
            return out | {"payload_bytes": None if size is None else int(size), "payload": None,
                          "payload_digest": digest and digest.removeprefix("sha256:")}
        payload = r["payload"]
        if not agrees(digest, payload) or size is not None and len(payload) != int(size):
            raise ValueError(f"payload of {r.get('warc-record-id')} does not match its header")
        return out | {"payload_bytes": len(payload), "payload": payload, "payload_digest": hashlib.sha256(payload).hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                filesystem, path = _filesystem(part["path"])
                rows, held = [], 0
                with filesystem.open_input_file(path) as file:
                    for text in records_of(file, part["bytes"], part["start"], part["start"] + split):
                        rows.append(row(text))
                        held += len(text)
                        if held > 8 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    ranges = manifest.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))).alias("start"))
    # By number: a range is a few bytes here, so that adaptive execution would read all archives in one task.
    return ranges.repartition(max(1, min(ranges.count(), MAX_TASKS))).mapInArrow(run, schema)


def archive_and_read(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared scratch folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read(write(pages, folder if "://" in folder else f"file://{folder}", key, payload))
