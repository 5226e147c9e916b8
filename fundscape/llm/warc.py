"""WARC archives: one gzip member per record, written in parallel and read back by byte ranges.

``write_archive`` writes an archive per task into the shared folder and a manifest (path, bytes) of what committed
tasks wrote. ``read_archive`` cuts the archives into byte ranges and deals these out; a task looks for gzip magic in
its range, takes a candidate for a record only if its first bytes inflate to a WARC version line and headers, and owns
the records that start inside its range, reading beyond its end where the last one goes on.

Null payloads are empty, null urls give no target header, null ids an empty record id. Rows that carry the same id
and payload are all written; if that is the winning id of its payload, each is a response.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import cut, shared_dir

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.0\r\n"
#: Bytes that one read takes from an archive.
READ_BYTES = 1 << 20
#: Most bytes of record headers that are looked at before a candidate is given up.
HEADER_BYTES = 1 << 16
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, verified boolean"


def _record(page_id, url, digest: str, size: int, refers_to, payload: bytes) -> bytes:
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    name = "" if page_id is None else page_id
    lines = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(base: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path = f"{base}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
    fs, name = pafs.FileSystem.from_uri(path)
    out, size, n = None, 0, 0
    for batch in batches:
        for row in zip(*(batch.column(c) for c in range(batch.num_columns)), strict=True):
            page_id, url, html, digest, length, refers_to = (x.as_py() for x in row)
            if out is None:
                fs.create_dir(name.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(name, compression=None)  # members are packed here
            packer = zlib.compressobj(4, zlib.DEFLATED, 31)
            member = packer.compress(_record(page_id, url, digest, length, refers_to, (html or "").encode())) + packer.flush()
            out.write(member)
            size, n = size + len(member), n + 1
    if out is not None:
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["path", "bytes", "records"])


def with_revisits(pages: DataFrame, *, least_bytes: int = 1000, salts: int = 64) -> DataFrame:
    """``pages`` (page_id, url, html) with digest, length and ``refers_to``: of equal payloads of at least
    ``least_bytes`` the one with the largest page_id is kept, the others refer to it.

    The digests of a group of copies are joined under ``salts`` salts, and texts are moved by their own id only.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    full = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("length"))
    narrow = full.where(F.col("length") >= least_bytes).select("page_id", "digest")
    groups = narrow.groupBy("digest").agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("n")).where("n > 1 and winner is not null")
    groups = groups.select("digest", "winner", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    own = narrow.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int"))
    revisits = own.join(groups, ["digest", "salt"]).where("page_id is null or page_id < winner")
    revisits = revisits.select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "winner").distinct()
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    return full.join(revisits, same, "left").select("page_id", "url", "html", "digest", "length", F.col("winner").alias("refers_to"))


def write_archive(rows: DataFrame) -> DataFrame:
    """Write what ``with_revisits`` returns; the manifest: path, bytes, records."""
    base = shared_dir(rows.sparkSession, "warc")
    return cut(rows.mapInArrow(lambda batches: _write(base, batches), "path string, bytes long, records long"), "manifest")


class _Window:
    """A file read forwards, from any position at or after the last one asked for."""

    def __init__(self, handle, size: int):
        self.handle, self.size, self.at, self.data = handle, size, 0, b""

    def get(self, start: int, n: int) -> bytes:
        if start < self.at or start + n > self.at + len(self.data):
            self.handle.seek(start)
            self.at, self.data = start, self.handle.read(max(n, READ_BYTES))
        return self.data[start - self.at : start - self.at + n]


def _inflate(window: _Window, start: int) -> tuple[bytes, int] | None:
    """The record that begins at ``start`` and where its member ends; None if no WARC record does."""
    opener, out, at, known = zlib.decompressobj(31), bytearray(), start, False
    try:
        while not opener.eof:
            piece = window.get(at, 1 << 16) if at < window.size else b""
            if not piece:
                return None
            out += opener.decompress(piece)
            at += len(piece)
            if not known and (len(out) >= HEADER_BYTES or opener.eof or b"\r\n\r\n" in out):
                if not out.startswith(VERSION) or b"\r\n\r\n" not in out:
                    return None
                known = True
            elif not known and len(out) >= len(VERSION) and not out.startswith(VERSION):
                return None
    except zlib.error:
        return None
    return bytes(out), at - len(opener.unused_data)


def _parse(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    page, other = fields["WARC-Record-ID"][10:-1], fields.get("WARC-Refers-To", "<urn:page:>")[10:-1]
    kind, digest, size = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    whole = kind == "response"
    good = not whole or (hashlib.sha1(payload).hexdigest() == digest and len(payload) == size)
    return int(page) if page else None, fields.get("WARC-Target-URI"), kind, int(other) if other else None, size, digest, payload if whole else None, good


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.bool_()]
    names = [c.split()[0] for c in RECORD.split(", ")]
    for batch in batches:
        for path, start, stop in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            fs, name = pafs.FileSystem.from_uri(path)
            with fs.open_input_file(name) as handle:
                window = _Window(handle, handle.size())
                at, rows, held = start, [], 0
                while at < min(stop, window.size):
                    found = _inflate(window, at) if window.get(at, 3) == MAGIC else None
                    if found is None:  # on to the next magic; one that begins inside may end beyond the range
                        piece = window.get(at + 1, min(READ_BYTES, stop - at - 1) + 2)
                        step = piece.find(MAGIC)
                        at = at + 1 + step if step >= 0 else at + max(1, len(piece) - 1)
                        continue
                    record, at = found
                    rows.append(_parse(record))
                    if not payloads:
                        rows[-1] = (*rows[-1][:6], None, rows[-1][7])
                    held += len(record) if payloads else 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def read_archive(manifest: DataFrame, *, split_bytes: int = 4 << 20, payloads: bool = True) -> DataFrame:
    """The records of all archives in ``manifest`` (path, bytes), read in ranges of ``split_bytes``."""
    starts = F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes))
    splits = manifest.where("bytes > 0").select("path", F.explode(starts).alias("start")).withColumn("stop", F.col("start") + split_bytes)
    n = manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    return splits.repartition(int(min(n, 100_000)), "path", "start").mapInArrow(lambda batches: _read(batches, payloads), RECORD)
