"""WARC archives as a table of chunks.

Writing: each input partition goes to archives of its own, a gzip member a record. Reading: a record's payload becomes
rows (record, chunk number) of at most CHUNK bytes, each with the SHA-256 of the payload up to its end, so that no record
is ever held whole. Records of equal payloads are found by digest in Spark before anything is written; all but one are
revisits without a payload.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Atomic, arrow_map, opened, remove, scratch, struct, within, written

#: Bytes of a payload in a row of the chunk table, of a read, and of an archive before the next one begins.
CHUNK, READ, ARCHIVE = 1 << 20, 1 << 18, 1 << 28
#: A payload of fewer bytes is never a revisit.
LEAST_REVISIT = 100
#: Payloads with copies that are broadcast at most (each 100 bytes or so); beyond, the join is by shuffle.
BROADCAST_ROWS = 50_000

#: Fixed value: the profile that WARC 1.1 names for revisits of an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
MANIFEST = struct("uri string, n_records long, n_bytes long")
CHUNKS = struct("uri string, offset long, page_id long, record_type string, refers_to long, payload_bytes long, chunk_no long, chunk_bytes long, digest string, last boolean, chunk binary")


def _name(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _head(page_id, url, kind: str, refers, digest: str, size: int) -> tuple[bytes, bytes]:
    """The WARC header and, of a response, the HTTP header that opens its block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() if kind == "response" else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers)}", f"X-Payload-Length: {size}"]
    else:
        lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(http) + (size if kind == 'response' else 0)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode(), http


def _write(batches: Iterator[pa.RecordBatch], *, folder: str) -> Iterator[pa.RecordBatch]:
    part, seq, f, n, done = TaskContext.get().partitionId(), 0, None, 0, []
    for b in batches:
        for page_id, url, html, digest, refers in zip(*(c.to_pylist() for c in b.columns)):
            if f is None:
                f, n = Atomic(f"{folder}/part-{part:06d}-{seq:04d}.warc.gz"), 0
            payload = memoryview((html or "").encode())
            head, http = _head(page_id, url, "response" if refers is None else "revisit", refers, digest, len(payload))
            z = zlib.compressobj(1, zlib.DEFLATED, 31)
            f.write(z.compress(head + http))
            for at in range(0, len(payload) if refers is None else 0, CHUNK):
                f.write(z.compress(payload[at : at + CHUNK]))
            f.write(z.compress(b"\r\n\r\n") + z.flush())
            n += 1
            if f.size >= ARCHIVE:
                done.append((f.uri, n, f.close()))
                f, seq = None, seq + 1
    if f is not None:
        done.append((f.uri, n, f.close()))
    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64()))], names=MANIFEST.names)


class _Member:
    """The bytes of one gzip member, a bounded part at a time."""

    def __init__(self, f, rest: bytes):
        self.f, self.z, self.rest, self.buf, self.held = f, zlib.decompressobj(31), rest, b"", False

    def more(self) -> bytes:
        """Some more bytes; none at the member's end."""
        while not self.z.eof:
            raw = self.z.unconsumed_tail or self.rest
            if not raw and not self.held:
                raw = self.f.read(READ)
                if not raw:
                    raise EOFError("an archive ends inside a record")
            self.rest = b""
            got = self.z.decompress(raw, READ)
            self.held = len(got) == READ  # then it may hold more, though all input is used
            if got:
                return got
        return b""

    def until(self, mark: bytes) -> bytes:
        while mark not in self.buf:
            got = self.more()
            if not got:
                raise ValueError("a record's header does not end")
            self.buf += got
        out, _, self.buf = self.buf.partition(mark)
        return out

    def upto(self, n: int) -> bytes:
        """n bytes at most, at least one unless the member has ended."""
        if not self.buf:
            self.buf = self.more()
        out, self.buf = self.buf[:n], self.buf[n:]
        return out


def chunks_of(f, *, payload: bool = True) -> Iterator[tuple]:
    """The chunk rows of an open archive, without its name: offset, page_id, ... as in CHUNKS."""
    rest, number = b"", 0
    while True:
        rest = rest or f.read(READ)
        if not rest:
            return
        m = _Member(f, rest)
        head = dict(x.split(": ", 1) for x in m.until(b"\r\n\r\n").decode().split("\r\n")[1:])
        of = lambda name: int(x[10:-1]) if (x := head.get(name, "<urn:page:>")) != "<urn:page:>" else None
        kind, page_id = head["WARC-Type"], of("WARC-Record-ID")
        want = head["WARC-Payload-Digest"].removeprefix("sha256:")
        if kind == "revisit":
            yield (number, page_id, kind, of("WARC-Refers-To"), int(head["X-Payload-Length"]), 0, 0, want, True, None)
        else:
            http = m.until(b"\r\n\r\n")
            left = total = int(head["Content-Length"]) - len(http) - 4
            sha, k = hashlib.sha256(), 0
            while True:
                size, part = 0, []
                while left and size < CHUNK:
                    got = m.upto(min(left, CHUNK - size))
                    if not got:
                        raise EOFError("a payload is shorter than its header says")
                    sha.update(got)
                    size += len(got)
                    left -= len(got)
                    if payload:
                        part.append(got)
                digest = sha.hexdigest()
                if not left and digest != want:
                    raise ValueError(f"page {page_id}: the payload does not fit its digest")
                yield (number, page_id, kind, None, total, k, size, digest, not left, b"".join(part) if payload else None)
                k += 1
                if not left:
                    break
        while m.upto(READ):  # the two line ends after the block
            pass
        rest = m.z.unused_data
        number += 1


def _read(batches: Iterator[pa.RecordBatch], *, payload: bool) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    names = CHUNKS.names if payload else CHUNKS.names[:-1]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds[: len(names)])], names=names)

    for b in batches:
        for uri in b.column(0).to_pylist():
            with opened(uri) as f:
                rows, n = [], 0
                for x in chunks_of(f, payload=payload):
                    rows.append((uri, *x))
                    n += x[6] if payload else 0
                    if len(rows) >= 2048 or n >= 4 * CHUNK:
                        yield batch(rows)
                        rows, n = [], 0
                if rows:
                    yield batch(rows)


def write_archives(pages: DataFrame, *, folder: str | None = None) -> DataFrame:
    """Write a record per row of pages (page_id, url, html); returns the manifest, a row an archive.

    A null html is an empty payload, a null url gives no target. Of rows with equal payloads of LEAST_REVISIT bytes or
    more, those with the smallest page_id are responses and the others revisit it; null ids count as largest. An
    empty table makes no archive.
    """
    spark = pages.sparkSession
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2("html", 256))
    long = F.octet_length("html") >= LEAST_REVISIT
    first = p.where(long).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first_id IS NOT NULL").select("digest", "first_id")
    first = written(first, "warc-copies")
    few = within(first, BROADCAST_ROWS)
    joined = p.join(F.broadcast(first) if few else first, "digest", "left")
    refers = F.when(long & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    rows = joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    out = written(arrow_map(rows, _write, MANIFEST, folder=folder or scratch(spark, "warc")), "warc-manifest")
    remove(spark, first.rostrum_path)
    return out


def read_chunks(manifest: DataFrame, *, payload: bool = True) -> DataFrame:
    """The chunk table of all archives: a row per chunk of a response, one without bytes per revisit or empty payload.

    offset is the record's number in its archive, digest the SHA-256 of the payload up to the chunk's end (of a revisit:
    of the payload that it refers to). The last chunk's digest is checked against the header. payload=False leaves the bytes out.
    """
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return arrow_map(manifest.select("uri").repartition(n, "uri"), _read, CHUNKS if payload else struct(", ".join(f"{f.name} {f.dataType.typeName()}" for f in CHUNKS[:-1])), payload=payload)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record of a chunk table: page_id, payload_bytes, payload_digest, record_type, refers_to, n_chunks."""
    end = chunks.groupBy("uri", "offset").agg(
        F.max_by(F.struct("page_id", "payload_bytes", "digest", "record_type", "refers_to"), "chunk_no").alias("r"), F.count(F.lit(1)).alias("n_chunks")
    )
    return end.select("r.page_id", "r.payload_bytes", F.col("r.digest").alias("payload_digest"), "r.record_type", "r.refers_to", "n_chunks")
