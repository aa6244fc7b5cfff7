"""WARC archives through a chunked record table.

Writing: each task streams its records into archives in the shared folder
(per-record gzip members) and returns a manifest of segments; the manifest is
a Spark table, so only files of successful attempts are ever read. Payloads
are fed to the compressor in slices of the column's own buffer.

Reading: each segment is streamed; a payload of any length becomes rows of
(record, chunk number) that carry the SHA-256 of everything up to that chunk,
so the last chunk's digest is the payload's and no record is held whole.

Records with equal payloads of at least ``MIN_DUP`` bytes: the smallest id is
a response, the others are revisits that refer to it. The table of repeated
digests is materialised, so Spark knows its size when it plans the join; a
hot digest is split by the skewed-join rule.

Defined results: a null payload counts as empty; rows that share the smallest
id are all responses; a null id is never the one referred to while another id
exists, and a null url is written as an empty target; repeated rows are
separate records; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import scratch
from .textnum import text_bytes

MIN_DUP = 100
CHUNK = 1 << 16
SEGMENT = 8 << 20          # compressed bytes per manifest row
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def record_urn(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def header(page_id, url: str | None, kind: str, digest: str, size: int, refers_to) -> bytes:
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_urn(page_id, digest)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_urn(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    body = len(HTTP) + (size if kind == "response" else 0)
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {body}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _member(out, parts: Iterator) -> int:
    """Write one gzip member from slices; returns its compressed size."""
    z, n = zlib.compressobj(1, zlib.DEFLATED, 31), 0
    for p in parts:
        n += out.write(z.compress(p))
    return n + out.write(z.flush())


def _slices(view: memoryview) -> Iterator[memoryview]:
    for k in range(0, len(view), CHUNK):
        yield view[k : k + CHUNK]


def write(records: DataFrame, folder: str) -> DataFrame:
    """``records``: page_id, url, payload, record_type, payload_digest,
    refers_to. Returns the manifest: ``archive, start, length, records``."""
    def run(batches):
        tc = TaskContext.get()
        name = f"part-{tc.partitionId():06d}-{tc.taskAttemptId()}-{uuid.uuid4().hex[:6]}.warc.gz"
        out, at, start, count = None, 0, 0, 0
        rows = []
        for batch in batches:
            if out is None and batch.num_rows:
                store, path = _filesystem(folder)
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/{name}", compression=None)
            page, url, kind, digest, refers = (batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5))
            raw, bounds = text_bytes(batch.column(2))
            view = memoryview(raw)
            for k in range(batch.num_rows):
                body = view[bounds[k] : bounds[k + 1]]

                def parts(k=k, body=body):
                    yield header(page[k], url[k], kind[k], digest[k], len(body), refers[k])
                    yield HTTP
                    if kind[k] == "response":
                        yield from _slices(body)
                    yield b"\r\n\r\n"

                at += _member(out, parts())
                count += 1
                if at - start >= SEGMENT:
                    rows.append((f"{folder}/{name}", start, at - start, count))
                    start, count = at, 0
        if out is not None:
            out.close()
            if count:
                rows.append((f"{folder}/{name}", start, at - start, count))
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0]), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                             ["archive", "start", "length", "records"])

    src = records.select("page_id", F.col("url").cast("string"), F.col("payload").cast("string"), "record_type", "payload_digest", "refers_to")
    return src.mapInArrow(run, "archive string, start long, length long, records long")


class _Members:
    """Decompressed bytes of a range of gzip members, some at a time."""

    def __init__(self, f, length: int):
        self.f, self.left, self.raw, self.buf = f, length, b"", bytearray()
        self.z = zlib.decompressobj(31)

    def fill(self) -> bool:
        while True:
            if not self.raw and self.left:
                self.raw = self.f.read(min(CHUNK, self.left))
                if not self.raw:
                    raise EOFError("archive ends within a segment")
                self.left -= len(self.raw)
            if not self.raw:
                return False
            got = self.z.decompress(self.raw, CHUNK)
            if self.z.eof:
                self.raw, self.z = self.z.unused_data, zlib.decompressobj(31)
            else:
                self.raw = self.z.unconsumed_tail
            if got:
                self.buf += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before ``mark``, which is passed over; None at the end."""
        while (k := self.buf.find(mark)) < 0:
            if not self.fill():
                if self.buf:
                    raise EOFError("segment ends within a header")
                return None
        out = bytes(self.buf[:k])
        del self.buf[: k + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) < n and self.fill():
            pass
        out = bytes(self.buf[:n])
        if len(out) < n:
            raise EOFError("segment ends within a block")
        del self.buf[:n]
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return dict(line.split(": ", 1) for line in lines[1:])


def _chunks(src: _Members, head: dict[str, str]) -> Iterator[tuple[int, bytes, str]]:
    """(chunk number, data, digest so far) of a record's payload."""
    length = int(head["Content-Length"])
    http = src.until(b"\r\n\r\n")
    left = length - len(http) - 4
    sha, k = hashlib.sha256(), 0
    while True:
        data = src.take(min(CHUNK, left))
        left -= len(data)
        sha.update(data)
        yield k, data, sha.copy().hexdigest()
        k += 1
        if not left:
            break
    if src.take(4) != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")


CHUNK_COLUMNS = [("record", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                 ("declared_length", pa.int64()), ("declared_digest", pa.string()), ("chunk_no", pa.int64()),
                 ("n_bytes", pa.int64()), ("digest_so_far", pa.string()), ("data", pa.binary())]
_CHUNK_DDL = ("record string, page_id long, record_type string, refers_to long, declared_length long, declared_digest string, "
              "chunk_no long, n_bytes long, digest_so_far string")


def read_chunks(manifest: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunked record table of the manifest's archives. ``with_data=False``
    leaves the chunk bytes out (digests and lengths are still of them)."""
    schema = pa.schema(CHUNK_COLUMNS if with_data else CHUNK_COLUMNS[:-1])

    def run(batches):
        rows, held = [], 0

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in batches:
            for seg in batch.to_pylist():
                store, path = _filesystem(seg["archive"])
                with store.open_input_file(path) as f:
                    f.seek(seg["start"])
                    src, n = _Members(f, seg["length"]), 0
                    while (head := src.until(b"\r\n\r\n")) is not None:
                        h = _fields(head)
                        name = f"{path.rsplit('/', 1)[1]}:{seg['start']}:{n}"
                        page, refers = h.get("X-Page-Id"), h.get("X-Refers-To-Page")
                        for k, data, sha in _chunks(src, h):
                            row = (name, page and int(page), h["WARC-Type"], refers and int(refers), int(h["X-Payload-Length"]),
                                   h["WARC-Payload-Digest"].removeprefix("sha256:"), k, len(data), sha)
                            rows.append((*row, data) if with_data else row)
                            held += len(data) if with_data else 300
                            if held > 4 << 20:
                                yield batch_of(rows)
                                rows, held = [], 0
                        n += 1
                    if n != seg["records"]:
                        raise ValueError(f"{seg['archive']}: {n} records, the manifest has {seg['records']}")
        if rows:
            yield batch_of(rows)

    return manifest.mapInArrow(run, _CHUNK_DDL + (", data binary" if with_data else ""))


def with_decisions(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    raw = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), raw.alias("payload"))
    size = F.octet_length("payload").cast("long")
    sized = p.select("*", size.alias("payload_bytes"), F.sha2(F.col("payload").cast("binary"), 256).alias("payload_digest"))
    dup = scratch.table(sized.where(F.col("payload_bytes") >= MIN_DUP).groupBy("payload_digest")
                        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "first"), "digests")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return (sized.join(dup, "payload_digest", "left").withColumn("refers_to", refers)
            .withColumn("record_type", F.when(refers.isNull(), F.lit("response")).otherwise(F.lit("revisit"))))


def archive(pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """Write a record per page below ``folder``; returns the manifest table."""
    return scratch.table(write(with_decisions(pages, id_col, payload_col), folder), "manifest")


def records(chunks: DataFrame) -> DataFrame:
    """One row per record of a chunk table: length and digest from the chunks
    of a response, from the header of a revisit; ``verified`` says whether the
    chunks of a response have the declared length and digest."""
    head = ["record", "page_id", "record_type", "refers_to", "declared_length", "declared_digest"]
    r = chunks.groupBy(*head).agg(F.sum("n_bytes").alias("n"), F.max_by("digest_so_far", "chunk_no").alias("sha"), F.count("*").alias("n_chunks"))
    response = F.col("record_type") == "response"
    return r.select("page_id", F.when(response, F.col("n")).otherwise(F.col("declared_length")).alias("payload_bytes"),
                    F.when(response, F.col("sha")).otherwise(F.col("declared_digest")).alias("payload_digest"),
                    "record_type", "refers_to", "n_chunks",
                    (~response | ((F.col("n") == F.col("declared_length")) & (F.col("sha") == F.col("declared_digest")))).alias("verified"))
