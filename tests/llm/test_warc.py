import gzip
import hashlib
import zlib
from pathlib import Path

import pytest

from ordwave.llm import scratch, warc

from .conftest import CLASH


@pytest.fixture(scope="module")
def rows():
    big, other = "<html>" + "x" * 300_000 + "é\r\n\r\nWARC/1.1\r\n</html>", "<p>other</p>" * 40
    return [(1, "http://a.example/", big), (2, "http://b.example/", big), (3, None, None), (4, "http://c.example/a b\r\nX: y", ""),
            (5, "u", "short"), (6, "u", "short"), (7, "u", other), (0, "u", other), (0, "u", other), (None, "u", other), (9, "u", "y" * 65536),
            (10, "u", "z" * 100), (11, "u", "z" * 100), (12, "u", "z" * 99), (13, "u", "z" * 99)]


@pytest.fixture(scope="module")
def pages(spark, rows):
    return spark.createDataFrame([(*r, *([None] * 12)) for r in rows], f"page_id long, url string, html string, {CLASH}").repartition(3).cache()


@pytest.fixture(scope="module")
def manifest(spark, pages):
    return warc.archive(pages, scratch.folder(spark, "warc-test"))


def expected(rows):
    size = lambda h: len((h or "").encode())
    out = []
    for i, _, h in rows:
        same = [k for k, _, x in rows if (x or "") == (h or "") and k is not None]
        first = min(same) if same and size(h) >= 100 else i
        out.append((i, size(h), hashlib.sha256((h or "").encode()).hexdigest(), "response" if first == i else "revisit", None if first == i else first))
    return out


def test_round_trip(rows, manifest):
    got = warc.records(warc.read_chunks(manifest, with_data=False)).collect()
    assert all(r.verified for r in got)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(expected(rows), key=str)


def test_chunks_are_the_payload_with_running_digests(rows, manifest):
    got = [r for r in warc.read_chunks(manifest).collect() if r.page_id == 1]
    got.sort(key=lambda r: r.chunk_no)
    data = rows[0][2].encode()
    assert [r.chunk_no for r in got] == list(range(-(-len(data) // warc.CHUNK)))
    assert b"".join(r.data for r in got) == data
    seen = b""
    for r in got:
        seen += r.data
        assert r.digest_so_far == hashlib.sha256(seen).hexdigest()


def test_archives_are_warc(rows, manifest):
    text = b""
    for r in manifest.collect():
        raw = Path(r.archive.removeprefix("file://")).read_bytes()[r.start : r.start + r.length]
        text += gzip.decompress(raw)
    assert text.count(b"WARC-Type: response\r\n") + text.count(b"WARC-Type: revisit\r\n") == len(rows)
    assert b"a%20b%0D%0AX:%20y\r\n" in text                      # a target can't add a header


def test_damage_is_found(spark, manifest):
    seg = manifest.orderBy("archive").first()
    path = Path(scratch.folder(spark, "damaged").removeprefix("file://"))
    path.mkdir(parents=True)
    raw = bytearray(gzip.decompress(Path(seg.archive.removeprefix("file://")).read_bytes()[seg.start : seg.start + seg.length]))
    at = raw.index(b"Content-Length: ") + 16
    raw[at] = ord("9")
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    data = z.compress(bytes(raw)) + z.flush()
    (path / "x.warc.gz").write_bytes(data)
    bad = spark.createDataFrame([(f"file://{path}/x.warc.gz", 0, len(data), seg.records)], manifest.schema)
    with pytest.raises(Exception, match="segment ends|does not end|not a WARC"):
        warc.read_chunks(bad).collect()


def test_segments_and_empty_table(spark, pages, rows, monkeypatch):
    got = warc.records(warc.read_chunks(warc.archive(pages.limit(0), scratch.folder(spark, "none"))))
    assert got.count() == 0
