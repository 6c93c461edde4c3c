"""WARC archives: what is written is read, filters reach the reader, and only committed files count."""

import base64
import hashlib
import zlib

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from tidemark import session
from tidemark.llm import warc

ROWS = [(1, "http://a", "<html>x</html>"), (2, "http://b\r\nEvil: 1", "<html>x</html>"), (3, None, None), (4, "", ""), (5, "http://e", "é" * 100_000), (None, "u", "<html>x</html>"), (None, "u", "alone"), (1, "http://a", "<html>x</html>")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(pages):
    rows = warc.round_trip(pages).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)
    kinds = {(1, 0): ("response", None), (2, 0): ("revisit", 1), (3, 0): ("response", None), (4, 0): ("revisit", 3), (5, 0): ("response", None)}
    want = [(i, len((h or "").encode()), digest(h), *(kinds[i, 0] if i else ("revisit", 1) if h[0] == "<" else ("response", None))) for i, _, h in ROWS]
    assert got == sorted(want, key=str)


def test_records(spark, pages):
    folder = session.work_dir(spark, "warc")
    warc.archive(pages, folder)
    rows = spark.read.format("warc").load(folder).collect()
    assert {r.record_id: bytes(r.payload).decode() for r in rows if r.warc_type == "response" and r.record_id != "<urn:x-page:>"} == {
        "<urn:x-page:1>": ROWS[0][2], "<urn:x-page:3>": "", "<urn:x-page:5>": ROWS[4][2]}
    assert all(r.payload is None for r in rows if r.warc_type == "revisit")
    assert {r.target_uri for r in rows if r.record_id == "<urn:x-page:2>"} == {"http://b%0D%0AEvil: 1"}


def test_every_member_is_gzip(spark, pages):
    record = {"warc_type": "response", "record_id": "<urn:x-page:1>", "target_uri": "u", "refers_to": None, "payload_digest": digest("p"), "payload_length": 1, "payload": b"p"}
    plain = zlib.decompress(warc.pack(record), 31)
    assert plain.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and plain.endswith(b"\r\n\r\np\r\n\r\n")
    assert warc.unpack(warc.pack(record), {}, True, True)[-1] == b"p" and warc.unpack(warc.pack(record), {"warc_type": {"revisit"}}, True, True) is None
    with pytest.raises(ValueError):
        warc.unpack(warc.pack(record | {"payload": b"q"}), {}, True, True)


def test_pushdown(spark, pages, monkeypatch):
    folder = session.work_dir(spark, "warc")
    warc.archive(pages, folder)
    reader = warc.WarcReader(folder, True, False)
    left = list(reader.pushFilters([EqualTo(("warc_type",), "response"), In(("record_id",), ("<urn:x-page:1>", "<urn:x-page:5>")), GreaterThan(("payload_length",), 3)]))
    assert [type(f) for f in left] == [GreaterThan] and reader.wanted == {"warc_type": {"response"}, "record_id": {"<urn:x-page:1>", "<urn:x-page:5>"}}
    inflated = []
    whole = warc.unpack
    monkeypatch.setattr(warc, "unpack", lambda m, w, p, v: inflated.append(p) or whole(m, w, p, v))
    rows = [r for part in reader.partitions() for r in reader.read(part)]
    assert {r[0] for r in rows} == {"<urn:x-page:1>", "<urn:x-page:5>"}
    assert spark.read.format("warc").option("payload", "false").load(folder).columns[-1] == "payload_length"
    assert spark.read.format("warc").load(folder).where("warc_type = 'revisit' AND payload_length > 1").count() == 2


def test_ranges_and_uncommitted_files(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 1)
    folder = session.work_dir(spark, "warc").removeprefix("file://")
    writer = warc.WarcWriter(folder, [c.split()[0] for c in warc.WRITTEN.split(", ")])
    record = lambda i: (f"<urn:x-page:{i}>", "response", None, None, digest("p"), 1, b"p")
    writer.write(iter([record(8)]))  # an attempt that was lost
    done = [writer.write(iter([record(1), record(2), record(3)])), writer.write(iter([]))]
    writer.commit(done)
    reader = warc.WarcReader(folder, True, True)
    parts = reader.partitions()
    assert len(parts) == 3 and [r[0] for p in parts for r in reader.read(p)] == [f"<urn:x-page:{i}>" for i in (1, 2, 3)]


def test_empty_table(spark, pages):
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_least_bytes(pages):
    kinds = {r.record_id: r.warc_type for r in warc.records(pages, least_bytes=1).collect()}
    assert kinds["<urn:x-page:4>"] == "response" and kinds["<urn:x-page:2>"] == "revisit"


def long_url(n):
    return "http://" + "".join(hashlib.sha256(b"%d" % i).hexdigest() for i in range(-(-n // 64)))[:n]


def test_headers_of_any_length(spark):
    rows = [(1, long_url(20_000), "same"), (2, long_url(20_000), "same"), (3, long_url(30_000), "other" * 9_999), (4, "http://d", "plain")]
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: (len(h), digest(h), "revisit" if i == 2 else "response", 1 if i == 2 else None) for i, _, h in rows}


def test_a_cut_at_any_place_of_the_headers(tmp_path):
    columns = [c.split()[0] for c in warc.WRITTEN.split(", ")]
    writer = warc.WarcWriter(str(tmp_path), columns)
    sizes = range(7_000, 8_400, 5)  # the bytes read first end before, in and after the HTTP header
    writer.commit([writer.write(iter([(f"<urn:x-page:{n}>", "revisit", long_url(n), "<urn:x-page:1>", digest("p"), n, None) for n in sizes]))])
    reader = warc.WarcReader(str(tmp_path), False, False)
    assert [(r[2], r[5]) for part in reader.partitions() for r in reader.read(part)] == [(long_url(n), n) for n in sizes]
