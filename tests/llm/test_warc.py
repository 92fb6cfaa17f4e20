import hashlib
import io

import pytest
from pyspark.sql import functions as F

from cadenza.llm import warc

ROWS = [
    (1, "http://a/1", "x" * 1500),
    (2, "http://a/2", "x" * 1500),
    (9, "http://a/9", "x" * 1500),
    (4, "http://a/4", "small"),
    (5, "http://a/5", "small"),
    (6, None, None),
    (7, "http://a/\r\nWARC-Type: fake", "é" * 500),
    (8, "http://a/8", "é" * 500),
    (10, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 90),
    (10, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 90),
    (None, "u", "x" * 1500),
    (None, "u", "lonely " * 300),
    (None, "u", "lonely " * 300),
    (11, "u", "long page " * 200_000),
]


def expected(rows):
    same = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 1000 and page is not None:
            same[raw] = max(page, same.get(raw, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = same.get(raw) if len(raw) >= 1000 else None
        revisit = first is not None and page != first
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def folder(spark):
    pages = spark.createDataFrame([(*r, "response", b"x") for r in ROWS], "page_id long, url string, html string, record_type string, payload binary")
    return warc.archive(pages.repartition(3))


def test_round_trip(spark, folder):
    got = warc.read_pages(spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == expected(ROWS)


def test_payloads_and_pushdown(spark, folder):
    df = spark.read.format(warc.FORMAT).load(folder)
    assert df.where("record_type = 'response'").count() == sum(x[3] == "response" for x in expected(ROWS))
    one = df.where("record_id = '<urn:page:4>' and payload_bytes < 10").collect()
    assert [bytes(r.payload) for r in one] == [b"small"]
    assert df.where("target_uri is null").count() == 1
    assert df.where("target_uri like 'http%' and record_type in ('revisit', 'x')").count() == 3
    assert df.where("not record_type = 'response'").count() == df.where("refers_to is not null").count() > 0
    assert df.where(F.length("payload") == 5).count() == 2
    text = df.where("payload_bytes >= 100 and record_type = 'response'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in text  # all of it is the source's work
    skipped = spark.read.format(warc.FORMAT).option("payload", "false").load(folder).collect()
    assert len(skipped) == len(ROWS) and all(r.payload is None for r in skipped)


def test_blocks_are_skipped(spark, folder):
    reader = warc.WarcReader({"path": folder, "split_bytes": "1000"})
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "none"), warc.EqualTo(("payload",), b"")])) == [warc.EqualTo(("payload",), b"")]
    parts = reader.partitions()
    assert len(parts) > 1
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 0


def test_every_record_is_in_one_slice(spark, monkeypatch):
    monkeypatch.setattr(warc, "CUT_BYTES", 200)
    writer = warc.WarcWriter({"path": f"file://{warc.filesystem(warc.scratch_path(spark, 'cuts'))[1]}"})
    rows = [{"record_type": "response", "record_id": str(i), "target_uri": None, "refers_to": None, "payload_digest": None, "payload_bytes": i, "payload": b"z" * i} for i in range(300)]
    writer.commit([writer.write(iter([warc.pa.RecordBatch.from_pylist(rows, warc._ARROW)]))])
    for split in (1, 1000, 10**9):
        reader = warc.WarcReader({"path": writer.folder, "split_bytes": str(split)})
        got = [x for p in reader.partitions() for b in reader.read(p) for x in b.to_pylist()]
        assert got == rows


def test_failed_attempts_do_not_count(spark, folder):
    fs, where = warc.filesystem(folder)
    with fs.open_output_stream(f"{where}/part-orphan.warc") as sink:
        sink.write(warc.record({"record_type": "response", "record_id": "x", "target_uri": None, "refers_to": None, "payload_digest": None, "payload_bytes": 1, "payload": b"y"}, "d"))
    assert spark.read.format(warc.FORMAT).load(folder).count() == len(ROWS)


def test_foreign_archive(spark, tmp_path):
    block = b"HTTP/1.0 200 OK\r\nX: y\r\n\r\nbody"
    raw = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\ninfo\r\n\r\n"
    raw += b"WARC/1.0\r\nwarc-type: response\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    (tmp_path / "a.warc").write_bytes(raw)
    warc.register(spark)
    got = spark.read.format(warc.FORMAT).load(f"file://{tmp_path}").collect()
    assert [(r.record_type, bytes(r.payload)) for r in got] == [("warcinfo", b"info"), ("response", b"body")]
    with pytest.raises(ValueError):
        warc.read_headers(io.BytesIO(b"nonsense\r\n"))


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_pages(spark, warc.archive(empty)).collect() == []
