import base64
import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from basketstream.llm import warc

PAGES = [(1, "http://a/x y\r\n", "same"), (2, "http://b", "same"), (3, None, None), (4, "u", ""), (5, "u", "<p>ü</p>\r\n\r\nWARC/1.1"),
         (6, "u", "big " * 100000), (7, "u", "same"), (7, "u", "same"), (None, "u", "same"), (None, "u", "alone")]


@pytest.fixture(scope="module")
def pages(text_spark):
    rows = [(*p, 1, "c", "k") for p in PAGES]
    return text_spark.createDataFrame(rows, "page_id long, url string, html string, row long, digest string, kind string").repartition(3)


def test_round_trip_through_the_bundles(pages):
    folder, index = warc.archive(pages, frame_bytes=1000)
    rows = warc.read_records(index).collect()
    assert sorted(str((r.record_id, r.payload_bytes, r.payload_digest)) for r in rows) == sorted(
        str((i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode())) for i, _, h in PAGES)
    same = [r for r in rows if r.payload_digest == warc.sha1_base32(b"same")]
    assert [r.record_id for r in same if r.record_type == "response"] == [7]
    assert all(r.refers_to == 7 and r.payload == b"" for r in same if r.record_type == "revisit")
    assert {r.record_id: bytes(r.payload) for r in rows if r.record_id == 5} == {5: PAGES[4][2].encode()}
    assert folder.startswith("file:")


def test_least_bytes_keeps_small_copies(pages):
    kinds = [r.record_type for r in warc.read_records(warc.archive(pages, least_bytes=5)[1]).collect()]
    assert set(kinds) == {"response"}


def test_seek_table_and_plain_decompression_agree():
    out = io.BytesIO()
    writer = warc.BundleWriter(out, frame_bytes=50)
    records = [bytes([65 + i]) * (10 + 7 * i) for i in range(12)]
    places = [writer.add(r) for r in records]
    writer.finish()
    frames = warc.seek_table(io.BytesIO(out.getvalue()), len(out.getvalue()))
    for data, (frame, offset) in zip(records, places):
        at, packed, raw = frames[frame]
        plain = zstandard.ZstdDecompressor().decompress(out.getvalue()[at : at + packed])
        assert len(plain) == raw and plain[offset : offset + len(data)] == data
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert whole == b"".join(records)


def test_no_pages(pages):
    assert warc.read_records(warc.archive(pages.where("1 = 0"))[1]).count() == 0


def test_read_back_uses_tasks_by_bytes(text_spark, monkeypatch):
    """Many frames in few bundles are read by many tasks."""
    import random

    draw = random.Random(1)
    rows = [(i, f"http://x/{i}", "".join(chr(draw.randrange(33, 126)) for _ in range(2000))) for i in range(400)]
    pages = text_spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    _, index = warc.archive(pages, frame_bytes=8000)
    monkeypatch.setattr(warc, "TASK_BYTES", 10_000)
    read = warc.read_records(index)
    tasks = read.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 20 and index.select("frame").distinct().count() > 50
    assert {r.record_id: bytes(r.payload).decode() for r in read.collect()} == {i: html for i, _, html in rows}
