r"""WARC records in seekable Zstandard bundles.

Each task writes one bundle file. Records are grouped into *frames* of about
``frame_bytes``; a frame is compressed on its own, so any of them can be read
without the others. The file ends with a seek table in a skippable frame, in the
public seekable format: per frame its compressed and its raw size, then the
number of frames, a flag byte and a magic number. The *index*, a written table,
maps every record id to bundle, frame and offset within the raw frame.

Equal payloads of at least ``least_bytes`` are stored once: the record with the
largest id is the response, the others become revisit records that name it and
carry its digest and the payload's length. Which record is which is settled by
one aggregation on (digest, length), which moves ids and digests only and combines
in each task first; payloads move once, in the join with its result.

*Reading back* deals out frames, not files, to as many tasks as their bytes ask for:
a task seeks to its frames, decompresses each once, and cuts the records that the index names.

A bundle appears under its name only when it is complete, and its name holds the
task attempt that wrote it. The index names the attempts whose index rows were
committed, so a lost or repeated task leaves at most a bundle that nothing
refers to. Bundles lie in the folder named by ``spark.checkpoint.dir``.

Defined cases: a null payload is empty; a null id is written as an empty id and
compared as the smallest; a very long payload is a frame of its own and passes whole; of equal payloads with the same largest id, one record is the response
and the others revisit it; an empty table writes no bundle and gives an empty
result; further columns are ignored.
"""

import base64
import hashlib
import struct
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from basketstream.llm.common import batch_of, filesystem, put_file, shared_folder, write_once

FRAME_BYTES = 1 << 20
LEVEL = 3
TASK_BYTES = 32 << 20  # compressed bytes that a task reads back
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # fixed values of the seekable Zstandard format
DATE = datetime(2024, 1, 1, tzinfo=timezone.utc)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(row_id, record_id, url, kind, digest, length, payload, refers_to, date=DATE) -> bytes:
    """One WARC 1.1 record. A revisit has an empty block."""
    head = [
        b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <urn:record:%d>" % row_id,
        b"WARC-Date: " + date.strftime("%Y-%m-%dT%H:%M:%SZ").encode(),
        b"WARC-Target-URI: " + " ".join((url or "").split()).encode(), b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"X-Source-ID: " + (b"" if record_id is None else b"%d" % record_id), b"X-Payload-Length: %d" % length,
    ]
    if kind == "revisit":
        head.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(b"X-Refers-To-Source-ID: " + (b"" if refers_to is None else b"%d" % refers_to))
        payload = b""
    head += [b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload)]
    return b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes, at: int):
    """(headers, block) of the record that starts at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("no record starts here")
    headers = dict(line.split(b": ", 1) if b": " in line else (line.rstrip(b":"), b"") for line in lines[1:])
    start = end + 4
    return headers, data[start : start + int(headers[b"Content-Length"])]


class BundleWriter:
    """Frames and seek table of one bundle, written to a stream."""

    def __init__(self, stream, frame_bytes=FRAME_BYTES, level=LEVEL):
        import zstandard

        self.stream, self.most, self.compress = stream, frame_bytes, zstandard.ZstdCompressor(level=level).compress
        self.frame, self.held, self.at, self.sizes = [], 0, 0, []

    def add(self, data: bytes):
        """Append a record; gives (frame number, offset within the raw frame)."""
        if self.held and self.held + len(data) > self.most:
            self.close_frame()
        place = len(self.sizes), self.held
        self.frame.append(data)
        self.held += len(data)
        return place

    def close_frame(self):
        packed = self.compress(b"".join(self.frame))
        self.stream.write(packed)
        self.sizes.append((len(packed), self.held))
        self.at += len(packed)
        self.frame, self.held = [], 0

    def finish(self):
        if self.held:
            self.close_frame()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)


def seek_table(stream, size: int):
    """[(offset in the file, compressed size, raw size)] of a bundle, from its end."""
    stream.seek(size - 9)
    frames, _, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    stream.seek(size - 9 - 8 * frames)
    data, at, out = stream.read(8 * frames), 0, []
    for packed, raw in struct.iter_unpack("<II", data):
        out.append((at, packed, raw))
        at += packed
    return out


def classify(pages: DataFrame, id_column="page_id", url_column="url", payload_column="html", least_bytes=0) -> DataFrame:
    """row, record_id, url, digest, length, payload, kind, refers_to of every row of ``pages``."""
    fields = pa.schema([("record_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("row", pa.int64()),
                        ("digest", pa.string()), ("length", pa.int64())])

    def number(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            payloads = [p or b"" for p in batch.column("payload").to_pylist()]
            yield batch_of(fields, (batch.column("record_id"), batch.column("url"), payloads, range(row, row + len(payloads)),
                                    [sha1_base32(p) for p in payloads], [len(p) for p in payloads]))
            row += len(payloads)

    rows = write_once(pages.select(
        F.col(id_column).cast("long").alias("record_id"), F.col(url_column).alias("url"),
        F.col(payload_column).cast("binary").alias("payload"),
    ).mapInArrow(number, "record_id long, url string, payload binary, row long, digest string, length long"), "warc-rows", "zstd")
    least = F.struct(F.coalesce("record_id", F.lit(-(1 << 63))), "row")
    owners = rows.where(F.col("length") >= least_bytes).groupBy("digest", "length").agg(
        F.max_by(F.struct("record_id", "row"), least).alias("owner"), F.count("*").alias("copies")).where("copies > 1")
    # Only rows whose payload occurs more than once meet the owners; a very common payload is split by the join.
    return rows.join(owners, ["digest", "length"], "left").select(
        "row", "record_id", "url", "digest", "length", "payload",
        F.when(F.col("owner.row") != F.col("row"), "revisit").otherwise("response").alias("kind"),
        F.when(F.col("owner.row") != F.col("row"), F.col("owner.record_id")).alias("refers_to"))


INDEX_TYPE = "row long, record_id long, bundle string, frame long, frame_at long, frame_bytes long, offset long"
INDEX = pa.schema([(p.split()[0], pa.string() if p.endswith("string") else pa.int64()) for p in INDEX_TYPE.split(", ")])


def write_bundles(records: DataFrame, folder: str, frame_bytes=FRAME_BYTES, level=LEVEL) -> DataFrame:
    """Writes the classified records below ``folder``, one bundle per task; gives the written index."""

    def write(batches):
        batches = iter(batches)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        task = TaskContext.get()
        uri, places, frames = f"{folder}/bundle-{task.partitionId():07d}-{task.taskAttemptId()}.warc.zst", [], []

        def fill(stream):
            writer = BundleWriter(stream, frame_bytes, level)
            for batch in _and(first, batches):
                for r in _rows(batch):
                    data = record(r["row"], r["record_id"], r["url"], r["kind"], r["digest"], r["length"], r["payload"], r["refers_to"])
                    places.append((r["row"], r["record_id"], *writer.add(data)))
            writer.finish()
            at = 0
            for packed, _ in writer.sizes:
                frames.append((at, packed))
                at += packed

        put_file(uri, fill)
        for start in range(0, len(places), 8192):
            yield batch_of(INDEX, zip(*((row, rid, uri, frame, *frames[frame], offset)
                                        for row, rid, frame, offset in places[start : start + 8192])))

    return write_once(records.mapInArrow(write, INDEX_TYPE), "warc-index")


def _rows(batch: pa.RecordBatch, step: int = 16):
    """Rows of a batch as dictionaries, a few at a time, as payloads can be long."""
    for at in range(0, batch.num_rows, step):
        yield from batch.slice(at, step).to_pylist()


def _and(first, rest):
    yield first
    yield from rest


RECORD_TYPE = "row long, record_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"
RECORD = pa.schema([("row", pa.int64()), ("record_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                    ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_records(index: DataFrame) -> DataFrame:
    """Seeks and reads every record that ``index`` names. A response's digest and length come from the payload read."""

    def number(value):
        return int(value) if value else None

    def read(batches):
        import zstandard

        unpack, uri, stream, at, data, out, held = zstandard.ZstdDecompressor(), None, None, None, b"", [], 0
        try:
            for batch in batches:
                for r in batch.to_pylist():
                    if r["bundle"] != uri:
                        if stream:
                            stream.close()
                        uri, at = r["bundle"], None
                        files, path = filesystem(uri)
                        stream = files.open_input_file(path)
                    if r["frame_at"] != at:
                        at = r["frame_at"]
                        stream.seek(at)
                        data = unpack.decompress(stream.read(r["frame_bytes"]))
                    headers, block = parse(data, r["offset"])
                    kind = headers[b"WARC-Type"].decode()
                    if kind == "response":
                        digest, length = sha1_base32(block), len(block)
                    else:
                        digest, length = headers[b"WARC-Payload-Digest"].decode()[5:], int(headers[b"X-Payload-Length"])
                    if f"sha1:{digest}".encode() != headers[b"WARC-Payload-Digest"]:
                        raise ValueError(f"damaged record {r['row']} in {uri}")
                    out.append((r["row"], number(headers[b"X-Source-ID"]), kind, digest, length,
                                number(headers.get(b"X-Refers-To-Source-ID")), block))
                    held += len(block)
                    if held > 1 << 25 or len(out) >= 4096:
                        yield batch_of(RECORD, zip(*out))
                        out, held = [], 0
            if out:
                yield batch_of(RECORD, zip(*out))
        finally:
            if stream:
                stream.close()

    # Whole frames go to one task each, in the order of the file. The index has few bytes, so tasks are counted by what they will read.
    frames = index.groupBy("bundle", "frame").agg(F.first("frame_bytes").alias("bytes"))
    total = frames.agg(F.sum("bytes")).first()[0] or 0
    parts = max(-(-total // TASK_BYTES), index.sparkSession.sparkContext.defaultParallelism)
    dealt = index.repartition(parts, "bundle", "frame").sortWithinPartitions("bundle", "frame_at", "offset")
    return dealt.mapInArrow(read, RECORD_TYPE)


def archive(pages: DataFrame, id_column="page_id", url_column="url", payload_column="html", least_bytes=0, frame_bytes=FRAME_BYTES):
    """Writes ``pages`` as bundles in the shared folder; gives (folder, index)."""
    folder = shared_folder(pages.sparkSession, "warc")
    return folder, write_bundles(classify(pages, id_column, url_column, payload_column, least_bytes), folder, frame_bytes)
