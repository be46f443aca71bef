"""WARC bundles as seekable Zstandard files.

A bundle holds WARC records grouped into *independent* Zstandard frames
(about ``frame_bytes`` of records each), then a skippable frame with the seek
table of the public "Zstandard seekable format": per frame its compressed
and decompressed size, then the number of frames and the magic number. A
decompressor reads the file as a plain ``.zst``; a reader that knows the
table jumps to any frame. Writing also gives an *index*: record id -> bundle,
frame, offset inside the decompressed frame and length, so ``fetch_records``
reads single records by seeking.

Equal payloads are stored once: of the records with one payload (of at least
``min_revisit_bytes`` bytes) that with the smallest page_id is a ``response``,
the others are ``revisit`` records without payload that name it.

Writers run in the tasks of the scan. Which payloads repeat is found on their hashes
and row keys alone; that table meets the payloads where they are if it is small
(its size is counted), else by row key, on which no key is hot. Each task
attempt writes files under names of its own and only what a finished attempt
returned enters the index, so files left by lost executors are never read.
Paths are opened with ``pyarrow.fs``: any store it knows (a shared mount, S3,
GCS, HDFS).

Edge cases: null html -> empty payload (equal payloads like any other);
null url -> no target URI; null page_id -> comes first; of repeated rows one
is the response, the others revisit it; empty table -> no bundles, no rows;
other columns are ignored. A payload of any length is one record, alone in
its frame if it is longer than a frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tripstream.llm.common import BROADCAST_ROWS, row_key, written

FRAME_BYTES = 1 << 18       # decompressed bytes of records a frame
BUNDLE_BYTES = 64 << 20     # compressed bytes a bundle file
LEVEL = 3
MOST_TASKS = 100_000        # of a read; a task then reads several runs of frames

# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122, URLs
_DATE = "2024-01-01T00:00:00Z"

INDEX_SCHEMA = ("record_id string, page_id long, record_type string, bundle string, frame int, "
                "frame_offset long, length long, n_frames int")
RECORD_SCHEMA = ("record_id string, page_id long, record_type string, refers_to long, url string, "
                 "payload_bytes long, payload_digest string, content_bytes long, content_sha1 string, "
                 "bundle string, frame int, frame_offset long")


class BundleWriter:
    """Frames appended to one file; ``close`` adds the seek table."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int]] = []
        self.buffer, self.size, self.written = [], 0, 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame number and offset in that frame."""
        if self.size and self.size + len(record) > self.frame_bytes:
            self.flush()
        at = (len(self.frames), self.size)
        self.buffer.append(record)
        self.size += len(record)
        return at

    def flush(self) -> None:
        if self.size:
            data = self.compressor.compress(b"".join(self.buffer))
            self.stream.write(data)
            self.frames.append((len(data), self.size))
            self.written += len(data)
            self.buffer, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *x) for x in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.stream.close()


def seek_table(stream, size: int) -> list[tuple[int, int, int]]:
    """Per frame: place in the file, compressed and decompressed size."""
    stream.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the file")
    width = 12 if flags & 0x80 else 8
    stream.seek(size - 9 - n * width)
    data, at, out = stream.read(n * width), 0, []
    for k in range(n):
        packed, plain = struct.unpack_from("<II", data, k * width)
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(stream, entry: tuple[int, int, int]) -> bytes:
    at, packed, plain = entry
    stream.seek(at)
    return zstandard.ZstdDecompressor().decompress(stream.read(packed), max_output_size=plain)


def _uuid(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>"


def response_id(page_id, digest: str) -> str:
    return _uuid(f"response/{page_id}/{digest}")


def make_record(record_id: str, page_id, url: str | None, payload: bytes, digest: str,
                refers: int | None, is_revisit: bool) -> bytes:
    body = b"" if is_revisit else payload
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + body
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}",
            f"WARC-Record-ID: {record_id}", f"WARC-Date: {_DATE}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        # a header value is one line: white space and controls are percent-encoded
        safe = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if is_revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {response_id(refers, digest)}")
        if refers is not None:
            head.append(f"X-Refers-To-Page-Id: {refers}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """Headers (names in lower case), payload, and where the record ends."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at offset {at}")
    head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    start, size = end + 4, int(head["content-length"])
    http = data.index(b"\r\n\r\n", start) + 4
    for x in data[start:http].split(b"\r\n"):
        if x.lower().startswith(b"content-length:"):
            head["http-content-length"] = x.partition(b":")[2].strip().decode()
    return head, data[http:start + size], start + size + 4


def _row(head: dict, payload: bytes, bundle: str, frame: int, at: int) -> tuple:
    def number(name):
        return int(head[name]) if name in head else None
    return (head["warc-record-id"], number("x-page-id"), head["warc-type"], number("x-refers-to-page-id"),
            head.get("warc-target-uri"), int(head["http-content-length"]),
            head["warc-payload-digest"].partition(":")[2], len(payload),
            base64.b32encode(hashlib.sha1(payload).digest()).decode(), bundle, frame, at)


def _arrow_schema(spark_schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in spark_schema.split(","))])


def _batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def dedupe_payloads(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                    html: str = "html", min_revisit_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to, is_revisit, is_named``: which row of
    each payload is stored, by the smallest (page_id, row). Revisits name the
    record of an ``is_named`` row."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
                        row_key(pages).alias("row"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    firsts = (rows.where(F.octet_length("payload") >= min_revisit_bytes)
              .groupBy("sha").agg(F.min(F.struct("page_id", "row")).alias("first"),
                                  F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("sha", "first"))
    firsts = written(firsts, "warc-firsts")
    if firsts.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(firsts), "sha", "left")
    else:
        marks = rows.select("row", "sha").join(firsts, "sha").select("row", "first")
        joined = rows.join(written(marks, "warc-marks"), "row", "left")
    revisit = F.col("first").isNotNull() & ~F.struct("page_id", "row").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload",
                         F.when(revisit, F.col("first.page_id")).alias("refers_to"),
                         revisit.alias("is_revisit"),
                         (F.col("first").isNotNull() & ~revisit).alias("is_named"))


def write_bundles(rows: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write the records of ``dedupe_payloads`` as bundles under ``folder``; the index."""
    schema = _arrow_schema(INDEX_SCHEMA)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        stem = f"{base}/part-{task.partitionId():05d}-{task.taskAttemptId()}"
        writer, index, count, n = None, [], 0, 0

        def done():
            writer.close()
            frames = len(writer.frames)
            return _batches([(*x, frames) for x in index], schema)

        for batch in batches:
            cols = batch.columns
            for k in range(batch.num_rows):  # one payload at a time
                page, url, payload, refers, revisit, named = (c[k].as_py() for c in cols)
                if writer is None:
                    name = f"{stem}-{count:04d}.warc.zst"
                    writer, index, count = BundleWriter(
                        store.open_output_stream(name, compression=None), frame_bytes), [], count + 1
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                rid = response_id(page, digest) if named else _uuid(f"record/{name}/{n}")
                record = make_record(rid, page, url, payload, digest, refers, revisit)
                frame, offset = writer.add(record)
                index.append((rid, page, "revisit" if revisit else "response", name, frame, offset, len(record)))
                n += 1
                if writer.written >= bundle_bytes:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()

    cols = rows.select("page_id", "url", "payload", "refers_to", "is_revisit", "is_named")
    return written(cols.mapInArrow(write, INDEX_SCHEMA), "warc-index")


def read_bundles(index: DataFrame, folder: str, frames_per_task: int = 64) -> DataFrame:
    """Every record of the indexed bundles, decoded frame by frame through the
    seek tables (bundles are split into runs of frames, dealt evenly to tasks)."""
    runs = (index.groupBy("bundle").agg(F.max("n_frames").alias("n_frames"))
            .select("bundle", F.explode(F.sequence(F.lit(0), F.col("n_frames") - 1,
                                                   F.lit(frames_per_task))).alias("start")))
    runs = written(runs, "warc-runs")
    # tiny rows with much work each: an explicit number of tasks, that grows with the runs
    runs = runs.repartition(max(1, min(runs.count(), MOST_TASKS)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        schema = _arrow_schema(RECORD_SCHEMA)
        for batch in batches:
            for bundle, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                size = store.get_file_info(bundle).size
                with store.open_input_file(bundle) as f:
                    table = seek_table(f, size)
                    for k in range(start, min(start + frames_per_task, len(table))):
                        data, at, out = read_frame(f, table[k]), 0, []
                        while at < len(data):
                            head, payload, end = parse_record(data, at)
                            out.append(_row(head, payload, bundle, k, at))
                            at = end
                        yield _batches(out, schema)

    return runs.mapInArrow(read, RECORD_SCHEMA)


def fetch_records(index: DataFrame, folder: str, record_ids: DataFrame) -> DataFrame:
    """``record_id, page_id, payload`` of the given ids: only their frames are read."""
    places = index.join(record_ids.select("record_id").distinct(), "record_id").select(
        "bundle", "frame", "frame_offset", "length")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        schema = _arrow_schema("record_id string, page_id long, payload binary")
        for batch in batches:
            for bundle, frame, at, length in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(bundle) as f:
                    data = read_frame(f, seek_table(f, store.get_file_info(bundle).size)[frame])
                head, payload, end = parse_record(data, at)
                if end - at != length:
                    raise ValueError(f"{bundle}: the record at {frame}/{at} is not the indexed one")
                page = int(head["x-page-id"]) if "x-page-id" in head else None
                yield _batches([(head["warc-record-id"], page, payload)], schema)

    return places.mapInArrow(fetch, "record_id string, page_id long, payload binary")


def archive_pages(pages: DataFrame, folder: str, **options) -> DataFrame:
    """Write all pages to bundles and read them back: one row per record."""
    min_bytes = options.pop("min_revisit_bytes", 0)
    index = write_bundles(dedupe_payloads(pages, min_revisit_bytes=min_bytes), folder, **options)
    return read_bundles(index, folder)
