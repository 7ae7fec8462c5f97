"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames. A bundle ends with a seek table in a skippable
frame, so any frame can be read alone, by zstd tools too. An index maps every record to its bundle,
frame and place within the frame. Bundles are files in the shared folder, written by the tasks; each
attempt writes under a name of its own and only the index, which Spark commits, says which files count.

A payload of at least ``MIN_REVISIT`` bytes that several pages have is stored once, with the page of
the largest id; the others get revisit records. A null html is an empty payload. A null page id is
written and read back as null and is never referred to while another id has the payload. Repeated rows
are records of their own; if their id is that of the stored page, all are responses. Only page_id, url
and html are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.shared import folder, stored

MIN_REVISIT = 1000
FRAME_BYTES = 512 * 1024
BUNDLE_BYTES = 256 * 1024 * 1024
LEVEL = 3
#: Compressed bytes that a task reads back, and tasks of one job at most.
RANGE_BYTES = 32 * 1024 * 1024
MOST_TASKS = 50_000
#: WARC-Date of every record; the input has no time of capture.
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the formats.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, bundle string, frame_offset long, frame_bytes long, record_offset long, record_bytes long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
_URN = "urn:x-page:"


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit's block holds the HTTP head only."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_URN}{'' if page is None else page}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_URN}{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class BundleWriter:
    """One bundle file; ``add`` returns nothing until a frame is closed, then its index rows."""

    def __init__(self, out) -> None:
        self.out, self.offset = out, 0
        self.frames: list[tuple[int, int]] = []
        self.coder = zstandard.ZstdCompressor(level=LEVEL)
        self.buffer, self.places = bytearray(), []

    def add(self, page: int | None, record: bytes) -> list[tuple]:
        self.places.append((page, len(self.buffer), len(record)))
        self.buffer += record
        return self.flush() if len(self.buffer) >= FRAME_BYTES else []

    def flush(self) -> list[tuple]:
        if not self.buffer:
            return []
        frame = self.coder.compress(bytes(self.buffer))
        rows = [(page, self.offset, len(frame), at, size) for page, at, size in self.places]
        self.out.write(frame)
        self.frames.append((len(frame), len(self.buffer)))
        self.offset += len(frame)
        self.buffer, self.places = bytearray(), []
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self.out.close()
        return rows


def seek_table(file) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame of an open bundle."""
    size = file.size()
    count, descriptor, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != _SEEKABLE:
        raise ValueError("the bundle has no seek table")
    width = 12 if descriptor & 0x80 else 8
    raw, out, at = file.read_at(count * width, size - 9 - count * width), [], 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", raw, i * width)
        out.append((at, packed, plain))
        at += packed
    return out


def parse(data: bytes) -> Iterator[tuple]:
    """The records of a frame as rows of RECORDS; a digest that doesn't fit raises."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        block = data[end + 4 : end + 4 + int(head["Content-Length"])]
        at = end + 4 + len(block) + 4
        http, payload = block.split(b"\r\n\r\n", 1)
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
        if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
            raise ValueError(f"record {head['WARC-Record-ID']} is damaged")
        page, refers = (x.removeprefix(f"<{_URN}").removesuffix(">") if x else "" for x in (head["WARC-Record-ID"], head.get("WARC-Refers-To")))
        yield int(page) if page else None, size, digest, kind, int(refers) if refers else None, head.get("WARC-Target-URI"), payload if kind == "response" else None


def write_bundles(pages: DataFrame, target: str | None = None) -> DataFrame:
    """Write a record for every page; returns the index, a written table."""
    spark = pages.sparkSession
    target = target or f"{folder(spark)}/warc-{uuid.uuid4().hex}"
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    large = rows.where((F.octet_length("html") >= MIN_REVISIT) & F.col("page_id").isNotNull())
    shared = large.groupBy("digest").agg(F.max("page_id").alias("stored_in"), F.count(F.lit(1)).alias("n"))
    shared = stored(shared.where("n > 1").select("digest", "stored_in"), "shared-payloads")
    rows = rows.join(shared, "digest", "left")
    rows = rows.select("page_id", "url", "html", "digest", F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("stored_in")), F.col("stored_in")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _filesystem(target)
        system.create_dir(path, recursive=True)
        writer = name = None

        def index(found: list[tuple]) -> pa.RecordBatch:
            page, *places = zip(*found, strict=True)
            columns = [pa.array(page, pa.int64()), pa.array([name] * len(page)), *(pa.array(x, pa.int64()) for x in places)]
            return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in INDEX.split(", ")])

        for batch in batches:
            found = []
            for page, url, html, digest, refers in zip(*(batch.column(i) for i in range(5)), strict=True):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(system.open_output_stream(f"{path}/{name}", compression=None))
                page_id = page.as_py()
                found += writer.add(page_id, _record(page_id, url.as_py(), html.as_buffer().to_pybytes(), digest.as_py(), refers.as_py()))
                if writer.offset >= BUNDLE_BYTES:
                    found += writer.close()
                    if found:
                        yield index(found)
                    writer, found = None, []
            if found:
                yield index(found)
        if writer is not None:
            found = writer.close()
            if found:
                yield index(found)

    written = rows.mapInArrow(write, INDEX).withColumn("bundle", F.concat(F.lit(f"{target}/"), "bundle"))
    return stored(written, "warc-index")


def _records(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), kinds, strict=True)], [x.split()[0] for x in RECORDS.split(", ")])


def read_bundles(index: DataFrame) -> DataFrame:
    """All records of the indexed bundles, frame by frame by way of their seek tables.

    A bundle is read in ranges of frames of about ``RANGE_BYTES``, each by a task of its own.
    """

    width = RANGE_BYTES

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = zstandard.ZstdDecompressor()
        for batch in batches:
            for bundle, own, ranges in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                system, path = _filesystem(bundle)
                with system.open_input_file(path) as file:
                    for at, packed, plain in seek_table(file):
                        if min(at // width, ranges - 1) != own:
                            continue
                        yield _records(list(parse(decoder.decompress(file.read_at(packed, at), max_output_size=plain))))

    bundles = index.groupBy("bundle").agg((F.floor(F.max("frame_offset") / width) + 1).alias("ranges"))
    own = F.explode(F.sequence(F.lit(0).cast("long"), F.col("ranges") - 1)).alias("own")
    ranges = stored(bundles.select("bundle", own, "ranges"), "bundle-ranges")
    return ranges.repartition(max(1, min(ranges.count(), MOST_TASKS))).mapInArrow(read, RECORDS)


def lookup(index: DataFrame, page_ids: DataFrame) -> DataFrame:
    """The records of the given pages: only their frames are read."""
    wanted = index.join(page_ids.select(F.col("page_id").cast("long").alias("page_id")).distinct(), "page_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = zstandard.ZstdDecompressor()
        last, data = None, b""
        for batch in batches:
            found = []
            for bundle, at, packed, start, size in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if last != (bundle, at):
                    system, path = _filesystem(bundle)
                    with system.open_input_file(path) as file:
                        data = decoder.decompress(file.read_at(packed, at))
                    last = (bundle, at)
                found += parse(data[start : start + size])
            if found:
                yield _records(found)

    places = wanted.select("bundle", "frame_offset", "frame_bytes", "record_offset", "record_bytes")
    tasks = max(1, min(places.select("bundle", "frame_offset").distinct().count(), MOST_TASKS))
    ordered = places.repartition(tasks, "bundle", "frame_offset").sortWithinPartitions("bundle", "frame_offset")
    return ordered.mapInArrow(read, RECORDS)


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages and read the archives back: one row per record, without the payloads."""
    return read_bundles(write_bundles(pages)).drop("payload")
