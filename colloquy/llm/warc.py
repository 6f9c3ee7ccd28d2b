"""Operator 5: WARC records in seekable Zstandard bundles."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import stored
from colloquy.session import scratch_path

FRAME_BYTES = 1 << 20  # records of a frame, before compression
BUNDLE_BYTES = 128 << 20  # a bundle is closed after this many
LEVEL = 3
REVISIT_BYTES = 100  # smaller payloads are always written in full

# The seek table of the seekable Zstandard format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(kind: str, page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has no block and says which record has its payload."""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{url}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: text/html; charset=utf-8",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url:
        head.append("WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"))
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    block = b"" if kind == "revisit" else payload
    head.append(f"X-Payload-Length: {len(payload)}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block, and where the next record starts."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, data[start:stop], stop + 4


class BundleWriter:
    """Independent frames one after the other, closed by a table of their sizes."""

    def __init__(self, out):
        self.out, self.sizes, self.frame, self.at = out, [], bytearray(), 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, data: bytes) -> tuple[int, int]:
        """Write a record; its frame and its offset inside the frame."""
        if self.frame and len(self.frame) + len(data) > FRAME_BYTES:
            self.flush()
        place = len(self.sizes), len(self.frame)
        self.frame += data
        return place

    def flush(self) -> None:
        packed = self.compressor.compress(bytes(self.frame))
        self.out.write(packed)
        self.sizes.append((len(packed), len(self.frame)))
        self.at += len(packed)
        self.frame.clear()

    def close(self) -> None:
        if self.frame:
            self.flush()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.out.close()


class BundleReader:
    """Reads single frames of a bundle through its seek table."""

    def __init__(self, file):
        self.file, size = file, file.size()
        frames, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("not a seekable bundle")
        width = 12 if flags & 0x80 else 8
        table = self._read(size - 9 - width * frames, width * frames)
        self.frames, at = [], 0
        for i in range(frames):
            packed, plain = struct.unpack_from("<II", table, width * i)
            self.frames.append((at, packed, plain))
            at += packed
        self.number, self.plain = -1, b""

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def frame(self, number: int) -> bytes:
        if number != self.number:
            at, packed, plain = self.frames[number]
            data = self._read(at, packed)
            self.number, self.plain = number, zstandard.ZstdDecompressor().decompress(data, max_output_size=plain)
        return self.plain


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def originals(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``(digest, first)``: the smallest page id of every payload that several records have."""
    some = pages.filter((F.col("bytes") >= least_bytes) & F.col("page_id").isNotNull())
    groups = some.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return groups.filter(F.col("n") > 1).select("digest", "first")


def write_archive(pages: DataFrame, folder: str, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` and return the index of the records.

    Index: ``page_id, bundle, frame, offset``; the offset counts bytes of the
    uncompressed frame. Of records with equal payloads of ``REVISIT_BYTES`` or more
    the one with the smallest page id holds the payload, the others revisit it. The
    payloads are not shuffled but for the join with that decision. Every task writes
    bundles of its own under a name of its own, so a retried task leaves at most an
    unused file behind: the index names only the files of the attempt that counted.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    source = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    digest = F.sha2(F.col("html"), 256).alias("digest")
    sized = source.select("page_id", digest, F.octet_length("html").alias("bytes"))
    sized = stored(sized, "digests")
    firsts = stored(originals(sized), "originals")
    # Null unless the payload is another page's. One row per page id.
    moved = sized.filter(F.col("bytes") >= REVISIT_BYTES).select("page_id", "digest").distinct()
    moved = moved.join(firsts, "digest").filter(F.col("page_id") != F.col("first"))
    moved = stored(moved.select("page_id", "digest", "first"), "revisits")
    judged = source.withColumn("digest", digest).join(moved, ["page_id", "digest"], "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        system.create_dir(root, recursive=True)
        writer, path, written = None, "", 0
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                page_id, url, text, digest, first = (batch.column(c)[i].as_py() for c in range(5))
                payload = text.encode("utf-8", "surrogatepass")
                if writer is None:
                    path, written = f"{root}/{uuid.uuid4().hex}.warc.zst", 0
                    writer = BundleWriter(system.open_output_stream(path, compression=None))
                kind = "response" if first is None else "revisit"
                data = record(kind, page_id, url, digest, payload, first)
                rows.append((page_id, path, *writer.add(data)))
                written += len(data)
                if written >= bundle_bytes:
                    writer.close()
                    writer = None
            columns = list(zip(*rows)) or [()] * 4
            types = [pa.int64(), pa.string(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["page_id", "bundle", "frame", "offset"]
            )
        if writer is not None:
            writer.close()

    ordered = judged.select("page_id", "url", "html", "digest", "first")
    index = ordered.mapInArrow(write, "page_id bigint, bundle string, frame int, offset bigint")
    return stored(index, "warc-index")


def read_archive(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` names, each found by frame and offset.

    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``; of
    responses, length and digest are those of the bytes read back, of revisits
    those that the record declares.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _filesystem(folder)
        path, reader = None, None
        for batch in batches:
            rows = []
            for page_id, bundle, frame, offset in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle != path:
                    path, reader = bundle, BundleReader(system.open_input_file(bundle))
                headers, block, _ = parse_record(reader.frame(frame), offset)
                if str(page_id) != headers.get("X-Page-Id", "None"):
                    raise ValueError(f"{bundle}: frame {frame}, offset {offset} is not page {page_id}")
                kind, refers = headers["WARC-Type"], headers.get("X-Refers-To-Page-Id")
                declared = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                digest = hashlib.sha256(block).hexdigest() if kind == "response" else declared
                if digest != declared:
                    raise ValueError(f"{bundle}: page {page_id} does not have its digest")
                size = len(block) if kind == "response" else int(headers["X-Payload-Length"])
                rows.append((page_id, size, digest, kind, None if refers is None else int(refers)))
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    by_place = index.repartition("bundle").sortWithinPartitions("bundle", "frame", "offset")
    return by_place.mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as bundles to the shared scratch folder and read every record back.

    Null html: an empty payload. Null ids: written as responses, never revisited.
    Rows that repeat an id with the same payload are all responses or all revisits,
    as their id is. Null urls: records without a target. No rows: no rows. Other
    columns are ignored.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archive(write_archive(pages, folder), folder)
