"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with whole records, and at its end a seek table (a
skippable frame of the seekable format: compressed and uncompressed size of every frame, then a footer). The
index maps every record to (bundle, frame, offset in the frame), so one record is read by one ranged read.

Every task writes its own bundles into a folder that all executors share (any file system Arrow can open); the
index is a table that Spark commits, so bundles of failed or repeated attempts are never referred to.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.llm.common import on_workers, written

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1        # fixed values of the seekable format
FRAMES_PER_TASK = 64
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    return int(name[len("<urn:x-page:"):-1]) if name and name != "<urn:x-page:>" else None


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False,
           date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit that only names it."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page_id)),
              ("WARC-Date", date), ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url:
        clean = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
        fields.append(("WARC-Target-URI", clean))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record that starts at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    begin = stop + 4
    end = begin + int(headers["Content-Length"])
    return headers, data[begin:end], end + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", c, d) for c, d in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(f) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame of an open bundle."""
    size = f.size()
    f.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    f.seek(size - 9 - 8 * count)
    raw, at, out = f.read(8 * count), 0, []
    for c, d in struct.iter_unpack("<II", raw):
        out.append((at, c, d))
        at += c
    return out


class _Bundle:
    """A bundle being written; records of a frame are held until it is full."""

    def __init__(self, folder: str, frame_bytes: int, level: int):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        self.fs, inner = pafs.FileSystem.from_uri(self.path)
        self.out = self.fs.open_output_stream(inner, compression=None)
        self.zstd, self.frame_bytes = zstandard.ZstdCompressor(level=level), frame_bytes
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.held = self.written = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in the frame)."""
        place = len(self.frames), self.held
        self.parts.append(data)
        self.held += len(data)
        if self.held >= self.frame_bytes:
            self.flush()
        return place

    def flush(self) -> None:
        if self.parts:
            raw = b"".join(self.parts)
            packed = self.zstd.compress(raw)
            self.out.write(packed)
            self.frames.append((len(packed), len(raw)))
            self.written += len(packed)
            self.parts, self.held = [], 0

    def close(self) -> None:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, frame_bytes: int = 1 << 18,
                   bundle_bytes: int = 1 << 28, level: int = 3, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write a record for every row into bundles under ``folder``; returns the index as a written table:
    ``page_id``, ``path``, ``frame``, ``offset``, ``length``.

    Rows with equal payloads of at least ``min_bytes`` bytes: the one with the smallest id is the response, the
    others are revisits of it. A null html is the empty payload; a null url gives a record without target. A
    null id is never the smallest unless all are null, and then all are responses; so are rows that repeat the
    smallest id. An empty table writes nothing. Other columns are ignored.
    """
    pafs.FileSystem.from_uri(folder)[0].create_dir(pafs.FileSystem.from_uri(folder)[1], recursive=True)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html")).withColumn("_sha", F.sha1("html"))
    firsts = written(rows.select("page_id", "_sha").groupBy("_sha").agg(F.min("page_id").alias("first")), "payloads")
    joined = rows.join(firsts, "_sha").select("page_id", "url", "html", "first")

    def run(batches):
        bundle = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                out = []
                for page_id, url, html, first in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns)):
                    if bundle is None:
                        bundle = _Bundle(folder, frame_bytes, level)
                    payload = html.encode()
                    revisit = first is not None and page_id != first and len(payload) >= min_bytes
                    data = record(page_id, url, payload, first, revisit)
                    out.append((page_id, bundle.path, *bundle.add(data), len(data)))
                    if bundle.written >= bundle_bytes:
                        bundle.close()
                        bundle = None
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 ["page_id", "path", "frame", "offset", "length"])
        if bundle:
            bundle.close()

    index = on_workers(joined).mapInArrow(run, "page_id bigint, path string, frame int, offset bigint, length bigint")
    return written(index, "index")


def read_record(path: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry: only its frame is read and decompressed."""
    fs, inner = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(inner) as f:
        at, packed, size = read_seek_table(f)[frame]
        f.seek(at)
        data = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=size)
    headers, block, _ = parse(data, offset)
    return headers, block


def read_archives(spark: SparkSession, index: DataFrame) -> DataFrame:
    """Every record of the bundles that ``index`` names, read frame by frame: ``page_id``, ``url``,
    ``record_type``, ``refers_to``, ``payload_digest``, ``payload_bytes``, ``payload`` (null for revisits).

    The digest of a response is computed from the payload that was read; one that differs from the header is an
    error. A frame is one unit of work, so a large bundle is read by many tasks.
    """
    def run(batches):
        for batch in batches:
            for path, frame in zip(*(c.to_pylist() for c in batch.columns)):
                fs, inner = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(inner) as f:
                    at, packed, size = read_seek_table(f)[frame]
                    f.seek(at)
                    data = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=size)
                out, place = [], 0
                while place < len(data):
                    headers, block, place = parse(data, place)
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size_of = int(http.rsplit(b"Content-Length: ", 1)[1])
                    revisit = headers["WARC-Type"] == "revisit"
                    if not revisit and (len(payload) != size_of or payload_digest(payload) != digest):
                        raise ValueError(f"damaged record {headers['WARC-Record-ID']} in {path}")
                    out.append((_page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"),
                                headers["WARC-Type"], _page(headers.get("WARC-Refers-To")), digest, size_of,
                                None if revisit else payload))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    schema = ("page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, "
              "payload_bytes bigint, payload binary")
    frames = index.select("path", "frame").distinct()
    tasks = max(1, -(-frames.count() // FRAMES_PER_TASK))       # a task has few rows, but much to read
    return on_workers(frames).repartition(tasks, "path", "frame").mapInArrow(run, schema)
