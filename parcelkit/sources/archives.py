"""ZIP archives of the yearly drop, read as rows without extracting to a local tree.

*Index.* Spark lists the archives (their contents are not read). Tasks read each archive's central directory by ranged
reads from its end: one row per member with its place in the archive.
*Members.* The index is dealt to tasks by member. A task seeks to its member and inflates it as a stream into bounded
batches of text lines, so neither an archive nor a member is ever held in memory, and an archive's members are read by
as many tasks as there are members.
*Nested.* ZIPs inside the GIS bundle (one level deep) are unpacked as streams into the shared checkpoint folder, where
they are archives like others.

Members whose normalised path would escape the archive root (zip-slip) are reported and not read; an archive or member
that cannot be read yields an error row instead of failing the job. Ranged reads go through Arrow's file systems; where
Arrow has none for the archives' scheme, Spark hands a task the whole archive (at most 2 GB then).
"""

from __future__ import annotations

import bz2
import fnmatch
import io
import itertools
import posixpath
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, qualified, ship_package
from .files import filesystem, openable

# --- fixed values ----------------------------------------------------------------
GIS_BUNDLE = "gis_public.zip"  # compared case-insensitively with the archive's file name
CATEGORY_ROOT = {"gis": "gis_data", "pdata": "pdata"}  # logical extraction folder per category
LOCAL_HEADER = struct.Struct("<4s2xHH16xHH")  # signature, flags, method, lengths of name and extra field
BATCH_LINES = 10000
CHUNK = 1 << 20
MAX_TASKS = 50_000

MEMBER_SCHEMA = ("archive string, category string, member string, unsafe boolean, member_bytes long, "
                 "line_no long, line string, error string")
INDEX_SCHEMA = ("archive string, category string, member string, unsafe boolean, member_bytes long, error string, "
                "path string, offset long, packed_bytes long, crc long, is_archive boolean")


_ARROW = {"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64()}


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _unsafe(name: str) -> bool:
    norm = posixpath.normpath(name.replace("\\", "/"))
    drive = len(norm) > 1 and norm[1] == ":" and norm[0].isalpha() and norm[2:3] == "/"     # "c:/..." leaves the root
    return norm.startswith("/") or norm == ".." or norm.startswith("../") or drive


def _open(path: str, content: bytes | None):
    """A seekable file over an archive: ranged reads, or the bytes that Spark has read."""
    if content is not None:
        return io.BytesIO(content)
    fs, name = filesystem(path)
    return io.BufferedReader(_Seekable(fs.open_input_file(name)), CHUNK)


def _index_rows(path: str, archive: str, category: str, bundle: bool, content: bytes | None) -> list[tuple]:
    """Tuples of ``INDEX_SCHEMA`` of one archive, from its central directory; an error row if it cannot be listed."""
    try:
        with _open(path, content) as f, zipfile.ZipFile(f) as z:
            infos = [i for i in z.infolist() if not i.is_dir()]
    except Exception as e:
        return [(archive, category, None, False, None, type(e).__name__, path, None, None, None, False)]
    return [(archive, category, i.filename, _unsafe(i.filename), i.file_size, None, path, i.header_offset, i.compress_size,
             i.CRC, bundle and i.filename.lower().endswith(".zip") and not _unsafe(i.filename)) for i in infos]


def _inflater(method: int):
    """A function from packed bytes (None: the end) to the bytes in them, in bounded parts."""
    if method == zipfile.ZIP_STORED:
        return lambda data: (data,) if data else ()
    if method == zipfile.ZIP_DEFLATED:
        machine = zlib.decompressobj(-15)

        def inflate(data):
            if data is None:
                yield machine.flush()
            while data:
                yield machine.decompress(data, 4 * CHUNK)
                data = machine.unconsumed_tail
        return inflate
    if method == zipfile.ZIP_BZIP2:
        machine = bz2.BZ2Decompressor()

        def inflate(data):
            if data:
                yield machine.decompress(data, 4 * CHUNK)
            while not (machine.needs_input or machine.eof):
                yield machine.decompress(b"", 4 * CHUNK)
        return inflate
    raise NotImplementedError(f"compression method {method}")


def _chunks(f, row: dict) -> Iterator[bytes]:
    """A member's bytes, inflated as they are read; its length and checksum are tested at the end."""
    f.seek(row["offset"])
    head = f.read(LOCAL_HEADER.size)
    if len(head) < LOCAL_HEADER.size or head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no member header")
    _, flags, method, name, extra = LOCAL_HEADER.unpack(head)
    if flags & 1:
        raise RuntimeError("encrypted member")
    f.seek(row["offset"] + LOCAL_HEADER.size + name + extra)
    inflate = _inflater(method)
    check = total = 0
    for left in itertools.chain(range(row["packed_bytes"], 0, -CHUNK), [None]):
        data = None if left is None else f.read(min(CHUNK, left))
        if left is not None and not data:
            raise EOFError("archive ends inside a member")
        for part in inflate(data):
            check, total = zlib.crc32(part, check), total + len(part)
            yield part
    if check != row["crc"] or total != row["member_bytes"]:
        raise zipfile.BadZipFile("bad checksum or length")


class _Seekable(io.RawIOBase):
    """An Arrow file as Python's own kind of file: a place before its beginning is an OSError, as zipfile expects."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = offset + (0, self.file.tell(), self.file.size())[whence]
        if place < 0:
            raise OSError("seek before the file's beginning")
        return self.file.seek(place)

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def close(self) -> None:
        self.file.close()
        super().close()


class _Stream(io.RawIOBase):
    """A raw file over chunks of bytes."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.rest = chunks, memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.rest:
            chunk = next(self.chunks, None)
            if chunk is None:
                return 0
            self.rest = memoryview(chunk)
        n = min(len(buffer), len(self.rest))
        buffer[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


def _member_rows(row: dict, content: bytes | None) -> Iterator[tuple]:
    """Tuples of ``MEMBER_SCHEMA`` of one member: its lines; one row without a line if it is empty, unsafe or an error.

    A member that fails halfway keeps the lines before the fault, and an error row.
    """
    head = (row["archive"], row["category"], row["member"], row["unsafe"], row["member_bytes"])
    if row["error"] is not None or row["unsafe"]:
        yield *head, None, None, row["error"]
        return
    try:
        with _open(row["path"], content) as f:
            text = io.TextIOWrapper(io.BufferedReader(_Stream(_chunks(f, row)), CHUNK), encoding="utf-8", errors="replace", newline=None)
            n = 0
            for n, line in enumerate(text, start=1):
                yield *head, n, line.rstrip("\n"), None
            if n == 0:
                yield *head, None, None, None
    except Exception as e:
        yield *head, None, None, type(e).__name__


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length and, but for a single long line, bounded size."""
    types = [_ARROW[c.split()[1]] for c in schema.split(", ")]
    names = _names(schema)

    def batch(some):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names)
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += 100 + (len(row[6]) if names[6] == "line" and row[6] else 0)
        if len(some) >= BATCH_LINES or size > 16 * CHUNK:
            yield batch(some)
            some, size = [], 0
    if some:
        yield batch(some)


def _records(batches) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}


def _listed(batches):
    """Archives -> index rows."""
    for r in _records(batches):
        bundle = r["archive"] == r["path"] and r["category"] == "gis"
        yield from _batches(iter(_index_rows(r["path"], r["archive"], r["category"], bundle, None)), INDEX_SCHEMA)


def _lines(batches):
    """Index rows -> the lines of their members, one member after the other."""
    for r in _records(batches):
        yield from _batches(_member_rows(r, None), MEMBER_SCHEMA)


COPY_SCHEMA = "archive string, category string, path string, error string, outer string, member string, member_bytes long"


def _unpacker(folder: str):
    """Index rows of nested ZIPs -> copies in ``folder`` (no path but an error if one cannot be unpacked)."""
    def run(batches):
        for r in _records(batches):
            target, error = f"{uuid.uuid4().hex}.zip", None
            try:
                fs, name = filesystem(folder)
                fs.create_dir(name, recursive=True)
                # published with a rename: what a lost task leaves behind is no archive that is named in the result
                with _open(r["path"], None) as f, fs.open_output_stream(f"{name}/{target}.part", compression=None) as out:
                    for chunk in _chunks(f, r):
                        out.write(chunk)
                fs.move(f"{name}/{target}.part", f"{name}/{target}")
            except Exception as e:
                error = type(e).__name__
            yield from _batches(iter([(f"{r['archive']}!{r['member']}", r["category"], None if error else f"{folder}/{target}", error,
                                       r["archive"], r["member"], r["member_bytes"])]), COPY_SCHEMA)
    return run


def _archives(spark: SparkSession, root: str, pattern: str | None) -> DataFrame:
    """The archives below ``root``; their ``content`` is read only where it is selected."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
          .option("pathGlobFilter", "*.zip").load(root))
    if pattern:
        # glob on the file name or on the path relative to root, as a JVM-side regex
        glob = fnmatch.translate(pattern)
        name = F.element_at(F.split(F.col("path"), "/"), -1)
        rel = F.regexp_replace(F.col("path"), r"^.*?/" + root.rstrip("/").split("/")[-1] + "/", "")
        df = df.where(name.rlike(glob) | rel.rlike(glob))
    gis = F.lower(F.element_at(F.split("path", "/"), -1)) == GIS_BUNDLE
    return df.select("path", F.col("path").alias("archive"), F.when(gis, "gis").otherwise("pdata").alias("category"), "content")


def _tasks(count: int) -> int:
    return max(1, min(count, MAX_TASKS))


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def archive_index(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """One row per member of every ZIP below ``root`` (columns of ``INDEX_SCHEMA``), kept in the checkpoint folder.

    Reads central directories only, but for the nested ZIPs of the GIS bundle, which are unpacked.
    """
    ship_package(spark)
    base = qualified(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}")
    archives = _archives(spark, root, pattern).drop("content")
    index = _kept(archives.repartition(_tasks(archives.count())).mapInArrow(_listed, INDEX_SCHEMA), f"{base}/index")
    nested, plain = index.where("is_archive"), index.where("not is_archive")
    count = nested.count()
    if not count:
        return plain
    copies = _kept(nested.repartition(_tasks(count)).mapInArrow(_unpacker(f"{base}/nested"), COPY_SCHEMA), f"{base}/copies")
    unpacked = copies.where("error is null").select("path", "archive", "category").repartition(_tasks(count))
    inner = _kept(unpacked.mapInArrow(_listed, INDEX_SCHEMA), f"{base}/inner")
    failed = copies.where("error is not null").select(
        F.col("outer").alias("archive"), "category", "member", F.lit(False).alias("unsafe"), "member_bytes", "error")
    return plain.unionByName(inner).unionByName(failed, allowMissingColumns=True)


def archive_scan(spark: SparkSession, root: str, pattern: str | None = None, lines: bool = True) -> DataFrame:
    """Member text lines (or only member rows with ``lines=False``) of every ZIP below ``root``.

    A file without a byte is not listed by Spark and gives no row.
    """
    first = _archives(spark, root, pattern).select("path").first()
    if first and not openable(first["path"]):
        return _whole_archives(spark, root, pattern, lines)
    index = archive_index(spark, root, pattern)
    if not lines:
        return index.select("archive", "category", "member", "unsafe", "member_bytes", F.lit(None).cast("long").alias("line_no"),
                            F.lit(None).cast("string").alias("line"), "error")
    # index rows are small, their members may not be: dealt by number, one member a task as far as tasks go
    return index.repartitionByRange(_tasks(index.count()), "path", "offset", "member").mapInArrow(_lines, MEMBER_SCHEMA)


def _whole_archives(spark: SparkSession, root: str, pattern: str | None, lines: bool) -> DataFrame:
    """The scan where only Spark can open the files: an archive a task, nested ZIPs from memory."""
    ship_package(spark)

    def rows(path, archive, category, bundle, content):
        for r in _index_rows(path, archive, category, bundle, content):
            row = dict(zip(_names(INDEX_SCHEMA), r))
            if row["is_archive"]:
                try:
                    inner = b"".join(_chunks(io.BytesIO(content), row))
                except Exception as e:
                    yield archive, category, row["member"], False, row["member_bytes"], None, None, type(e).__name__
                    continue
                yield from rows(path, f"{archive}!{row['member']}", category, False, inner)
            elif lines:
                yield from _member_rows(row, content)
            else:
                yield archive, category, row["member"], row["unsafe"], row["member_bytes"], None, None, row["error"]

    def run(batches):
        for r in _records(batches):
            yield from _batches(rows(r["path"], r["path"], r["category"], r["category"] == "gis", r["content"]), MEMBER_SCHEMA)

    return _archives(spark, root, pattern).mapInArrow(run, MEMBER_SCHEMA)


def archive_manifest(members: DataFrame) -> DataFrame:
    """Per archive: category, logical destination (category root / archive stem), extracted files, bytes,
    skipped unsafe members, error."""
    per_member = (members.groupBy("archive", "category", "member")
                  .agg(F.max("unsafe").alias("unsafe"), F.max("member_bytes").alias("member_bytes"),
                       F.max("error").alias("error")))
    ok = F.col("member").isNotNull() & ~F.coalesce(F.col("unsafe"), F.lit(False)) & F.col("error").isNull()
    roots = F.create_map(*[F.lit(x) for kv in CATEGORY_ROOT.items() for x in kv])
    stem = F.regexp_replace(F.element_at(F.split(F.col("archive"), "[/!]"), -1), r"(?i)\.zip$", "")
    return (per_member.groupBy("archive", "category").agg(
        F.count_if(ok).alias("extracted_files"),
        F.coalesce(F.sum(F.when(ok, F.col("member_bytes"))), F.lit(0)).alias("total_bytes"),
        F.count_if(F.coalesce(F.col("unsafe"), F.lit(False))).alias("skipped_members"),
        F.max("error").alias("error"))
        .withColumn("destination", F.concat_ws("/", roots[F.col("category")], stem)))


def member_table(members: DataFrame, member_name: str) -> DataFrame:
    """Lines of one member file (e.g. ``real_acct.txt``) across archives, for the text loader."""
    return (members.where(F.col("line").isNotNull()
                          & (F.element_at(F.split(F.col("member"), "/"), -1) == F.lit(member_name)))
            .select("archive", "member", "line_no", "line"))


def archive_table(members: DataFrame, table: str, columns) -> DataFrame:
    """Rows of ``<table>.txt`` members: each member's first line is its header, later lines are cells.

    The header of every member is matched to its lines with a join on
    (archive, member) — one header row per member, broadcast by size — so
    members with different column orders load correctly; absent columns are
    NULL, extra cells are dropped, as in the text scan.
    """
    lines = member_table(members, f"{table}.txt")
    headers = lines.where(F.col("line_no") == 1).select(
        "archive", "member", F.split(F.col("line"), "\t", -1).alias("_header"))
    body = lines.where(F.col("line_no") > 1).where(F.col("line") != "")
    cells = body.join(headers, ["archive", "member"], "inner").select(
        "archive", "member", "line_no",
        F.map_from_entries(F.filter(F.arrays_zip(F.col("_header").alias("k"),
                                                 F.split(F.col("line"), "\t", -1).alias("v")),
                                    lambda e: e["k"].isNotNull())).alias("_row"))
    return cells.select(*[F.col("_row").getItem(c).alias(c) for c in columns])
