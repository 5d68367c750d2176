"""Tab-separated yearly text files -> all-string DataFrames.

``spark.read.csv`` with a header row and quoting switched off reads the files
splittably, a line as one value that is then split at its tabs: short rows are
NULL-padded, extra cells dropped, blank lines skipped, CRLF endings and stray
quotes kept literally, invalid UTF-8 replaced. Part files may be compressed (``.gz``, ``.bz2``); a ``.gz`` one is read
by one task. Files are found recursively by base name, their headers by one distributed job. Each row can carry a hidden ``_row_order`` (file, split start
and position as one number) so key clean-up can keep the *first* row in file
order even when a file is split across tasks.
"""

from __future__ import annotations

import re
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.integrity import ORDER_COL
from ..session import ship_package
from .files import filesystem, openable

# --- fixed values: whitespace stripped around each cell (Unicode's White_Space) -----------
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                                0x205F, 0x3000]))
_EDGES = "[" + "".join(c for c in WHITE_SPACE if c not in "\t\n\r") + "]"
CELL_EDGES = rf"(?<!{_EDGES}){_EDGES}++(?=\t|\z)|(?:\A|(?<=\t)){_EDGES}++"     # white space around the cells of a line
JAVA_BLANK = "".join(map(chr, range(0x21)))     # a line of these alone is blank to the text reader
LINE_END = re.compile(rb"\r\n|\r|\n")
HEADER_BYTES = 1 << 16
BROADCAST_FILES = 50_000                        # files whose places (some 100 bytes each) are broadcast
ROW_BITS = 33                                   # of the row number in monotonically_increasing_id
ROW_BITS_MASK = (1 << ROW_BITS) - 1
COMPRESSED = {".gz": "gzip", ".bz2": "bz2"}     # endings of part files that Spark and Arrow unpack alike
WHOLE = ".gz"                                   # of those, files that are not split


def clean_cell(col) -> Column:
    """strip surrounding whitespace -> delete NUL characters -> ``''`` becomes NULL (this order)."""
    c = F.col(col) if isinstance(col, str) else col
    stripped = F.btrim(c, F.lit(WHITE_SPACE))
    no_nul = F.replace(stripped, F.char(F.lit(0)), F.lit(""))
    return F.nullif(no_nul, F.lit(""))


def clean_cells(df: DataFrame, cols=None) -> DataFrame:
    """Apply :func:`clean_cell` to every string column (or ``cols``).

    Idempotent except where a NUL sits next to edge whitespace (``'1 \\x00'`` -> ``'1 '``):
    the source strips before it deletes NULs, and that order is kept.
    """
    names = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: clean_cell(c) for c in names})


def _reader(spark: SparkSession):
    """Reader of whole lines: a line never holds the separator."""
    return (spark.read.schema("__line string").option("sep", "\n").option("header", True).option("quote", "")
            .option("escape", "").option("inferSchema", False).option("mode", "PERMISSIVE")
            .option("encoding", "UTF-8").option("recursiveFileLookup", True))


def _with_cells(lines: DataFrame, limit: int, clean: bool) -> DataFrame:
    """``__line`` split into ``__cells`` (the first ``limit - 1`` and the rest; -1: all), and ``__odd``: whether it may
    have other white space than blanks and tabs, or NUL characters. ``clean``: such lines are stripped and rid of NULs
    as a whole, so that the cells of the others need only their blanks trimmed."""
    line = F.col("__line")
    odd = F.octet_length(line) != F.length(line)
    for c in "\0\x0b\x0c":
        odd = odd | F.contains(line, F.lit(c))
    if clean:
        line = F.when(odd, F.replace(F.regexp_replace(line, CELL_EDGES, ""), F.char(F.lit(0)), F.lit(""))).otherwise(line)
    return lines.withColumns({"__cells": F.split(line, "\t", limit), "__odd": odd}).drop("__line")


def _cell(i: int, clean: bool) -> Column:
    """Cell ``i`` of :func:`_with_cells`; NULL if empty or absent. ``clean``: as by :func:`clean_cell`."""
    c = F.get("__cells", F.lit(i))
    return F.nullif(F.when(F.col("__odd"), c).otherwise(F.btrim(c)) if clean else c, F.lit(""))


def find_table_files(spark: SparkSession, root: str) -> tuple[dict[str, list[str]], dict[str, str]]:
    """Data files of every table below ``root``, and the tables that cannot be read, with the reason.

    A table is a single ``<table>.txt``, or the ``part-*`` files of a folder named ``<table>`` (written by a
    distributed job). A listing, no data read; names of other files do not reach the driver.
    """
    name = F.element_at(F.split("path", "/"), -1)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
             .where(name.rlike(r"^part-|^[^_.].*[.]txt$")))
    singles: dict[str, list[str]] = {}
    parts: dict[str, list[str]] = {}
    for path in sorted(r["path"] for r in files.collect()):
        folder, base = path.rsplit("/", 2)[-2:]
        if base.startswith("part-"):
            parts.setdefault(folder, []).append(path)
        else:
            singles.setdefault(base[:-4], []).append(path)
    clashes = {t: f"more than one file named {t}.txt: {', '.join(p[:3])}" for t, p in singles.items() if len(p) > 1}
    clashes |= {t: f"both {t}.txt and a folder of part files" for t in singles.keys() & parts.keys()}
    return {t: p for t, p in {**singles, **parts}.items() if t not in clashes}, clashes


def _compression(path: str) -> str | None:
    return next((how for ending, how in COMPRESSED.items() if path.endswith(ending)), None)


def _first_line(path: str) -> str | None:
    """The first line of a file that is not blank (its header); None if there is none."""
    fs, name = filesystem(path)
    with fs.open_input_stream(name, compression=_compression(path)) as f:
        rest = b""
        while True:
            data = f.read(HEADER_BYTES)
            lines = LINE_END.split(rest + data)
            rest = lines.pop() if data else b""
            for line in lines:
                text = line.decode("utf-8", "replace")
                if text.strip(JAVA_BLANK):
                    return text
            if not data:
                return None


def _first_lines_by_driver(spark: SparkSession, paths: list[str]) -> dict[str, str | None]:
    """The headers where only Spark's file systems open the files: one after the other, on the driver."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    out = {}
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        stream = p.getFileSystem(conf).open(p)
        if _compression(path):
            stream = codecs.getCodec(p).createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip(JAVA_BLANK):
            line = reader.readLine()
        reader.close()
        out[path] = line
    return out


class TableFiles:
    """A table's files: groups of equal headers, files without a header, each file's place in the file order, the length
    of the longest that may be split, the length of all."""

    def __init__(self, groups: dict[str, list[str]], blank: list[str], places: list[tuple[str, int]], longest: int, size: int):
        self.groups, self.blank, self.places, self.longest, self.size = groups, blank, places, longest, size


def table_files(spark: SparkSession, tables: dict[str, list[str]]) -> dict[str, TableFiles]:
    """Headers of all files of some tables, found by one job; the driver gets each header once, with its files.

    Blank lines before a header are skipped. Places follow the sorted paths.
    """
    paths = sorted({p for own in tables.values() for p in own})
    if not paths:
        return {}
    by_header: dict[str | None, list] = {}
    listed = spark.read.format("binaryFile").load([_glob_quoted(p) for p in paths]).select(
        "path", F.col("_metadata.file_path").alias("name"), "length")
    if all(openable(p) for p in paths):
        def run(batches):
            for batch in batches:
                lines = [_first_line(p) for p in batch.column("path").to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines, pa.string())], [*batch.schema.names, "header"])

        ship_package(spark)
        tasks = max(1, min(len(paths), spark.sparkContext.defaultParallelism * 4))
        found = listed.repartition(tasks).mapInArrow(run, "path string, name string, length long, header string")
        for r in found.groupBy("header").agg(F.collect_list(F.struct("path", "name", "length")).alias("files")).collect():
            by_header[r["header"]] = r["files"]
    else:
        lines = _first_lines_by_driver(spark, paths)
        for r in listed.collect():
            by_header.setdefault(lines[r["path"]], []).append(r)
    header = {f["path"]: line for line, files in by_header.items() for f in files}
    known = {f["path"]: f for files in by_header.values() for f in files}
    out = {}
    for table, own in tables.items():
        own = sorted(p for p in own if p in known)          # Spark lists no file without bytes
        groups: dict[str, list[str]] = {}
        for p in own:
            if header[p] is not None:
                groups.setdefault(header[p], []).append(p)
        out[table] = TableFiles(groups, [p for p in own if header[p] is None], [(known[p]["name"], k) for k, p in enumerate(own)],
                                max((known[p]["length"] for p in own if not p.endswith(WHOLE)), default=0),
                                sum(known[p]["length"] for p in own))
    return out


def _glob_quoted(path: str) -> str:
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def header_names(line: str) -> list[str]:
    """Column names of a header: an empty one is called by its place, repeated ones (whatever their case) too."""
    cells = line.split("\t")
    low = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if low.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def _row_order(spark: SparkSession, scan: DataFrame, files: TableFiles) -> DataFrame:
    """``scan`` with ``_row_order``: the row's place in file order as one number of fixed width, so that the first of
    some rows is a hash aggregate. From the left: file, start of its split, row of the task (which reads a split's
    rows in order). A long where the files' number and size allow it, else a decimal."""
    conf = spark._jsparkSession.sessionState().conf()
    task = conf.filesMaxPartitionBytes()
    # splits begin apart by this many bits at least; a row has a byte at least, unless it is compressed
    apart = min(12, min(task, max(conf.filesOpenCostInBytes(), 1)).bit_length() - 1)
    row_bits = ROW_BITS if any(_compression(name) for name, _ in files.places) else task.bit_length() + 1
    start_bits = (files.longest >> apart).bit_length()
    start, row = F.col("__start"), F.col("__row")
    scan = scan.withColumns({"__start": F.shiftright(F.col("_metadata.file_block_start"), apart),
                             "__row": F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS_MASK))})
    file = F.lit(0).cast("long")
    if len(files.places) > 1:
        places = spark.createDataFrame(files.places, "__name string, __file long")
        # a row a file: broadcast while that is known to be small, so that the scan is not shuffled by its files
        places = F.broadcast(places) if len(files.places) <= BROADCAST_FILES else places
        scan = scan.withColumn("__name", F.col("_metadata.file_path")).join(places, "__name").drop("__name")
        file = F.col("__file")
    if len(files.places).bit_length() + start_bits + row_bits <= 63:
        number = F.shiftleft(file, start_bits + row_bits) + F.shiftleft(start, row_bits) + row
    else:
        number = (file.cast("decimal(10,0)") * F.lit(Decimal(1 << 76)) + start.cast("decimal(15,0)") * F.lit(Decimal(1 << 33))
                  + row.cast("decimal(11,0)")).cast("decimal(38,0)")
    return scan.withColumn(ORDER_COL, number).drop("__start", "__row", "__file")


def raw_scan(spark: SparkSession, root: str, table: str, paths: list[str] | None = None,
             ordered: bool = False, files: TableFiles | None = None, clean: bool = False, only=None) -> DataFrame:
    """The table's text file(s) as strings with the header as column names (``ordered``: and ``_row_order``).

    ``clean``: the cells cleaned as by :func:`clean_cells`; lines of plain text need only their blanks trimmed.
    ``only``: just these columns, where the header has them; lines are not split beyond the last.

    Part files with different headers are scanned apart and united by column name; files without a header have no rows.
    """
    if files is None:
        if paths is None:
            found, clashes = find_table_files(spark, root)
            if table in clashes:
                raise ValueError(clashes[table])
            paths = found.get(table)
            if not paths:
                raise FileNotFoundError(f"no data file for table {table} under {root}")
        files = table_files(spark, {table: paths})[table]

    def scan(header: str, own: list[str]) -> DataFrame:
        cells = [(i, c) for i, c in enumerate(header_names(header)) if only is None or c in only]
        lines = _reader(spark).csv([_glob_quoted(p) for p in own])
        limit = -1 if only is None else max((i for i, _ in cells), default=0) + 2
        df = _with_cells(lines, limit, clean)
        df = _row_order(spark, df, files) if ordered else df
        return df.select(*[_cell(i, clean).alias(c) for i, c in cells], *([ORDER_COL] if ordered else []))

    if not files.groups:
        empty = spark.createDataFrame([], T.StructType([]))
        return empty.withColumn(ORDER_COL, F.lit(None).cast("decimal(38,0)")) if ordered else empty
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [scan(h, own) for h, own in files.groups.items()])


def project_to_schema(df: DataFrame, columns) -> tuple[DataFrame, list[str]]:
    """Keep the schema's columns in schema order, NULL-fill absent ones; return unexpected header names."""
    have = {c: c for c in df.columns}
    cols = []
    for c in columns:
        cols.append(F.col(f"`{have[c]}`").alias(c) if c in have else F.lit(None).cast("string").alias(c))
    known = set(columns) | {ORDER_COL}
    unexpected = [c for c in df.columns if c not in known]
    return df.select(*cols, *([F.col(ORDER_COL)] if ORDER_COL in df.columns else [])), unexpected


def tsv_scan(spark: SparkSession, root: str, table: str, columns=None, clean: bool = True,
             paths: list[str] | None = None, raw: DataFrame | None = None) -> DataFrame:
    """Scan one table's text file(s): header-driven projection onto ``columns`` plus ``_row_order``.

    With ``columns=None`` the header's columns are kept as they are. ``raw`` reuses a
    :func:`raw_scan` of the same files with ``ordered=True`` (its header was already read; ``clean=False`` if it is clean).
    """
    if raw is None:
        df, clean = raw_scan(spark, root, table, paths, ordered=True, clean=clean, only=columns), False
    else:
        df = raw
    if columns is not None:
        df, _ = project_to_schema(df, list(columns))
    if clean:
        df = clean_cells(df, [c for c in df.columns if c != ORDER_COL])
    return df


def missing_key_columns(spark: SparkSession, root: str, table: str, pk, paths: list[str] | None = None) -> list[str]:
    """Primary-key columns absent from the file's header (the whole table is quarantined then)."""
    header = raw_scan(spark, root, table, paths).columns
    return [k for k in pk if k not in header]
