"""Full refresh of the yearly tables: text -> cleaned, key-enforced Parquet.

Per table (parents before children so orphan rejection cascades):

    scan of the key columns -> drop_null_keys -> keep the first row of a key
      -> reject_orphans(parent written before) -> a bit for each row that is kept
    tsv_scan -> header projection onto the codebook -> clean_cells
      -> rows whose bit is set -> write Parquet

The headers of all files are read by one job. Which rows are kept depends on
keys alone, so only keys and row numbers are shuffled, of large tables one at a
time; the bits are broadcast to the scan of whole rows. Shuffle files are removed
as each job ends: a table's stay on disk no longer than its keys are dealt.

Counts of every stage are collected with ``DataFrame.observe`` during the
two jobs of a table (no extra passes). Children read their parent's key set back
from the written Parquet, which cuts the lineage and keeps a failed executor
from recomputing the parent.
"""

from __future__ import annotations

import os
import uuid
from contextlib import nullcontext

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import KEYS, KeySpec, load_levels, parents_first
from ..operators import integrity as I
from ..session import FREE_SHUFFLES, ensure_checkpoint_dir, path_exists, settings
from ..sources.codebook import read_codebook
from ..sources.tsv import TableFiles, find_table_files, project_to_schema, raw_scan, table_files, tsv_scan

REPORT_SCHEMA = ("table_name string, status string, rows_read bigint, null_key_rows bigint, duplicate_rows bigint, "
                 "orphan_rows bigint, rows_kept bigint, unexpected_columns string, missing_key_columns string, "
                 "over_length_columns string")

# --- fixed values ---------------------------------------------------------------
IN_TURN = 1 << 25   # bytes of the files of a table whose keys are not dealt while another such table's are
SPLITS = "spark.sql.files.minPartitionNum"
CODEC = "zstd"      # of the tables written
PATIENT = {"spark.sql.broadcastTimeout": "86400"}   # seconds: marks may wait for the tasks of other tables


def mark_kept(spark: SparkSession, root: str, table: str, spec: KeySpec, parents: dict[str, DataFrame], files: TableFiles,
              path: str) -> dict[str, int]:
    """Find the rows of a table to keep from its keys alone and write their marks to ``path``.

    Returns the number of rows with a key (``keyed``), of keys (``unique``), of rows to keep (``kept``), of ``blocks``.
    """
    pk = list(spec.primary_key)
    fks = [fk for fk in spec.single_column_fks if fk[1] in parents and fk[1] != table]
    names = list(dict.fromkeys([*pk, *(c for fk in fks for c in fk[0])]))
    raw = raw_scan(spark, root, table, ordered=True, files=files, clean=True, only=names)
    watch = _Watch(table)
    keys = I.drop_null_keys(tsv_scan(spark, root, table, names, clean=False, raw=raw), pk)
    rows = watch("unique", I.first_rows(watch("keyed", keys), pk))
    for child_cols, parent, parent_cols in fks:
        rows = I.reject_orphans(rows, parents[parent], child_cols, parent_cols, null_keys=not set(child_cols) <= set(pk))
    watch("marks", I.row_marks(rows), F.sum("_n").alias("kept")).write.mode("overwrite").parquet(path)
    marks = watch.seen("marks")
    return {"keyed": watch.seen("keyed")["n"], "unique": watch.seen("unique")["n"], "kept": marks["kept"] or 0, "blocks": marks["n"]}


class _Watch:
    """Counts rows (and other aggregates) of some stages of a table while a job runs over them."""

    def __init__(self, table: str):
        self.name, self.stages = f"{table}_{uuid.uuid4().hex[:12]}", {}

    def __call__(self, stage: str, df: DataFrame, *more) -> DataFrame:
        seen, aggs = Observation(f"{self.name}_{stage}"), (F.count(F.lit(1)).alias("n"), *more)
        self.stages[stage] = seen, df, aggs
        return df.observe(seen, *aggs)

    def seen(self, stage: str) -> dict:
        """What was observed; counted if the optimiser has left the stage out (as before a join with an empty parent)."""
        seen, df, aggs = self.stages[stage]
        try:
            return seen.get
        except Exception:
            return df.agg(*aggs).first().asDict()


def load_tables(spark: SparkSession, root: str, codebook: dict[str, T.StructType] | str, out_dir: str,
                tables=None, mode: str = "overwrite", parallel: int = 4) -> DataFrame:
    """Load every table found under ``root`` that the codebook describes; write Parquet to ``out_dir/<table>``.

    Returns a small report DataFrame (one row per table). A table whose file
    lacks a primary-key column loads no rows and is reported; a table that
    fails, or has several files of its name, is reported with its error and
    the others continue. A parent that the codebook describes but that is
    neither in this drop nor in ``out_dir`` counts as empty: its children's
    rows are orphans, and the status says so. Tables are
    loaded level by level (parents before children); the tables of one level
    are independent and are written as concurrent jobs from ``parallel`` threads.
    """
    from concurrent.futures import ThreadPoolExecutor
    from threading import Lock

    if isinstance(codebook, str):
        codebook = read_codebook(spark, codebook)
    files, clashes = find_table_files(spark, root)
    clashes = {t: why for t, why in clashes.items() if t in codebook and (tables is None or t in tables)}
    names = [t for t in sorted(set(files) & set(codebook)) if tables is None or t in tables]
    failed = set(clashes)
    scratch = f"{ensure_checkpoint_dir(spark).rstrip('/')}/load-keys-{uuid.uuid4().hex}"
    written: dict[str, DataFrame] = {}
    results: dict[str, tuple] = {}
    turn = Lock()
    # both scans of a table are split alike, also where executors come or go between them
    splits = spark.conf.get(SPLITS, None) or str(spark.sparkContext.defaultParallelism)
    with settings(spark, {**FREE_SHUFFLES, **PATIENT, SPLITS: splits}), ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        headers = table_files(spark, {t: files[t] for t in names})
        for level in load_levels(names):
            parents = dict(written)
            futures = {t: pool.submit(_load_one, spark, root, t, codebook, headers[t], out_dir, mode, parents, set(failed),
                                      scratch, turn) for t in level}
            for t, f in futures.items():
                results[t], df = f.result()
                if df is not None:
                    written[t] = df
                else:
                    failed.add(t)
    for t, why in clashes.items():
        results[t] = _failed(t, why)
    order = parents_first([*names, *clashes])
    return spark.createDataFrame([results[t] for t in order], REPORT_SCHEMA)


def _load_one(spark, root, table, codebook, files, out_dir, mode, written, failed, scratch, turn):
    """Load one table; returns (report row, the written table read back, or None on error). ``turn``: held while
    the keys of a large table are dealt.

    The "read" count also has, per column with a declared size, the values longer than that size (what forced the source
    database to widen the column): reported, never a failure, since Spark strings are unbounded.
    """
    spec = KEYS.get(table, KeySpec())
    cols = codebook[table].fieldNames()
    path = os.path.join(out_dir, table)
    blank = f"; files without a header: {len(files.blank)}" if files.blank else ""
    try:
        pk = list(spec.primary_key)
        raw = raw_scan(spark, root, table, ordered=bool(pk), files=files, clean=True)
        unexpected = ",".join(project_to_schema(raw, cols)[1])
        missing = [k for k in pk if k not in raw.columns]
        if missing:
            # every row has a NULL key: write the empty table, report what was quarantined
            scanned = tsv_scan(spark, root, table, cols, clean=False, raw=raw).drop(I.ORDER_COL)
            n_read = scanned.count()
            scanned.limit(0).write.mode(mode).parquet(path)
            return ((table, "missing key columns" + blank, n_read, n_read, 0, 0, 0, unexpected,
                     ",".join(missing), ""), spark.read.parquet(path))
        parents, absent = _parents(spark, table, spec, codebook, out_dir, written, failed)
        marks, n = f"{scratch}/{table}", None
        if pk:
            with turn if files.size >= IN_TURN else nullcontext():
                n = mark_kept(spark, root, table, spec, parents, files, marks)
        watch, sized = _Watch(table), [(i, c.name, c.metadata.get("size")) for i, c in enumerate(codebook[table])]
        sized = [(i, c, size) for i, c, size in sized if size]
        over = [F.count_if(F.length(F.col(c)) > F.lit(size)).alias(f"over_{i}") for i, c, size in sized]
        rows = watch("read", tsv_scan(spark, root, table, cols, clean=False, raw=raw), *over)
        rows = watch("kept", keep_marked(rows, spec, n, marks) if pk else keep_all(rows, spec, parents, table))
        rows.write.mode(mode).option("compression", CODEC).parquet(path)
        read, kept = watch.seen("read"), watch.seen("kept")["n"]
        n = n or {"keyed": read["n"], "unique": read["n"]}
        if kept != n.get("kept", kept):
            raise RuntimeError(f"{kept} rows were written where {n['kept']} have a key to keep: the files changed during the load")
        over = ",".join(f"{c}:{read[f'over_{i}']}" for i, c, _ in sized if read[f"over_{i}"])
        status = (f"ok; parent not loaded: {','.join(absent)}" if absent else "ok") + blank
        return ((table, status, read["n"], read["n"] - n["keyed"], n["keyed"] - n["unique"], n["unique"] - kept, kept,
                 unexpected, "", over), spark.read.parquet(path))
    except Exception as e:  # keep loading the other tables, as the source does
        return _failed(table, f"{type(e).__name__}: {str(e)[:200]}"), None


def keep_marked(rows: DataFrame, spec: KeySpec, n: dict[str, int], marks: str) -> DataFrame:
    """Of a scan's ``rows``, those that :func:`mark_kept` marked (``n`` and ``marks``: its counts and its path)."""
    rows = I.drop_null_keys(rows, spec.primary_key)
    if n["kept"] < n["keyed"]:
        order = rows.schema[I.ORDER_COL].dataType.simpleString()
        written = rows.sparkSession.read.schema(f"_block {order}, _n bigint, _bits array<bigint>").parquet(marks)
        rows = I.marked_rows(rows, written, n["blocks"])
    return rows.drop(I.ORDER_COL)


def keep_all(rows: DataFrame, spec: KeySpec, parents: dict[str, DataFrame], table: str) -> DataFrame:
    """``rows`` of a table without a key, less orphans, with a surrogate key: unique (not dense), stable for a given input split."""
    for child_cols, parent, parent_cols in spec.single_column_fks:
        if parent in parents and parent != table:
            rows = I.reject_orphans(rows, parents[parent], child_cols, parent_cols)
    return rows.withColumn("row_id", F.monotonically_increasing_id())


def _failed(table: str, why: str) -> tuple:
    return table, f"error: {why}", None, None, None, None, None, "", "", ""


def _parents(spark, table, spec, codebook, out_dir, written, failed) -> tuple[dict[str, DataFrame], list[str]]:
    """The table's parents as loaded now or before; those that should exist and do not, or that failed in this run
    (what an earlier run left of them is not this drop's), are empty frames."""
    found, absent = {}, []
    for _, parent, _ in spec.single_column_fks:
        if parent == table or parent not in codebook:
            continue
        path = os.path.join(out_dir, parent)
        if parent in written:
            found[parent] = written[parent]
        elif parent not in failed and path_exists(spark, path):
            found[parent] = spark.read.parquet(path)
        else:
            found[parent] = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in
                                                                    codebook[parent].fieldNames()]))
            absent.append(parent)
    return found, sorted(set(absent))
