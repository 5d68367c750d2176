"""Incremental loading of new yearly drops with Structured Streaming.

New text files arriving under ``<landing>/<table>/`` are found by the streaming
file source; every micro-batch scans its files with the loader's text reader
(header by name, whatever the column order) and runs the loader's rules: clean
cells, drop rows with a NULL key, keep the first row per key in file order,
reject orphans, and append only the keys the target table does not hold yet —
the source database's ``INSERT … ON CONFLICT DO NOTHING``: a key loaded by an
earlier drop keeps its row. Because what is appended lacks the table's current
keys, a micro-batch that is retried after a failure adds
nothing twice. A table without a key has no such test: its batches are written
as partitions ``drop=<batch>``, and a retry overwrites its own. Progress is
tracked in a checkpoint folder on shared storage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.integrity import ORDER_COL, drop_null_keys, reject_orphans, without_repeats
from ..session import ensure_checkpoint_dir, path_exists
from ..sources.tsv import raw_scan, tsv_scan

# --- fixed values: the columns of Spark's binary file source ---------------------
FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                      T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def first_new_rows(rows: DataFrame, keys: DataFrame, held: DataFrame | None, pk: list[str], scratch: str) -> DataFrame:
    """The first row in file order of every key that ``held`` (one row a key) lacks.

    ``keys`` are the rows' keys and ``_row_order``. What becomes of each is found from those alone and written to
    ``scratch``; whole rows then meet the new keys or the others (held or repeated), whichever are fewer, and are
    shuffled only if those are too many to broadcast.
    """
    spark = rows.sparkSession
    first = keys.groupBy(*pk).agg(F.min(ORDER_COL).alias("_first"), F.count(F.lit(1)).alias("_n"))
    if held is None:
        first = first.withColumn("_held", F.lit(False))
    else:
        first = first.join(held.withColumn("_held", F.lit(True)), pk, "left").withColumn("_held", F.col("_held").isNotNull())
    first.write.mode("overwrite").parquet(f"{scratch}/keys")
    first = spark.read.schema(first.schema).parquet(f"{scratch}/keys")
    other = F.col("_held") | (F.col("_n") > 1)
    n = first.agg(F.count_if(~F.col("_held")).alias("new"), F.count_if(other).alias("other")).first()
    order = first.schema["_first"].dataType
    if n["new"] <= n["other"]:
        few = first.where(~F.col("_held")).select(*pk, F.col("_first").alias(ORDER_COL))
    else:       # no row is the first of a key that is held
        few = first.where(other).select(*pk, F.when(F.col("_held"), F.lit(-1).cast(order)).otherwise(F.col("_first")).alias("_first"))
    few.write.mode("overwrite").parquet(f"{scratch}/few")
    few = spark.read.schema(few.schema).parquet(f"{scratch}/few")
    return rows.join(few, few.columns, "left_semi") if n["new"] <= n["other"] else without_repeats(rows, few, pk)


def stream_drops(spark: SparkSession, landing: str, table: str, columns, pk, target: str, checkpoint: str,
                 available_now: bool = True, parents=()):
    """Start the incremental load of ``table``; returns the ``StreamingQuery``.

    ``available_now=True`` processes every file present and stops (a scheduled
    run per drop); ``False`` keeps watching the folder. ``parents`` lists
    foreign keys as (child columns, path of the parent's table, parent columns).
    """
    pk, columns = list(pk), list(columns)
    files = (spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True)
             .load(f"{landing.rstrip('/')}/{table}").select("path"))     # contents are not read here

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        paths = sorted(r["path"] for r in batch.collect())               # the names of a drop's files
        if not paths:
            return
        raw = raw_scan(session, landing, table, paths, ordered=True, clean=True)
        fresh = drop_null_keys(tsv_scan(session, landing, table, columns, clean=False, raw=raw), pk)
        if pk:
            keys = drop_null_keys(tsv_scan(session, landing, table, pk, clean=False, raw=raw), pk)
            # else no batch has left rows: this is the first one, or its retry
            held = session.read.parquet(target).select(*pk) if path_exists(session, f"{target}/part-*") else None
            fresh = first_new_rows(fresh, keys, held, pk, f"{ensure_checkpoint_dir(session).rstrip('/')}/drop-keys-{uuid.uuid4().hex}")
        fresh = fresh.drop(ORDER_COL)
        for child_cols, parent, parent_cols in parents:
            fresh = reject_orphans(fresh, session.read.parquet(parent), child_cols, parent_cols)
        if pk:
            fresh.write.mode("append").parquet(target)
        else:
            fresh.write.mode("overwrite").parquet(f"{target}/drop={epoch_id}")

    writer = files.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
