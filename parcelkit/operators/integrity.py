"""Key and foreign-key enforcement and profiling, as set-based DataFrame operators.

The source loader enforced keys row by row against a database (skip rows with a
NULL key, ``ON CONFLICT DO NOTHING`` for duplicates, per-row retry on FK
failure). Here each rule is one aggregate or one join over the whole table:

* ``drop_null_keys``   – filter (no shuffle)
* ``dedupe_keep_first`` – a hash aggregate of key and row number (combined
  map-side, so a hot key costs one buffer per task), then a join with the keys
  that repeat: whole rows are shuffled only if those are too many to broadcast
* ``reject_orphans``   – one semi (or anti) join on the plain key columns; Spark
  broadcasts a small key set, AQE splits skewed partitions otherwise; NULL keys bypass it
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER_COL = "_row_order"

# --- fixed values ---------------------------------------------------------------
MARKED = 1 << 15            # rows of a block of marks: the bits of a bitmap that bitmap_construct_agg makes
BROADCAST_MARKS = 1 << 14   # blocks of marks (4 KB each) that are broadcast


def _missing(df: DataFrame, cols) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in cols if c.lower() not in have]


def drop_null_keys(df: DataFrame, pk) -> DataFrame:
    """Rows whose primary-key columns are all present (not NULL).

    A table whose file lacks a key column keeps no rows at all, as in the
    source loader (every row has a NULL key there).
    """
    pk = list(pk)
    if not pk:
        return df
    if _missing(df, pk):
        return df.where(F.lit(False))
    return df.dropna(how="any", subset=pk)


def null_key_rows(df: DataFrame, pk) -> DataFrame:
    """Quarantine side of :func:`drop_null_keys`."""
    pk = list(pk)
    if not pk:
        return df.where(F.lit(False))
    if _missing(df, pk):
        return df
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk]))


def _on_keys(left: DataFrame, right: DataFrame, keys, how: str, nulls: bool = False) -> DataFrame:
    """Join on columns of equal names, keeping the left's; ``nulls``: a null equals a null."""
    other = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(c) for c in right.columns if c not in keys])
    same = [left[k].eqNullSafe(other[f"__{k}"]) if nulls else left[k] == other[f"__{k}"] for k in keys]
    return left.join(other, reduce(lambda a, b: a & b, same), how).drop(*[f"__{k}" for k in keys])


def repeated_keys(df: DataFrame, pk) -> DataFrame:
    """``pk``, ``_first`` (least ``_row_order``) of the keys that several rows have: a hash aggregate of narrow rows."""
    return (df.groupBy(*pk).agg(F.min(ORDER_COL).alias("_first"), F.count(F.lit(1)).alias("_n"))
            .where("_n > 1").drop("_n"))


def without_repeats(df: DataFrame, repeats: DataFrame, pk) -> DataFrame:
    """``df`` without the later rows of the keys in ``repeats`` (:func:`repeated_keys` of the same scan)."""
    marked = _on_keys(df, repeats, list(pk), "left", nulls=True)
    return marked.where(F.col("_first").isNull() | (F.col(ORDER_COL) == F.col("_first"))).drop("_first")


def first_rows(keys: DataFrame, pk) -> DataFrame:
    """The row of each key in ``keys`` with the least ``_row_order``: a hash aggregate of narrow rows."""
    rest = [c for c in keys.columns if c not in (*pk, ORDER_COL)]
    return keys.groupBy(*pk).agg(*[F.min_by(c, ORDER_COL).alias(c) for c in rest], F.min(ORDER_COL).alias(ORDER_COL))


def row_marks(rows: DataFrame) -> DataFrame:
    """Which rows of a scan are in ``rows``, by ``_row_order``: a bit a row, ``MARKED`` rows together.

    ``_block`` is the order of the first of them, ``_n`` how many are in ``rows``, ``_bits`` their bits in words of 64.
    """
    at = (F.col(ORDER_COL) % F.lit(MARKED)).cast("int")
    blocks = rows.select((F.col(ORDER_COL) - at).alias("_block"), at.alias("_at")).repartition("_block")
    blocks = blocks.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"), F.bitmap_construct_agg("_at").alias("_bits"))
    word = "cast(conv(hex(substring(_bits, i * 8 + 1, 8)), 16, -10) as bigint)"
    return blocks.withColumn("_bits", F.expr(f"transform(sequence(0, {MARKED // 64 - 1}), i -> {word})"))


def marked_rows(df: DataFrame, marks: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``df`` that ``marks`` (:func:`row_marks` of the same scan, so many blocks) hold. They are not shuffled
    while the marks are known to be small."""
    marks = F.broadcast(marks.drop("_n")) if blocks <= BROADCAST_MARKS else marks.drop("_n")
    at = (F.col(ORDER_COL) % F.lit(MARKED)).cast("int")
    # the bitmap's bytes begin with the lowest bits, a word with its highest
    bit = F.bit_get(F.get("_bits", F.shiftright(at, 6)), at.bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56)))
    return df.join(marks, (F.col(ORDER_COL) - at == F.col("_block")) & (bit == 1), "left_semi")


def dedupe_keep_first(df: DataFrame, pk, order_cols=None) -> DataFrame:
    """One row per primary key: the first in ``order`` wins (``ON CONFLICT DO NOTHING``).

    ``order`` is the hidden ``_row_order`` number written by the text scan
    (file order even when a file is split across tasks). The keys that repeat
    are found from the key columns and that number alone, by a hash aggregate
    that combines map-side; whole rows only meet those keys. For inputs that are not files, pass ``order_cols``: rows are then
    ranked by those columns ascending, NULLs first, in one pass. Each task ranks its own rows first and sends on one row
    of a key, so a hot key is spread over the tasks.
    Unlike ``dropDuplicates`` the surviving row is deterministic.
    """
    pk = list(pk)
    if not pk:
        return df
    cols = df.columns
    rest = [c for c in cols if c not in pk]
    if order_cols is None and ORDER_COL not in cols:
        raise ValueError("dedupe_keep_first needs order_cols or a _row_order column")
    if not rest:
        return df.select(*pk).distinct()
    if order_cols is None:
        return without_repeats(df, repeated_keys(df.select(*pk, ORDER_COL), pk), pk)
    place = Window.partitionBy(*pk).orderBy(*[F.col(c) for c in order_cols])
    return df.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def _complete(cols) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def _parent_keys(child_cols, parent: DataFrame, parent_cols) -> DataFrame:
    """The parent's key columns under the child's names. No distinct: semi and anti joins need none."""
    parent_cols = list(parent_cols or child_cols)
    return parent.select(*[F.col(p).alias(c) for c, p in zip(child_cols, parent_cols)])


def reject_orphans(child: DataFrame, parent: DataFrame, child_cols=("acct",), parent_cols=None,
                   null_keys: bool = True) -> DataFrame:
    """Child rows whose foreign key exists in ``parent`` (or holds a NULL, which violates nothing).

    ``parent`` must be the already cleaned parent so rejection cascades. The join is on the plain columns, so a
    partitioning or bucketing by them serves it; rows with a NULL pass beside it (``null_keys=False``: there are none,
    as where the key is part of the primary key).
    """
    child_cols = list(child_cols)
    kept = _on_keys(child, _parent_keys(child_cols, parent, parent_cols), child_cols, "left_semi")
    return kept.unionByName(child.where(~_complete(child_cols))) if null_keys else kept


def orphan_rows(child: DataFrame, parent: DataFrame, child_cols=("acct",), parent_cols=None) -> DataFrame:
    """Quarantine side of :func:`reject_orphans`."""
    child_cols = list(child_cols)
    return _on_keys(child.where(_complete(child_cols)), _parent_keys(child_cols, parent, parent_cols), child_cols, "left_anti")


def key_profile(df: DataFrame, pk, table_name: str = "", approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Measure a candidate key: rows, NULL-key rows, distinct keys, duplicate rows, uniqueness.

    One aggregation pass; the exact distinct count is planned by Spark as a
    shuffle on the key (no group is gathered into one task). ``approx=True``
    uses a HyperLogLog sketch (relative error ``rsd``) instead: no shuffle of
    the keys, for very wide scans; duplicate counts are then estimates.
    """
    pk = list(pk)
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])
    if approx:
        distinct = F.approx_count_distinct(F.when(~any_null, F.struct(*[F.col(c) for c in pk])), rsd)
    else:
        distinct = F.count_distinct(*[F.col(c) for c in pk])
    prof = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(any_null).alias("null_key_rows"),
        distinct.alias("distinct_keys"),
    )
    return prof.select(
        F.lit(table_name).alias("table_name"),
        F.lit(",".join(pk)).alias("key_columns"),
        "row_count", "null_key_rows", "distinct_keys",
        (F.col("row_count") - F.col("null_key_rows") - F.col("distinct_keys")).alias("duplicate_rows"),
        ((F.col("null_key_rows") == 0) & (F.col("row_count") == F.col("distinct_keys"))).alias("is_unique"),
    )


def fk_coverage(child: DataFrame, parent: DataFrame, child_cols=("acct",), parent_cols=None,
                child_name: str = "", parent_name: str = "") -> DataFrame:
    """Child rows, rows with a NULL key, orphan rows and distinct orphan keys for one foreign key.

    Both sides are keys alone: they are dealt by key and the parent's are hashed, part by part; neither side is sorted.
    A part must fit a task's memory: let ``spark.sql.shuffle.partitions`` grow with the parent.
    """
    child_cols = list(child_cols)
    child = child.select(*child_cols)
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in child_cols])
    total = child.agg(F.count(F.lit(1)).alias("child_rows"), F.count_if(any_null).alias("null_key_rows"))
    keys = _parent_keys(child_cols, parent, parent_cols)
    keys = keys.where(_complete(child_cols)).hint("shuffle_hash")
    orphans = orphan_rows(child, keys, child_cols).agg(
        F.count(F.lit(1)).alias("orphan_rows"),
        F.count_distinct(F.struct(*[F.col(c) for c in child_cols])).alias("distinct_orphan_keys"))
    return total.join(orphans, how="cross").select(        # two single rows
        F.lit(child_name).alias("child_table"), F.lit(",".join(child_cols)).alias("child_columns"),
        F.lit(parent_name).alias("parent_table"), "child_rows", "null_key_rows", "orphan_rows", "distinct_orphan_keys")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table as one DataFrame (a union of global counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def length_overflow_report(df: DataFrame, sizes: dict[str, int | None], table_name: str = "") -> DataFrame:
    """Per declared column: longest value and number of values longer than the declared size.

    Spark strings are unbounded, so an over-long value never fails a load; this
    reports what the source database would have had to widen. One pass.
    """
    cols = [c for c in df.columns if c in sizes]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, declared_size int, max_length int, over_length_rows bigint")
    aggs = []
    for i, c in enumerate(cols):
        size = sizes[c]
        ln = F.length(F.col(c))
        aggs.append(F.max(ln).alias(f"_m{i}"))
        aggs.append((F.count_if(ln > F.lit(size)) if size else F.lit(0).cast("bigint")).alias(f"_o{i}"))
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(sizes[c]).cast("int").alias("declared_size"),
                              F.col(f"_m{i}").alias("max_length"), F.col(f"_o{i}").alias("over_length_rows"))
                     for i, c in enumerate(cols)])
    return one.select(F.lit(table_name).alias("table_name"), F.inline(rows))
