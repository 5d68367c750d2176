"""Exact de-duplication by deterministic block naming (DataFrame functions only).

Every text is cut into blocks of a fixed number of characters. Equal blocks get
one integer name: blocks are hash-partitioned, sorted, and each run of equal
blocks takes its smallest occurrence number. Names of adjacent blocks are then
paired and the pairs named the same way, level by level, until a document has
one name. Two documents have the same (number of blocks, name) exactly when
their normalised texts are equal; no checksum decides anything.

A hot block (boilerplate, a large group of copies) is named in two steps: first
within a salt, then over the few salted names, so no task receives all of its
occurrences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelkit.llm.common import ascii_lower, written


def _named(df: DataFrame, key: list[str], salts: int) -> DataFrame:
    """Replace the key columns by ``name``: the smallest ``occ`` among rows with equal keys.

    ``occ`` is a unique integer per row. One lineage, three exchanges: by (key, salt), by key for the
    salted representatives, by salted name. Only representatives carry the key past the first exchange.
    """
    salt = F.pmod(F.xxhash64("occ"), F.lit(salts))
    local = (df.withColumn("_salt", salt)
             .withColumn("_local", F.min("occ").over(Window.partitionBy(*key, "_salt")))
             .withColumn("_rep", F.col("occ") == F.col("_local")).drop("_salt"))
    for c in key:
        local = local.withColumn(c, F.when(F.col("_rep"), F.col(c)))
    apart = local.withColumn("_apart", F.when(~F.col("_rep"), F.col("occ")))
    heads = apart.withColumn("_head", F.min("_local").over(Window.partitionBy(*key, "_apart"))).drop(*key, "_apart")
    return (heads.withColumn("name", F.max(F.when(F.col("_rep"), F.col("_head"))).over(Window.partitionBy("_local")))
            .drop("_local", "_rep", "_head"))


def block_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = 4096,
                salts: int = 128) -> DataFrame:
    """One row per input row: ``row``, ``id``, ``text_sha256``, ``n_blocks``, ``name``.

    A null text counts as empty (one empty block). Rows with equal normalised texts, and only they, agree in
    (``n_blocks``, ``name``). Null and repeated ids are kept as they are; ``row`` tells the rows apart.
    """
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    docs = docs.select(F.col(id_col).alias("id"), text.alias("_t"))
    pieces = F.regexp_extract_all("_t", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    docs = docs.select("id", F.sha2("_t", 256).alias("text_sha256"),
                       F.when(F.col("_t") == "", F.array(F.lit(""))).otherwise(pieces).alias("_blocks"))
    blocks = docs.select("id", "text_sha256", F.size("_blocks").cast("long").alias("n_blocks"),
                         F.posexplode("_blocks").alias("idx", "block"))
    blocks = (blocks.withColumn("occ", F.monotonically_increasing_id())
              .withColumn("row", F.col("occ") - F.col("idx"))      # a document's blocks are consecutive
              .withColumn("id", F.when(F.col("idx") == 0, F.col("id")))
              .withColumn("text_sha256", F.when(F.col("idx") == 0, F.col("text_sha256"))))
    level = written(_named(blocks, ["block"], salts).withColumn("idx", F.col("idx").cast("long"))
                    .withColumn("width", F.col("n_blocks")), "names")
    done = level.where("width = 1")
    while True:
        level = level.where("width > 1")
        if level.isEmpty():
            break
        half = F.shiftright("idx", 1)
        pairs = level.groupBy("row", half.alias("idx")).agg(
            F.max(F.when(F.col("idx") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("idx") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
            F.max("n_blocks").alias("n_blocks"), F.max("width").alias("width"),
            F.min("occ").alias("occ"), F.max("id").alias("id"), F.max("text_sha256").alias("text_sha256"))
        # documents of another block count never match: the count is part of the key
        level = written(_named(pairs.withColumn("_n", F.col("n_blocks")), ["_n", "left", "right"], salts)
                        .withColumn("width", F.shiftright(F.col("width") + 1, 1)), "names")
        done = done.unionByName(level.where("width = 1"))
    return done.select("row", "id", "text_sha256", "n_blocks", "name")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = 4096,
                salts: int = 128) -> DataFrame:
    """Group equal texts (after lower-casing A-Z) and keep one row of each group.

    Returns one row per input row, dropped ones too: ``doc_id``, ``keep_id`` (largest id of the group),
    ``group_size``, ``kept``, ``text_sha256``.

    Nulls: a null text equals the empty text; a null id loses against any other id. When the largest id is
    repeated within a group, exactly one of its rows is kept. An empty table gives an empty result; other
    columns of ``docs`` are ignored, whatever their names.
    """
    rows = written(block_names(docs, id_col, text_col, block_chars, salts), "identities")
    best = written(rows.groupBy("n_blocks", "name").agg(F.max(F.struct("id", "row")).alias("top"),
                                                        F.count(F.lit(1)).alias("group_size")), "groups")
    out = rows.join(best, ["n_blocks", "name"])
    return out.select(F.col("id").alias("doc_id"), F.col("top.id").alias("keep_id"), "group_size",
                      (F.col("row") == F.col("top.row")).alias("kept"), "text_sha256")


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row for each distinct normalised text, all columns as they were.

    The decision comes from :func:`exact_dedup`; rows are found again by (id, normalised text). Rows that
    repeat a kept (id, text) are the same document twice: one of them stays.
    """
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_sha"),
        F.col("group_size").alias("__kept_of"))
    sha = F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256)
    found = docs.withColumn("__sha", sha).join(
        kept, F.col("__sha").eqNullSafe(F.col("__kept_sha")) & F.col(id_col).eqNullSafe(F.col("__kept_id")))
    alone = found.where("__kept_of = 1").select(docs.columns)
    several = found.where("__kept_of > 1").dropDuplicates(["__sha", "__kept_id"]).select(docs.columns)
    return alone.unionByName(several)
