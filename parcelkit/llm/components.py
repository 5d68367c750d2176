"""Connected components of an edge table: alternating large-star and small-star steps.

Each step is a grouped minimum and a join on the node; every result is written to the shared checkpoint
folder. A node of many edges is combined map-side for its minimum, and the join is one that adaptive execution
can split. Nothing is collected but two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import written


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node``, ``root`` (smallest node of its component) for every node with an edge to another node.

    Self-loops, repeated edges and both directions of an edge are allowed; edges with a null end are ignored.
    """
    def oriented(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()

    now = written(oriented(edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where(
        "u is not null and v is not null")), "edges")
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "least")
        # large star: every larger neighbour (a node of the stored direction) moves to the smallest one
        large = now.select(F.col("v").alias("node"), F.col("u").alias("far"))
        moved = large.join(least.withColumnRenamed("u", "node"), "node").select(
            F.col("far").alias("u"), F.col("m").alias("v"))
        now = written(oriented(moved), "large")
        # small star: the smaller neighbours of a node, and the node, move to the smallest of them
        least = written(now.groupBy("u").agg(F.min("v").alias("m")), "least")
        pairs = now.join(least, "u")
        small = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
        now = written(oriented(small), "small")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
