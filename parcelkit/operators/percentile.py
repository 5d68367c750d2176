"""Exact grouped ``PERCENTILE_CONT`` by refining histograms, without sorting or gathering a group.

Spark's exact ``percentile`` aggregate keeps every distinct value of a group
in one buffer, and a window ``row_number`` puts a whole group in one task; a
neighbourhood holding a third of the county would then run on one core. This
operator counts instead:

1. each distinct (group, value) once, with its number of rows (combined map-side);
2. a histogram per group on a logarithmic scale: every bin is a monotone function of the value, so the bins are in the
   values' order, and the bin that holds an order statistic follows from running counts over the bins;
3. a histogram of that bin alone, linear between its least and greatest value;
4. running counts over the distinct values of the one bin that is left, where the order statistic is picked.

A histogram has at most some thousand bins a group, whatever the group's size. The two order statistics around
``p * (n - 1)`` are found together and interpolated linearly, exactly like ``PERCENTILE_CONT``. Nothing runs while the
plan is built, and nothing is sampled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOG_BINS = 64           # bins of the first histogram per factor e
LINEAR_BINS = 4096      # bins of the second


def _log_bin(v: Column) -> Column:
    """A whole number that never falls when ``v`` grows: NaN counts as greatest, infinities stand apart."""
    size = F.floor(F.least(F.log1p(F.abs(v)), F.lit(800.0)) * LOG_BINS)
    return F.when(F.isnan(v), F.lit(1 << 20)).when(v < 0, -size - 1).otherwise(size).cast("int")


def _linear_bin(v: Column, low: Column, high: Column) -> Column:
    """The bin of ``v`` between two values of its logarithmic bin; 0 where they have no finite distance."""
    share = F.try_divide(v - low, high - low)
    inside = share.isNotNull() & ~F.isnan(share) & (F.abs(share) <= 1)
    return F.when(inside, F.floor(share * LINEAR_BINS)).otherwise(F.when(v == low, 0).otherwise(LINEAR_BINS)).cast("int")


def _picked(counts: DataFrame, group, order: str) -> DataFrame:
    """Of ``counts`` (``_c`` rows each) those that hold rank ``_r`` of their group, with the rank inside them."""
    running = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_upto", F.sum("_c").over(running))
    before = F.col("_upto") - F.col("_c")
    return counts.where((F.col("_r") >= before) & (F.col("_r") < F.col("_upto"))).withColumn("_r", F.col("_r") - before).drop("_upto", "_c")


def _meet(values: DataFrame, targets: DataFrame, keys) -> DataFrame:
    """Values of the bins that hold an order statistic: at most two bins a group."""
    other = targets.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)], *[c for c in targets.columns if c not in keys])
    same = [values[k].eqNullSafe(other[f"_t{i}"]) for i, k in enumerate(keys)]
    return values.join(other, reduce(lambda a, b: a & b, same)).drop(*[f"_t{i}" for i in range(len(keys))])


def grouped_percentile_cont(df: DataFrame, keys, value, p: float = 0.5,
                            out: str = "percentile") -> DataFrame:
    """``keys..., out`` with ``out = PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY value)`` per group.

    NULL values are ignored; groups without values are absent. ``value`` is
    compared as DOUBLE (as the SQL function does), -0.0 like 0.0.
    """
    keys = list(keys)
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    values = df.select(*[F.col(k) for k in keys], (v + F.lit(0.0)).alias("_v")).where("_v is not null")
    values = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_b", _log_bin(F.col("_v")))

    bins = values.groupBy(*keys, "_b").agg(F.sum("_c").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    bins = bins.withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
    rank = (F.col("_n") - 1) * F.lit(float(p))
    ranks = F.array(F.struct(F.lit(0).alias("_w"), F.floor(rank).cast("long").alias("_r")),
                    F.struct(F.lit(1).alias("_w"), F.ceil(rank).cast("long").alias("_r")))
    bins = bins.select(*keys, "_b", "_c", "_low", "_high", "_n", F.explode(ranks).alias("_t")).select("*", "_t._w", "_t._r").drop("_t")
    first = _picked(bins, [*keys, "_w"], "_b")

    near = _meet(values, first, [*keys, "_b"]).withColumn("_l", _linear_bin(F.col("_v"), F.col("_low"), F.col("_high")))
    held = [*keys, "_b", "_w", "_r", "_n", "_low", "_high"]
    second = _picked(near.groupBy(*held, "_l").agg(F.sum("_c").alias("_c")), [*keys, "_w"], "_l")

    left = _meet(values, second, [*keys, "_b"])
    left = left.where(F.col("_l") == _linear_bin(F.col("_v"), F.col("_low"), F.col("_high")))
    third = _picked(left.select(*keys, "_w", "_r", "_n", "_v", "_c"), [*keys, "_w"], "_v")

    ends = third.groupBy(*keys).agg(F.max("_n").alias("_n"), F.max(F.when(F.col("_w") == 0, F.col("_v"))).alias("_lo"),
                                    F.max(F.when(F.col("_w") == 1, F.col("_v"))).alias("_hi"))
    rank = (F.col("_n") - 1) * F.lit(float(p))
    between = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (rank - F.floor(rank))
    return ends.select(*keys, F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(between).alias(out))
