"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.session import ensure_checkpoint_dir, ship_package

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the faster ``lower``, which then does the same."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def id_crc_mod(id_col: str, k: int) -> Column:
    """crc32 of the id as text, modulo ``k`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % F.lit(k)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def on_workers(df: DataFrame) -> DataFrame:
    """``df``, with this package shipped to the Python workers."""
    ship_package(df.sparkSession)
    return df


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``flat[s : s + n]`` one after the other."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    begin = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - begin, lengths) + np.arange(total)]
