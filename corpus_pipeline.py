"""Corpus pipeline: quality, toxicity, exact copies, near copies, packing.

``run`` applies the stages to ``documents``; every stage's rows are written as Parquet under the shared checkpoint
folder and read again as the next one's input. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelkit.llm import exact_dedup, packing, quality, simhash, toxicity
from parcelkit.llm.common import written


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.quality_filter(docs, _labels(spark, sf_dir))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.toxicity_filter(docs, _labels(spark, sf_dir))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (4-word shingles, 4 bits)."""
    return simhash.one_per_group(docs, width=4, max_bits=4)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their training sequence and place."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("exact_dedup", without_copies),
    ("simhash", without_near_copies),
    ("packing", packed),
]

#: SQL has no form for the learned classifiers and the packing: tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
