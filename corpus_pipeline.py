"""The training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

quality classifier -> line dedup -> MinHash near-dedup -> source mixing -> BPE encoding. Every stage takes
(spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import bpe, lines, minhash, mixing, quality
from riskframe.session import stage_table

#: The near-dedup stage links documents of similarity 0.8 or more (op5 has its own contract of 0.85); a pair
#: of similarity 0.8 shares none of 34 bands of 5 rows with probability 1e-6.
NEAR_PERCENT, NEAR_BANDS = 80, 34


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return quality.keep_good(docs, spark.read.parquet(os.path.join(sf_dir, "labels.parquet")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; those left without words go."""
    return lines.dedup_lines(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, by links of similarity 0.8 or more."""
    return minhash.keep_one_of_each(docs, percent=NEAR_PERCENT, bands=NEAR_BANDS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, one row per document and pass over its source."""
    return mixing.mix_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text."""
    return bpe.encode_documents(docs, keep=["doc_id", "lang", "source", "n_chars"])


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("source mixing", mixing_stage),
    ("BPE encoding", encoding_stage),
]

#: SQL cannot express the stages; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read by the next."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
