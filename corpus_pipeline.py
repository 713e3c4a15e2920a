"""A corpus, stage by stage: toxic documents, exact and near copies and contaminated documents go, the rest is packed.

Each stage is a job of its own: its result is a table, which the next one reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm import decontamination, exact, ngram_join, packing, toxicity
from rowtide.llm.frames import kept


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.deduplicated(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.deduplicated(docs)


def not_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("exact_dedup", no_copies),
    ("near_dedup", no_near_copies),
    ("decontamination", not_contaminated),
    ("packing", packed),
]

#: Trained scores and best fit have no SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; every result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
