"""The corpus pipeline: quality rules, exact dedup, near-duplicate join, secret scan, packing.

Each stage is given what the one before kept and returns the columns of documents; the last returns the packed pieces. No stage reads anything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolith.llm import exact_dedup, jaccard, packing, quality, secrets
from aerolith.llm.common import ship, table, work_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, with thresholds from docs themselves."""
    ship(spark)
    return quality.drop_low_quality(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    ship(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship(spark)
    return jaccard.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    ship(spark)
    return secrets.mask_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the bins that hold them."""
    ship(spark)
    return packing.best_fit(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", secret_scan),
    ("best-fit packing", packed),
]

#: No SQL: the join, the randomness tests and the packing can't be expressed in it. Tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What each leaves is a table in the shared folder, from which the next one reads: a lost executor costs a stage's own tasks at most."""
    docs = table(spark, sf_dir, "documents")
    at = work_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}")
        docs = spark.read.parquet(f"{at}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
