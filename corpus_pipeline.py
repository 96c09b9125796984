"""From raw documents to packed training sequences: five operators in a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillpoint.llm.common import table
from tillpoint.llm.exact_dedup import drop_copies
from tillpoint.llm.mixing import training_order
from tillpoint.llm.packing import pack
from tillpoint.llm.quality import drop_poor
from tillpoint.llm.simhash import drop_near_duplicates
from tillpoint.operators.persist import materialize, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return drop_poor(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest id stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, one document with the smallest id stays."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order; untaken ones go."""
    return training_order(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return pack(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("simhash near-dedup", near),
          ("mixing", mixing), ("best-fit packing", packing)]

# Trained models, connected components and tokens are beyond SQL; the tests check every operator
# against a brute-force version, and the stages one after the other.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result is written and read again.

    What a stage writes besides its result is deleted once the result is there.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}",
                               keep=True)
    return docs
