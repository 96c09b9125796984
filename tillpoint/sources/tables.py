"""Readers for the driver's parquet tables.

Every reader returns a lazy DataFrame over the parquet file; column pruning and filter
push-down happen in the scan when a plan selects or filters, so callers never need to
narrow the read by hand.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet reader of one table; Spark splits files into tasks by size."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


# Readers are plain logical plans over the input files; building one lists the files and reads
# the footers (about a quarter second each), so they are kept per session, as long as the file
# or folder has not changed.
_READERS: dict[tuple, tuple[tuple, DataFrame]] = {}


def _state(spark: SparkSession, path: str) -> tuple:
    """Length and time of the last change of a file or folder (a folder changes with its files)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at)
    return status.getLen(), status.getModificationTime()


class Tables:
    """Attribute access to the base tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        key = (id(self.spark), self.spark.sparkContext.applicationId, self.sf_dir, name)
        state = _state(self.spark, table_path(self.sf_dir, name))
        if _READERS.get(key, (None,))[0] != state:
            _READERS[key] = (state, read_table(self.spark, self.sf_dir, name))
        return _READERS[key][1]
