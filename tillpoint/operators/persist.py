"""Cutting lineage through a written table in the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillpoint.session import checkpoint_dir

_scopes: list[list[str]] = []

# Of a batch of rows on its way to a Python worker: a task holds a few batches, in the JVM and in
# Python, and a worker may need many times a batch for what it computes from it.
BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20


def size_of(text: str) -> int:
    """Number or bytes of a setting, such as 4194304, 4194304b, 4m or 4MB."""
    n, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", text.strip().lower()).groups()
    return int(n) << 10 * " kmgt".index(unit or " ")


@contextmanager
def settings(spark: SparkSession, most: dict[str, int], least: dict[str, int] | None = None
             ) -> Iterator[None]:
    """Keep settings of the session within bounds; ones not above 0 count as unbounded."""
    before = {key: spark.conf.get(key) for key in [*most, *(least or {})]}
    for key, value in before.items():
        now = size_of(value)
        if key in most and not 0 < now <= most[key]:
            spark.conf.set(key, str(most[key]))
        elif key not in most and now < least[key]:
            spark.conf.set(key, str(least[key]))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def small_batches(spark: SparkSession):
    """Bound the batches sent to Python workers."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
                            "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES})


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``materialize`` writes inside, but those it is told to keep.

    For work whose result is a value or another written table; a lazy result that leaves the
    block must not read them.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df: DataFrame, label: str = "t", keep: bool = False) -> DataFrame:
    """Write ``df`` as parquet under ``spark.checkpoint.dir`` and return a reader of it.

    Used where a plan needs several passes over an intermediate result (count, sample,
    final pass): the upstream work runs once, and a lost executor only costs a re-read of
    the written files instead of a recomputation of the whole lineage.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex}")
    if _scopes and not keep:
        _scopes[-1].append(path)
    with small_batches(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
