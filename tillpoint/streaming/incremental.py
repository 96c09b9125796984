"""Incremental loads on Structured Streaming.

New batch files land in a folder; a file stream picks them up and every micro-batch is
upserted into a ``VersionedTable`` with ``foreachBatch``.  The rows of a version carry the
stream's name and the number of the micro-batch, so one that Structured Streaming runs
again after a failure, also after a restart that lost its commit, finds its version and is not
applied twice.  Progress lives in the checkpoint location, by default a folder of the table
itself, so that a restart goes on where the last run stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillpoint.sources.files import VersionedTable


def start_upserts(spark: SparkSession, batch_dir: str, table: VersionedTable, key: str,
                  schema: StructType | str, checkpoint: str | None = None,
                  files_per_batch: int | None = None, available_now: bool = True,
                  fmt: str = "parquet", name: str = "upserts") -> StreamingQuery:
    """Start a stream that upserts every new batch file into ``table`` on ``key``.

    ``name`` tells the streams into one table apart; it goes with the checkpoint location.
    """
    if table.latest() is None:
        raise ValueError("write the initial version of the table first")
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(batch_dir)

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.merge(batch, key, batch_id=f"{name}/{batch_id}")

    writer = stream.writeStream.foreachBatch(apply).option(
        "checkpointLocation", checkpoint or os.path.join(table.root, "streams", name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()


def run_upserts(spark: SparkSession, batch_dir: str, table: VersionedTable, key: str,
                schema: StructType | str, **kw) -> int:
    """Process every batch file present now, wait, and return the latest version."""
    q = start_upserts(spark, batch_dir, table, key, schema, available_now=True, **kw)
    q.awaitTermination()
    return table.latest()
