"""File sources and sinks: CSV with explicit schemas and null policy, Parquet, table loads,
and a versioned table (key ranges and a change feed).

Paths default to folders under ``spark.checkpoint.dir`` (a shared file system on a cluster),
never a machine-local temporary folder.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from tillpoint.operators.persist import materialize, scratch, settings
from tillpoint.session import checkpoint_dir

# CSV options that keep text exactly as written: no trimming.
_KEEP_TEXT = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


# Bytes of compressed files behind one shuffle partition, and of files and a shuffle in one task.
INPUT_A_PARTITION = 2 << 20
SCANNED_A_TASK = 16 << 20
SHUFFLED_A_TASK = 8 << 20


def scratch_path(spark: SparkSession, label: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex}")


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    (df.write.mode("overwrite").option("header", header).options(**_KEEP_TEXT)
     .csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, null_value: str | None = None,
             infer: bool = False, multi_line: bool = False) -> DataFrame:
    """CSV with a header.  With ``schema`` the types are explicit (no inference job);
    ``null_value=""`` makes only the empty field NULL, so a text such as ``NA`` survives.
    Large files are split over tasks; ``multi_line`` reads quoted line breaks, but then a file
    is one task."""
    r = (spark.read.option("header", header).option("multiLine", multi_line)
         .options(**_KEEP_TEXT))
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", "true")
    return r.csv(path)


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int,
                   path: str | None = None) -> DataFrame:
    """A Parquet table bucketed and sorted by ``keys``; tables of equal buckets join without a shuffle.

    Rows are dealt by the keys first, so a bucket is one file.  The table's entry lives in the
    session's catalog, its files under ``path``.
    """
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path or scratch_path(df.sparkSession, name)).saveAsTable(name))
    return df.sparkSession.table(name)


def load_tables(tables: dict[str, DataFrame], root: str) -> DataFrame:
    """Replace-load each table under ``root/<name>`` and return (table_name, row_count)."""
    counts = None
    spark = None
    for name, df in tables.items():
        spark = df.sparkSession
        path = os.path.join(root, name)
        write_parquet(df, path)
        c = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        counts = c if counts is None else counts.unionByName(c)
    return counts


def append_distinct(target_path: str, raw: DataFrame, cols: list[str]) -> DataFrame:
    """``INSERT INTO t SELECT DISTINCT cols FROM raw``: append the distinct rows.

    Rows that are nearly all distinct are not made fewer where they come up, they only fill the
    memory of that task; so they are dealt out first.  Shuffles get partitions in proportion to the
    files behind ``raw``, and few of them are joined into one task.
    """
    spark = raw.sparkSession
    parts = -(-input_bytes(raw) // INPUT_A_PARTITION)
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": SHUFFLED_A_TASK,
                          "spark.sql.files.maxPartitionBytes": SCANNED_A_TASK},
                  {"spark.sql.shuffle.partitions": parts}):
        raw.select(*cols).repartition(*cols).distinct().write.mode("append").parquet(target_path)
    return spark.read.parquet(target_path)


def input_bytes(df: DataFrame) -> int:
    """Length of the files that a frame reads."""
    spark = df.sparkSession
    jvm, conf, total = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for name in df.inputFiles():
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(name))
        total += at.getFileSystem(conf).getFileStatus(at).getLen()
    return total


class VersionedTable:
    """A keyed table whose batches rewrite only the key ranges they touch.

    ``current/_range=<r>`` holds the rows of one range of keys, each with the version that wrote
    it last, ``changes/_version=<n>`` the rows of batch n with what they replaced.  A batch is
    written to the changes first and then applied by a dynamic partition overwrite; applying it
    again gives the same rows, so one that was cut short is applied again by the next call.
    Versions, history and older states are queries over the changes.  A frame from ``read`` is
    to be used before the next batch.
    """

    def __init__(self, spark: SparkSession, root: str, key: str | None = None, parts: int = 16):
        self.spark, self.root, self.key, self.parts = spark, root, key, parts

    def _layout(self):
        try:  # one row, written last by the first load
            return self.spark.read.parquet(os.path.join(self.root, "layout")).first()
        except AnalysisException:
            return None

    def _known(self):
        layout = self._layout()
        if layout is None:
            raise ValueError("write the initial version of the table first")
        return layout, StructType.fromJson(json.loads(layout["columns"]))

    def _table(self, kind: str, **more) -> DataFrame:
        fields = [T.StructField(name, kind_of) for name, kind_of in more.items()]
        schema = StructType(self._known()[1].fields + fields)
        return self.spark.read.schema(schema).parquet(os.path.join(self.root, kind))

    def _current(self) -> DataFrame:
        return self._table("current", _since=T.LongType(), _range=T.LongType())

    def changes(self) -> DataFrame:
        """Batches' rows: the columns, _op, _batch, _old_<column> and _version."""
        old = {f"_old_{f.name}": f.dataType for f in self._known()[1]}
        return self._table("changes", _op=T.StringType(), _batch=T.StringType(), **old,
                           _version=T.LongType())

    def _put(self, rows: DataFrame, kind: str, by: str) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by)
         .parquet(os.path.join(self.root, kind)))

    def write_initial(self, df: DataFrame, key: str | None = None) -> int:
        key = key or self.key or df.columns[0]
        low, high = df.agg(F.min(key), F.max(key)).first()
        width = ((high or 0) - (low or 0)) // self.parts + 1
        self._put(df.withColumns({"_since": F.lit(0).cast("long"), "_range": _range(key, width)}), "current",
                  "_range")
        self._put(df.limit(0).withColumn("_version", F.lit(0)), "changes", "_version")
        write_parquet(self.spark.createDataFrame(
            [(key, width, df.schema.json())], "key string, width long, columns string"),
            os.path.join(self.root, "layout"))
        return 0

    def versions(self) -> list[int]:
        if self._layout() is None:
            return []
        return [0, *sorted(r[0] for r in self.changes().select("_version").distinct().collect())]

    def latest(self) -> int | None:
        return (self.versions() or [None])[-1]

    def _apply(self, version: int) -> None:
        """Overwrite the ranges of a version's rows, unless all of them are there already."""
        layout, columns = self._known()
        rows = self.changes().filter(F.col("_version") == version).select(
            *columns.names, F.lit(version).cast("long").alias("_since"),
            _range(layout["key"], layout["width"]).alias("_range"))
        now = self._current()
        if now.filter(F.col("_since") == version).count() == rows.count():
            return
        touched = [r[0] for r in rows.select("_range").distinct().collect()]
        kept = now.filter(F.col("_range").isin(touched) & (F.col("_since") < version)).join(
            rows.select(layout["key"]), layout["key"], "left_anti")
        with scratch(self.spark):
            self._put(materialize(kept.select(rows.columns).unionByName(rows), "merge-ranges"),
                      "current", "_range")

    def merge(self, batch: DataFrame, key: str, batch_id: str | None = None) -> int:
        """Upsert ``batch`` and return its version; one with a known ``batch_id`` is not repeated."""
        from tillpoint.operators.merge import feed

        layout, columns = self._known()
        if layout["key"] != key:
            raise ValueError(f"the table is keyed by {layout['key']}")
        last = self.latest()
        if last:
            self._apply(last)
        if batch_id is not None:
            known = self.changes().filter(F.col("_batch") == batch_id).agg(F.min("_version"))
            if known.first()[0] is not None:
                return known.first()[0]
        with scratch(self.spark):
            batch = materialize(batch.select(columns.names), "merge-batch")
            touched = [r[0] for r in batch.select(_range(key, layout["width"])).distinct().collect()]
            if not touched:
                return last
            target = self._current().filter(F.col("_range").isin(touched)).select(columns.names)
            self._put(feed(target, batch, key).withColumns(
                {"_batch": F.lit(batch_id).cast("string"), "_version": F.lit(last + 1)}), "changes",
                "_version")
        self._apply(last + 1)
        return last + 1

    def read(self, version: int | None = None) -> DataFrame:
        """The rows as of a version: those not written since, and what later batches replaced."""
        layout, columns = self._known()
        if version is not None and version not in self.versions():
            raise ValueError(f"no version {version}; there are {self.versions()}")
        now = self._current()
        if version in (None, self.latest()):
            return now.select(columns.names)
        first = self.changes().filter(F.col("_version") > version).groupBy(layout["key"]).agg(
            F.min_by(F.struct("_op", *[F.col(f"_old_{c}").alias(c) for c in columns.names]),
                     "_version").alias("_x"))
        return now.filter(F.col("_since") <= version).select(columns.names).unionByName(
            first.filter("_x._op = 'update'").select("_x.*").select(columns.names))

    def history(self) -> DataFrame:
        """One row per version: version, operation, rows_inserted, rows_updated, rows_total."""
        batches = self.changes().groupBy(F.col("_version").alias("version")).agg(
            F.lit("MERGE").alias("operation"), F.count_if(F.col("_op") == "insert").alias("i"),
            F.count_if(F.col("_op") == "update").alias("rows_updated"))
        later = self.changes().filter("_op = 'insert'").count()
        loaded = self._current().agg((F.count(F.lit(1)) - later).alias("i")).select(
            F.lit(0).cast("long").alias("version"), F.lit("WRITE").alias("operation"), "i",
            F.lit(0).cast("long").alias("rows_updated"))
        upto = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, 0)  # of versions
        return loaded.unionByName(batches).select(
            "version", "operation", F.col("i").alias("rows_inserted"), "rows_updated",
            F.sum("i").over(upto).alias("rows_total")).orderBy("version")


def _range(key: str, width: int) -> Column:
    """Number of a key's range; rows without a key share the first one."""
    return F.coalesce(F.floor(F.col(key) / F.lit(width)), F.lit(0)).cast("long")
