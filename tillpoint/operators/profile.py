"""Profiling: head / tail, shape, schema, null counts, duplicate counts, cleaning summary.

Null counts are one aggregation over all columns (not one job per column) and are turned
into long form with ``unpivot``.  Head and tail need an order on Spark: rows have no
position, so both take the order explicitly and plan as a per-task top-n.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.operators.clean import split_by_repeats


def head(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def tail(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The last ``n`` rows, in ascending order like the rest of the table."""
    return df.orderBy(*[F.col(c).desc() for c in order_by]).limit(n).orderBy(*order_by)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count"))


def schema_table(df: DataFrame) -> DataFrame:
    """Column position, name and type, with the number of non-null values of each column.

    The counts come from one aggregation over the data; the names and types are the
    DataFrame's schema, attached as literals in the same projection.
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.col(f"c{i}").alias("non_null_count")) for i, f in enumerate(fields)]
    return counts.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column; NaN counts as missing in float columns."""
    aggs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        miss = c.isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(c)
        aggs.append(F.count_if(miss).alias(f.name))
    wide = df.agg(*aggs)
    return wide.unpivot([], df.columns, "column_name", "null_count")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows.

    Whole rows are compared only where fingerprints repeat.
    """
    groups = split_by_repeats(df)[1].groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint")
                      .alias("duplicate_rows"))


def cleaning_summary(before: DataFrame, after: DataFrame, deduped_from: DataFrame) -> DataFrame:
    """One row: column counts before / after, final rows and the duplicates removed."""
    n_dup = duplicate_count(deduped_from).scalar()
    return after.agg(F.count(F.lit(1)).alias("total_records")).select(
        F.lit(len(before.columns)).cast("bigint").alias("original_columns"),
        F.lit(len(after.columns)).cast("bigint").alias("final_columns"),
        "total_records", n_dup.alias("duplicates_removed"))
