"""Single-table statements over the denormalised sales line table.

Filters, global and grouped aggregates, HAVING, top-n, duplicate groups, and the
clean-then-aggregate pipeline over raw sales text.  Money is summed as DECIMAL with six
digits; totals and averages are rounded half-up to four digits at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.exprs import dec, money, round_half_up
from tillpoint.operators import clean as C

DIGITS = 4


def avg_money(col: str, digits: int = DIGITS) -> Column:
    """Exact sum over count (NULLs skipped), rounded half-up."""
    return round_half_up(F.sum(dec(col)).cast("double") / F.count(col).cast("double"), digits)


def sum_money(col: str, digits: int = DIGITS) -> Column:
    return money(F.sum(dec(col)), digits)


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def filter_gt(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) > F.lit(value))


def filter_after(df: DataFrame, col: str, day: str) -> DataFrame:
    return df.filter(F.col(col) > F.lit(day).cast("timestamp_ntz"))


def sales_totals(df: DataFrame) -> DataFrame:
    return df.agg(sum_money("sales").alias("total_sales"), F.max("sales").alias("highest_sale"),
                  avg_money("sales").alias("average_sales"))


def sum_by(df: DataFrame, key: str, col: str = "sales", out: str = "total_sales") -> DataFrame:
    return df.groupBy(key).agg(sum_money(col).alias(out))


def avg_by(df: DataFrame, key: str, col: str = "sales", out: str = "average_sales") -> DataFrame:
    return df.groupBy(key).agg(avg_money(col).alias(out))


def quantity_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum("quantity").cast("bigint").alias("quantity_sold"))


def count_by(df: DataFrame, key: str, out: str = "orders") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def having_quantity(df: DataFrame, over: int, key: str = "customer_name") -> DataFrame:
    return (df.groupBy(key).agg(F.sum("quantity").cast("bigint").alias("quantity"))
            .filter(F.col("quantity") > over))


def top_n_by_sales(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return (df.groupBy(key).agg(sum_money("sales").alias("total_sales"))
            .orderBy(F.col("total_sales").desc(), key).limit(n))


def profit_by_region(df: DataFrame) -> DataFrame:
    return (sum_by(df, "region", "profit", "profit")
            .orderBy(F.col("profit").desc(), "region"))


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
            .filter(F.col("duplicate_count") > 1))


# -- raw sales text (A5 pipeline) ----------------------------------------------------------

def parsed(dirty: DataFrame) -> DataFrame:
    return C.parse_numeric(dirty, "sales")


def city_counts(df: DataFrame, over: int) -> DataFrame:
    return (df.groupBy("city").agg(F.count(F.lit(1)).alias("total_count"))
            .filter(F.col("total_count") > over))


def sales_statistics(df: DataFrame) -> DataFrame:
    return df.agg(F.min("sales").alias("minimum_sales"), F.max("sales").alias("maximum_sales"),
                  avg_money("sales").alias("average_sales"))


def avg_after_fill(df: DataFrame) -> DataFrame:
    return C.fill_constants(df, {"sales": 0.0}).agg(avg_money("sales").alias("average_sales"))


SURVIVOR_ORDER = ["product_id", "ship_date", "quantity", "discount", "profit", "sales"]


def region_revenue_clean(dirty_parsed: DataFrame) -> DataFrame:
    """Dedup on (order, customer name, category), fill missing sales with 0, sum per region."""
    dd = C.dedup_by_key(dirty_parsed, ["order_id", "customer_name", "category"], SURVIVOR_ORDER)
    return (C.fill_constants(dd, {"sales": 0.0}).groupBy("region")
            .agg(sum_money("sales").alias("total_revenue")))
