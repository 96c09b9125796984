"""Customer sales statements: totals, maxima, averages, ranks and named variants.

Input: order lines (order_id, customer_id, product_id, quantity, sales) and a customer
dimension (customer_id, customer_name).  A dimension may repeat a key; joining to it
would multiply the totals, so the named reports first keep one row per key
(``unique_dimension``).  Totals are exact and rounded to four digits at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.functions.exprs import dec
from tillpoint.functions.exprs import money as _money
from tillpoint.operators.persist import materialize
from tillpoint.operators.topk import top_k_with_ties
from tillpoint.operators.windows import global_rank, ordered_window


def money(c) -> Column:
    return _money(c, 4)


def unique_dimension(dim: DataFrame, key: str = "customer_id",
                     value: str = "customer_name") -> DataFrame:
    """One row per key; the smallest value wins when a key repeats (partial aggregation)."""
    return dim.groupBy(key).agg(F.min(value).alias(value))


def _totals(lines: DataFrame, key: str = "customer_id") -> DataFrame:
    return lines.groupBy(key).agg(F.sum(dec("sales")).alias("total"))


# R19
def orders_above_average(lines: DataFrame) -> DataFrame:
    avg = lines.agg(F.avg(dec("sales"))).scalar()
    return lines.filter(dec("sales") > avg)


# R20
def max_sale_per_customer(lines: DataFrame) -> DataFrame:
    return lines.groupBy("customer_id").agg(F.max("sales").alias("max_sales"))


# R21
def sales_per_customer(lines: DataFrame) -> DataFrame:
    return _totals(lines).select("customer_id", money("total").alias("total_sales"))


# R22
def customers_above_average(lines: DataFrame) -> DataFrame:
    totals = _totals(lines)
    avg = totals.agg(F.avg("total")).scalar()
    return totals.filter(F.col("total") > avg).select("customer_id",
                                                      money("total").alias("total_sales"))


# R23
def customer_sales_rank(lines: DataFrame, **kw) -> DataFrame:
    ranked = global_rank(_totals(lines), "total", "customer_id", "sales_rank", **kw)
    return ranked.select("customer_id", money("total").alias("total_sales"), "sales_rank")


# R24
def order_row_number(lines: DataFrame, **kw) -> DataFrame:
    """ROW_NUMBER per customer by order id, range-bucketed so a hot customer is split."""
    kw.setdefault("split_ties", True)   # lines of one huge order share (customer, order)
    numbered = ordered_window(lines.select("order_id", "customer_id"), [("order_id", True)],
                              ["customer_id"], row_number="row_num", **kw)
    return numbered.select("order_id", "customer_id", "row_num")


# R25
def top_customers_by_rank(lines: DataFrame, k: int = 3) -> DataFrame:
    top = top_k_with_ties(_totals(lines), "total", k, "sales_rank")
    return top.select("customer_id", money("total").alias("total_sales"))


# R26
def customer_rank_named(lines: DataFrame, customers: DataFrame, **kw) -> DataFrame:
    ranked = global_rank(_totals(lines), "total", "customer_id", "sales_rank", **kw)
    return ranked.join(unique_dimension(customers), "customer_id").select(
        "customer_name", money("total").alias("total_sales"), "sales_rank")


def _named_totals(lines: DataFrame, customers: DataFrame) -> DataFrame:
    per_cust = _totals(lines)
    return (per_cust.join(unique_dimension(customers), "customer_id")
            .groupBy("customer_name").agg(F.sum("total").alias("total")))


# R27
def top_named(lines: DataFrame, customers: DataFrame, k: int = 5) -> DataFrame:
    top = top_k_with_ties(_named_totals(lines, customers), "total", k, "sales_rank")
    return top.select("customer_name", money("total").alias("total_sales"), "sales_rank")


# R28
def bottom_named(lines: DataFrame, customers: DataFrame, k: int = 5) -> DataFrame:
    low = top_k_with_ties(_named_totals(lines, customers), "total", k, "sales_rank",
                          descending=False)
    return low.select("customer_name", money("total").alias("total_sales"), "sales_rank")


# R29
def single_order_customers(lines: DataFrame, customers: DataFrame) -> DataFrame:
    one = (lines.groupBy("customer_id").agg(F.count_distinct("order_id").alias("n"))
           .filter(F.col("n") == 1))
    return one.join(unique_dimension(customers), "customer_id").select("customer_name")


# R30
def above_average_named(lines: DataFrame, customers: DataFrame) -> DataFrame:
    totals = _totals(lines)
    avg = totals.agg(F.avg("total")).scalar()
    return (totals.filter(F.col("total") > avg)
            .join(unique_dimension(customers), "customer_id")
            .select("customer_name", money("total").alias("total_sales"), "customer_id"))


# R31
def top_order_per_customer(lines: DataFrame, customers: DataFrame, salts: int = 64) -> DataFrame:
    """Lines that carry their customer's largest sale (ties keep every such line).

    Lines are read once and thinned to the largest of each (customer, salt); Spark limits those
    groups before it shuffles them, and no customer is one task.  Maxima and lines both
    come from what is left, and meet by (customer, salt), so a largest sale that repeats on a third
    of all lines is no hot key either.
    """
    salted = lines.select("customer_id", "order_id", "sales").withColumn(
        "_s", F.pmod(F.xxhash64("order_id"), F.lit(salts)))
    largest = Window.partitionBy("customer_id", "_s").orderBy(F.desc("sales"))
    left = materialize(salted.withColumn("_r", F.rank().over(largest)).filter("_r = 1")
                       .select("customer_id", "_s", "order_id", "sales"), "top-order")
    per_salt = left.groupBy("customer_id", "_s").agg(F.max("sales").alias("_mx"))
    mx = per_salt.groupBy("customer_id").agg(F.max("_mx").alias("_mx"))
    best = left.join(per_salt.drop("_mx").join(mx, "customer_id"), ["customer_id", "_s"]).filter(
        F.col("sales") == F.col("_mx"))
    return best.join(unique_dimension(customers), "customer_id").select(
        "customer_name", "order_id", "sales")
