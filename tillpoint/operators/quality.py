"""Data-quality rules and the issue report.

Each rule is a filter or an anti join that returns the offending rows; ``dq_report`` turns
them into one row per rule with the number of offending rows and the smallest ids as a
sample.  The sample is taken with a per-task top-n (``orderBy().limit()``), so at most
``sample`` ids per rule ever reach one task, whatever the number of offending rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.operators.persist import materialize

# The e-mail pattern of the quality check.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def invalid_emails(customers: DataFrame, id_col: str = "customer_id",
                   email_col: str = "email") -> DataFrame:
    """Customers whose e-mail does not match the pattern; a missing e-mail fails too."""
    ok = F.coalesce(F.col(email_col), F.lit("")).rlike(EMAIL_PATTERN)
    return customers.filter(~ok).select(id_col, email_col)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent row (a hash anti join, not NOT IN)."""
    return child.join(parent.select(key), key, "left_anti")


def returns(items: DataFrame) -> DataFrame:
    return items.filter(F.col("quantity") < 0)


def discount_over_100(items: DataFrame) -> DataFrame:
    return items.filter(F.col("discount_percent") > 100)


def zero_quantity(items: DataFrame) -> DataFrame:
    return items.filter(F.col("quantity") == 0)


def future_orders(orders: DataFrame, as_of: str) -> DataFrame:
    return orders.filter(F.col("order_date") > F.lit(as_of).cast("timestamp_ntz"))


def repeated_keys(dim: DataFrame, key: str) -> DataFrame:
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def _sample_ids(bad: DataFrame, id_col: str, sample: int) -> "Column":
    """Comma-joined smallest ``sample`` ids of the offending rows (a per-task top-n)."""
    first = bad.select(F.col(id_col).cast("bigint").alias("i")).filter(
        F.col("i").isNotNull()).orderBy("i").limit(sample)
    ids = first.agg(F.array_join(F.transform(F.sort_array(F.collect_list("i")),
                                             lambda x: x.cast("string")), ",")).scalar()
    return F.coalesce(ids, F.lit(""))


def _rules_of(table: DataFrame, rules: list[tuple[str, "Column", str | None]],
              sample: int) -> DataFrame:
    """All rules of one table in one pass: a count_if per rule, then one row per rule."""
    wide = table.agg(*[F.count_if(cond).cast("bigint").alias(f"r{i}")
                       for i, (_, cond, _) in enumerate(rules)])
    rows = []
    for i, (name, cond, id_col) in enumerate(rules):
        ids = _sample_ids(table.filter(cond), id_col, sample) if id_col and sample > 0 \
            else F.lit("")
        rows.append(F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("n_bad"),
                             ids.alias("sample_ids")))
    # One projection of the one-row aggregate (a union of selects would let column pruning
    # split the aggregate into one scan per rule).
    return wide.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def dq_report(orders_clean: DataFrame, customers: DataFrame, items: DataFrame,
              orders: DataFrame, as_of: str, sample: int = 20) -> DataFrame:
    """One row per rule: rule name, number of offending rows, up to ``sample`` ids.

    ``orders_clean`` carries the ``customer_id_missing`` / ``order_date_unparseable`` flags
    of ``clean_orders``; ``orders`` is the typed order table.  Each table is counted in one
    aggregation whatever the number of its rules.
    """
    ok_email = F.coalesce(F.col("email"), F.lit("")).rlike(EMAIL_PATTERN)
    parts = [
        _rules_of(orders_clean, [
            ("orders_missing_customer", F.col("customer_id_missing"), "order_id"),
            ("orders_unparseable_date", F.col("order_date_unparseable"), "order_id")], sample),
        _rules_of(customers, [("customers_invalid_email", ~ok_email, "customer_id")], sample),
        # Written once: the count and the sample both read it.
        _rules_of(materialize(orphans(items, orders, "order_id").select("order_id"), "dq"),
                  [("items_without_order", F.lit(True), "order_id")], sample),
        _rules_of(items, [
            ("items_negative_quantity", F.col("quantity") < 0, None),
            ("items_discount_over_100", F.col("discount_percent") > 100, None),
            ("items_zero_quantity", F.col("quantity") == 0, None)], sample),
        _rules_of(orders, [("orders_in_future",
                            F.col("order_date") > F.lit(as_of).cast("timestamp_ntz"),
                            "order_id")], sample),
        _rules_of(repeated_keys(customers, "customer_id"),
                  [("customers_repeated_key", F.lit(True), "customer_id")], sample),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
