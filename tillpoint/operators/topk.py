"""Top-k with ties (``RANK() OVER (ORDER BY v) <= k``) without a single-partition window.

The k best values are found with ``orderBy().limit(k)`` (a per-task top-k, then a merge of
at most k rows per task).  Fewer than k rows are strictly better than the k-th value, so the
rows to keep are exactly those whose value is one of these candidate values; they are found,
with their rank, by joining the at most k candidate values back as a broadcast table whose
size is bounded by k.  A tie that covers a third of the table is kept whole, but never
sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k_with_ties(df: DataFrame, value: str, k: int, rank_col: str = "rank",
                    descending: bool = True) -> DataFrame:
    """``df`` with the rank of ``value``, rows ranked at most ``k`` only.

    NULLs come last in descending and first in ascending order, where they rank like any value.
    """
    v = F.col(value)
    order = v.desc_nulls_last() if descending else v.asc_nulls_first()
    cand = df.select(value).orderBy(order).limit(k)
    # Rank of each candidate value: 1 + number of candidates strictly ahead of it.
    counts = cand.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select(v.alias("_v"), (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) + 1)
                          .cast("bigint").alias(rank_col))
    # Fewer than k rows are strictly better than the k-th value, so the rows at or beyond
    # it are exactly the rows whose value is a candidate value: one broadcast join.
    return df.join(F.broadcast(ranks), v.eqNullSafe(F.col("_v"))).drop("_v")
