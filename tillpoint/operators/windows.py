"""Ordered windows that never funnel a whole relation (or one hot key) into one task.

``Window.orderBy(...)`` without ``partitionBy`` plans an ``Exchange SinglePartition``: every
row goes to one task.  A ``partitionBy(key)`` window does the same for all rows of a hot
key.  ``ordered_window`` computes row_number / rank / ntile / running sum / lag with the same
results but splits the rows into range buckets of the full sort key:

1. the rows go through one range exchange on the full key (``repartitionByRange`` samples the
   key itself) into ``rows / rows_per_bucket`` buckets, and are written with the number of
   their bucket, so every later pass, and a pass after a lost executor, sees the same buckets;
2. each bucket is windowed locally (``partitionBy(bucket, partition keys)``), and small
   per-bucket statistics (at most 2 rows per bucket) give each bucket the counts, sums and
   the last value of the same partition key in the buckets before it.

The sort key must be a total order within a partition (add a unique tie-breaker, or let
``split_ties`` add one).  NULLs sort first in ascending order and last in descending order, which
is supported for numeric columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.operators.persist import materialize

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def _carries(bucketed: DataFrame, keys: list[str], metrics: dict[str, Column],
             last_value: Column | None = None) -> DataFrame:
    """Per bucket: totals of the rows that share the bucket's first key in earlier buckets.

    Returns columns ``_b``, ``_fk`` (first key of the bucket) and ``c_<metric>`` for each
    metric, plus ``c_last`` (value of the lag column on the last such earlier row).
    """
    kstruct = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("z"))
    aggs = [m.alias(n) for n, m in metrics.items()]
    if last_value is not None:
        aggs.append(F.max_by(F.struct(last_value.alias("v")), F.col("_K")).alias("_lv"))
    seg = bucketed.groupBy("_b", kstruct.alias("_key")).agg(*aggs)
    payload = ["_key", *metrics.keys()] + (["_lv"] if last_value is not None else [])
    per_b = seg.groupBy("_b").agg(
        F.min_by(F.struct(*payload), F.col("_key")).alias("f"),
        F.max_by(F.struct(*payload), F.col("_key")).alias("l"))
    # Events: the last segment of every bucket adds to the running totals of its key; the
    # first segment of every bucket reads them (ordered before the add of its own bucket).
    adds = per_b.select(F.col("l._key").alias("k"), "_b", F.lit(1).alias("_t"),
                        *[F.col(f"l.{n}").alias(n) for n in metrics],
                        *([F.col("l._lv").alias("_lv")] if last_value is not None else []))
    reads = per_b.select(F.col("f._key").alias("k"), "_b", F.lit(0).alias("_t"),
                         *[F.lit(None).cast(seg.schema[n].dataType).alias(n) for n in metrics],
                         *([F.lit(None).cast(per_b.schema["l"].dataType["_lv"].dataType)
                            .alias("_lv")] if last_value is not None else []))
    w = (Window.partitionBy("k").orderBy("_b", "_t")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ev = adds.unionByName(reads)
    outs = [F.coalesce(F.sum(n).over(w), F.lit(0)).alias(f"c_{n}") for n in metrics]
    if last_value is not None:
        outs.append(F.last("_lv", ignorenulls=True).over(w).alias("c_lv"))
    return ev.select("k", "_b", "_t", *outs).filter(F.col("_t") == 0).select(
        "_b", F.col("k").alias("_fk"), *[f"c_{n}" for n in metrics],
        *(["c_lv"] if last_value is not None else []))


def ordered_window(df: DataFrame, order_by: list[tuple[str, bool]],
                   partition_by: list[str] | tuple[str, ...] = (), *,
                   row_number: str | None = None,
                   rank: tuple[str, int] | None = None,
                   ntile: tuple[str, int] | None = None,
                   running_sum: tuple[str, str] | None = None,
                   lag: tuple[str, str] | None = None,
                   rows_per_bucket: int = 500_000, min_buckets: int | None = None,
                   split_ties: bool = False, written: bool = False) -> DataFrame:
    """Add window columns over ``order_by`` (list of (column, ascending)).

    row_number:  output name for ROW_NUMBER
    rank:        (output name, n) -> RANK where ties are on the first n order columns
    ntile:       (output name, n) -> NTILE(n); only without ``partition_by``
    running_sum: (value column, output name) -> SUM over ROWS UNBOUNDED PRECEDING..CURRENT
    lag:         (value column, output name) -> LAG(value, 1)
    split_ties:  number the rows in a written copy of the input and append that number as a last
                 sort key, so rows with identical keys (one key and value on a third of the rows)
                 can still be cut into several buckets
    written:     the input is a written table; any other is computed once and written, because
                 counting, sampling and bucketing each read it
    """
    partition_by = list(partition_by)
    if ntile is not None and partition_by:
        raise ValueError("ntile is only supported over the whole relation")
    spark = df.sparkSession
    if split_ties:
        order_by = list(order_by) + [("_tie", True)]
        df = df.withColumn("_tie", F.monotonically_increasing_id())
    if split_ties or not written:
        df = materialize(df, "ow-input")
    schema = df.schema
    kcols = [F.col(p).alias(f"_p{i}") for i, p in enumerate(partition_by)]
    for i, (name, asc) in enumerate(order_by):
        c = F.col(name)
        if not asc:
            if not isinstance(schema[name].dataType, _NUMERIC):
                raise ValueError(f"descending order needs a numeric column, got {name}")
            # NULLs last: a flag ahead of the negated value
            c = F.struct(c.isNull().alias("n"), (-c).alias("v"))
        kcols.append(c.alias(f"_o{i}"))
    keyed = df.withColumn("_K", F.struct(*kcols))
    rows = df.count()
    if min_buckets is None:
        min_buckets = spark.sparkContext.defaultParallelism
    buckets = max(1, math.ceil(rows / rows_per_bucket), min(min_buckets, math.ceil(rows / 64)))
    bucketed = materialize(keyed.repartitionByRange(buckets, "_K")
                           .withColumn("_b", F.spark_partition_id()), "ow")
    n_total = rows

    order_cols = [F.col(f"_K._o{i}") for i in range(len(order_by))]
    w_local = Window.partitionBy("_b", *partition_by).orderBy(*order_cols)
    w_rows = w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = bucketed.withColumn("_rn", F.row_number().over(w_local))
    if running_sum is not None:
        out = out.withColumn("_rs", F.sum(running_sum[0]).over(w_rows))
    if lag is not None:
        out = out.withColumn("_lag", F.lag(lag[0], 1).over(w_local))
    if rank is not None:
        rank_cols = order_cols[: rank[1]]
        out = out.withColumn("_rk", F.rank().over(
            Window.partitionBy("_b", *partition_by).orderBy(*rank_cols)))

    metrics = {"n": F.count(F.lit(1))}
    if running_sum is not None:
        metrics["s"] = F.sum(running_sum[0])
    carry = _carries(bucketed, partition_by, metrics,
                     F.col(lag[0]) if lag is not None else None)
    # At most one row per bucket: a bounded table, broadcast by construction.
    out = out.join(F.broadcast(carry), "_b", "left")
    pkey = (F.struct(*[F.col(p) for p in partition_by]) if partition_by
            else F.struct(F.lit(0).alias("z")))
    same = F.coalesce(pkey == F.col("_fk"), F.lit(False))
    prior_n = F.when(same, F.col("c_n")).otherwise(F.lit(0))
    drop = ["_K", "_b", "_fk", "_rn"] + [f"c_{n}" for n in metrics]
    if row_number is not None or ntile is not None:
        out = out.withColumn("_grn", (F.col("_rn") + prior_n).cast("bigint"))
        drop.append("_grn")
        if row_number is not None:
            out = out.withColumn(row_number, F.col("_grn"))
        if ntile is not None:
            n = ntile[1]
            q, r = n_total // n, n_total % n
            rn = F.col("_grn")
            if q == 0:
                tile = rn
            else:
                tile = F.when(rn <= r * (q + 1), F.floor((rn - 1) / (q + 1)) + 1).otherwise(
                    F.floor((rn - 1 - r * (q + 1)) / q) + r + 1)
            out = out.withColumn(ntile[0], tile.cast("bigint"))
    if running_sum is not None:
        out = out.withColumn(running_sum[1], F.col("_rs") + F.when(same, F.col("c_s"))
                             .otherwise(F.lit(0)))
        drop.append("_rs")
    if lag is not None:
        prev = F.when(same, F.col("c_lv.v"))
        out = out.withColumn(lag[1], F.when(F.col("_rn") == 1, prev).otherwise(F.col("_lag")))
        drop += ["_lag", "c_lv"]
    if rank is not None:
        # Rows of earlier buckets that tie with this row on the rank columns are not ahead.
        rank_keys = [f"_rk{i}" for i in range(rank[1])]
        b2 = bucketed
        for i in range(rank[1]):
            b2 = b2.withColumn(f"_rk{i}", F.col(f"_K._o{i}"))
        carry_eq = _carries(b2, partition_by + rank_keys, {"n": F.count(F.lit(1))})
        carry_eq = carry_eq.select("_b", F.col("_fk").alias("_fk2"), F.col("c_n").alias("c_eq"))
        out = out.join(F.broadcast(carry_eq), "_b", "left")
        key2 = F.struct(*[F.col(p) for p in partition_by],
                        *[F.col(f"_K._o{i}").alias(f"_rk{i}") for i in range(rank[1])])
        same2 = F.coalesce(key2 == F.col("_fk2"), F.lit(False))
        out = out.withColumn(rank[0], (F.col("_rk") + prior_n - F.when(same2, F.col("c_eq"))
                                       .otherwise(F.lit(0))).cast("bigint"))
        drop += ["_rk", "_fk2", "c_eq"]
    return out.drop(*drop, *(["_tie"] if split_ties else []))


def global_rank(df: DataFrame, value: str, tie: str, out: str = "rank",
                descending: bool = True, **kw) -> DataFrame:
    return ordered_window(df, [(value, not descending), (tie, True)], rank=(out, 1), **kw)


def global_ntile(df: DataFrame, value: str, tie: str, n: int, out: str = "ntile",
                 descending: bool = True, **kw) -> DataFrame:
    return ordered_window(df, [(value, not descending), (tie, True)], ntile=(out, n), **kw)


def global_running_sum(df: DataFrame, value: str, tie: str, out: str,
                       descending: bool = True, **kw) -> DataFrame:
    return ordered_window(df, [(value, not descending), (tie, True)],
                          running_sum=(value, out), **kw)
