"""Keyed upsert (MERGE) of an incremental batch into a table, with a change feed.

The target is only filtered by the batch's keys: an anti join keeps the rows the batch does
not touch, a semi join finds those it does, and everything else is batch-sized.  Both joins keep
the target on the probe side, so a small batch is broadcast and the target is not shuffled.  The
batch is checked for repeated keys with one partial aggregation.  A NULL key never matches and is
inserted; columns of updated rows take the batch value even when it is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.operators.persist import materialize

OPS = ("update", "insert", "unchanged")


def make_batch(target: DataFrame, key: str, value: str | list[str], update_every: int = 75,
               insert_every: int = 100, insert_offset: int = 1, factor: str = "1.1") -> DataFrame:
    """A deterministic incremental batch derived from the target.

    Updates: rows whose key is a multiple of ``update_every`` with ``value`` (one column or
    several) revised by ``factor`` (rounded to cents).  Inserts: copies of rows whose key leaves remainder
    ``insert_offset`` modulo ``insert_every``, moved to new keys above the current maximum.
    """
    k = F.col(key)
    revised = {v: F.round(F.col(v).cast("decimal(18,2)") * F.lit(factor).cast("decimal(4,2)"),
                          2).cast("double") for v in ([value] if isinstance(value, str) else value)}
    updates = target.filter(F.pmod(k, F.lit(update_every)) == 0).withColumns(revised)
    top = target.agg(F.max(k)).scalar()
    inserts = (target.filter(F.pmod(k, F.lit(insert_every)) == insert_offset)
               .withColumn(key, k + top + 1))
    return updates.unionByName(inserts)


def _checked(batch: DataFrame, key: str) -> DataFrame:
    """Fail the job if a non-NULL key repeats in the batch (one partial aggregation)."""
    k = F.col(key)
    repeated = (batch.filter(k.isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") > 1).agg(F.count(F.lit(1)))).scalar()
    return batch.filter(F.assert_true(repeated == 0,
                                      F.lit(f"duplicate {key} in merge batch")).isNull())


def feed(target: DataFrame, batch: DataFrame, key: str, check_unique: bool = True) -> DataFrame:
    """The batch's rows with ``_op`` (update or insert) and the target's ``_old_`` values."""
    b = _checked(batch, key) if check_unique else batch
    cols = target.columns
    hit = target.join(batch.select(key), key, "left_semi").select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_old_{c}") for c in cols])
    op = F.when(F.col("_key").isNotNull(), F.lit("update")).otherwise(F.lit("insert"))
    return b.join(hit, F.col(key) == F.col("_key"), "left").select(
        *cols, op.alias("_op"), *[f"_old_{c}" for c in cols])


def upsert(target: DataFrame, batch: DataFrame, key: str, check_unique: bool = True) -> DataFrame:
    """Merged rows (target columns) plus ``_op`` in {update, insert, unchanged} and old values."""
    cols = target.columns
    kept = target.join(batch.select(key), key, "left_anti").select(
        *cols, F.lit("unchanged").alias("_op"), *[F.col(c).alias(f"_old_{c}") for c in cols])
    return kept.unionByName(feed(target, batch, key, check_unique))


def merged(result: DataFrame) -> DataFrame:
    return result.select(*[c for c in result.columns if not c.startswith("_")])


def changes(result: DataFrame, key: str, value: str) -> DataFrame:
    """Change feed: updated and inserted rows with the old and new value."""
    return (result.filter(F.col("_op") != "unchanged")
            .select(key, F.col("_op").alias("op"), F.col(f"_old_{value}").alias(f"old_{value}"),
                    F.col(value).alias(f"new_{value}")))


def validation(target: DataFrame, result: DataFrame, batch: DataFrame, key: str,
               value: str) -> DataFrame:
    """One row: counts before / after, inserted / updated / unchanged, repeated keys after the
    merge, and whether every updated row carries the batch value.

    The merge result is read by several checks, so it is written once and re-read."""
    result = materialize(result, "merge-result")
    before = target.agg(F.count(F.lit(1))).scalar()
    dup_after = (result.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                 .filter(F.col("n") > 1).agg(F.count(F.lit(1)))).scalar()
    b = batch.select(F.col(key), F.col(value).alias("_bv"))
    spot = (result.filter(F.col("_op") == "update").join(b, key)
            .agg(F.coalesce(F.bool_and(F.col(value).eqNullSafe(F.col("_bv"))), F.lit(True)))
            ).scalar()
    agg = result.agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.count_if(F.col("_op") == "insert").alias("inserted"),
        F.count_if(F.col("_op") == "update").alias("updated"),
        F.count_if(F.col("_op") == "unchanged").alias("unchanged"))
    return agg.select(before.alias("rows_before"), "rows_after", "inserted", "updated",
                      "unchanged", dup_after.alias("duplicate_keys_after"),
                      spot.alias("updated_values_match"))
