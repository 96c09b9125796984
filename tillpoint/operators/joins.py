"""Joins of a large fact table with a selected part of its parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Selected rows up to which they are broadcast whole; words of the filter beyond that (16 bytes each).
BROADCAST_ROWS = 500_000
FILTER_WORDS = 1 << 20


def _word_and_mask(key: str, words: int) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    bits = [F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int") for at in (40, 52)]
    one = F.lit(1).cast("long")
    mask = F.expr("0L")
    for b in bits:
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, b))
    return F.pmod(h, F.lit(words)), mask


def filter_words(selected: DataFrame, key: str, words: int = FILTER_WORDS) -> DataFrame:
    """A Bloom filter of the keys, (_word, _bits): 64 bits to a word, two bits to a key.

    It is built by one aggregation, and its size does not depend on the data.
    """
    word, mask = _word_and_mask(key, words)
    return selected.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(
        F.bit_or("_mask").alias("_bits"))


def may_hold(facts: DataFrame, bits: DataFrame, key: str, flag: str,
             words: int = FILTER_WORDS) -> DataFrame:
    """``facts`` with a column that is false only where the key is not in the filter."""
    word, mask = _word_and_mask(key, words)
    held = facts.withColumns({"_word": word, "_mask": mask}).join(
        F.broadcast(bits), "_word", "left")  # at most ``words`` rows of 16 bytes
    return held.withColumn(flag, F.coalesce(
        F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))).drop(
        "_word", "_mask", "_bits")


def reduce_facts(facts: DataFrame, selected: DataFrame, key: str,
                 words: int = FILTER_WORDS) -> DataFrame:
    """``facts`` without most rows whose key is not selected; every selected key stays."""
    word, mask = _word_and_mask(key, words)
    held = facts.withColumns({"_word": word, "_mask": mask})
    return (held.join(F.broadcast(filter_words(selected, key, words)), "_word")
            .filter(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"))
            .drop("_word", "_mask", "_bits"))


def join_selected(facts: DataFrame, selected: DataFrame, key: str,
                  broadcast_rows: int = BROADCAST_ROWS, words: int = FILTER_WORDS) -> DataFrame:
    """Inner join on ``key`` that never moves the facts of other keys.

    ``selected`` is a written table of a few narrow columns, so counting it reads its footers only.
    Up to ``broadcast_rows`` rows it goes to the facts; beyond, the facts are reduced
    where they are read, and what is left is joined by a shuffle.
    """
    if selected.count() <= broadcast_rows:
        return facts.join(F.broadcast(selected), key)
    return reduce_facts(facts, selected, key, words).join(selected, key)
