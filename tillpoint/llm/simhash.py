"""SimHash near-duplicates: pigeonring filtering before the full Hamming check.

A fingerprint of 64 bits is laid out as a ring of ``segments`` segments.  If two fingerprints
differ in at most t bits, then some segment starts a chain of consecutive segments in which, for
every length l, the first l segments differ in at most ``l * t / segments`` bits together (the
pigeonring principle, Qin and Xiao, VLDB 2018).  The first seven budgets for t = 4 and ten
segments are 0 0 1 1 2 2 2, so of the first seven segments at least five are equal, in one of nine
layouts.  Each fingerprint is filed under its 9 x 10 masked values; two fingerprints meet only if
they agree on about 32 bits laid out in that way.  Candidates must have a whole viable chain, then
pass the Hamming check.

Equal fingerprints are folded before anything else.  A masked value that more than
``bucket_limit`` different fingerprints share is not paired (a task passes on its rows as they
come, in constant memory): its fingerprints are filed under all
values within t/2 bits instead.  Two fingerprints differ in at most t bits exactly if they share
such a value, and every holder is linked to one of them, so that path is exact and its rows grow
with the group, not with its square.

Edge cases: a null, empty or blank text has no words and fingerprint zero, which is linked like any
other; a text of fewer words than a shingle is one shingle; rows with equal ids each get their
own row; a component without any id has a null ``component_id``; an empty table gives no row.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import (
    connected_components, doc_text, partitions, same_key, unsigned_hex, utf8)
from tillpoint.operators.persist import materialize

BITS = 64
SEED = 42


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned 64-bit SimHash of one UTF-8 text."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())),
        np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 15):
        part = hashes[k:k + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp): the fingerprint's bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in utf8(batch.column(1))),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64), pa.int64())], ["doc_id", "fp"])

    return doc_text(docs).mapInArrow(run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - ((x >> 63) << 64)


def segment_masks(segments: int) -> list[int]:
    edges = [round(BITS * k / segments) for k in range(segments + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def chain_masks(segments: int, distance: int, prefix: int) -> list[int]:
    """Masks of the segments that a viable chain of ``prefix`` segments leaves equal."""
    parts = segment_masks(segments)
    budget = [(k + 1) * distance // segments for k in range(prefix)]
    masks = set()
    for differing in combinations(range(prefix), budget[-1]):
        if all(sum(d <= k for d in differing) <= budget[k] for k in range(prefix)):
            for start in range(segments):
                masks.add(sum(parts[(start + k) % segments]
                              for k in range(prefix) if k not in differing))
    return sorted(masks)


def viable_chain(difference: np.ndarray, segments: int, distance: int) -> np.ndarray:
    """Where some segment starts a chain that keeps every proportional budget."""
    counts = np.stack([np.bitwise_count(difference & np.uint64(m)).astype(np.int64)
                       for m in segment_masks(segments)])
    found = np.zeros(len(difference), bool)
    for start in range(segments):
        total, held = np.zeros(len(difference), np.int64), np.ones(len(difference), bool)
        for k in range(segments):
            total += counts[(start + k) % segments]
            held &= total <= (k + 1) * distance // segments
        found |= held
    return found


def _meet(segments: int, distance: int, masks: list[int], low: int, bucket_limit: int):
    """Rows (k, fp) sorted by k to verified pairs (a, b) of one k; b is null for crowded ones.

    The ``low`` last bits of k number its mask.  A pair that agrees under several masks is
    reported under the first of them alone.
    """
    ordered = np.array(masks, np.uint64)

    def verified(a, b, k) -> tuple[np.ndarray, np.ndarray]:
        x = (a ^ b).view(np.uint64)
        keep = np.flatnonzero(viable_chain(x, segments, distance))
        keep = keep[np.bitwise_count(x[keep]) <= distance]
        first = ((x[keep, None] & ordered) == 0).argmax(axis=1)
        keep = keep[first == (k[keep] & ((1 << low) - 1))]
        return np.minimum(a[keep], b[keep]), np.maximum(a[keep], b[keep])

    def batch(a, b=None) -> pa.RecordBatch:
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_fp = np.empty(0, np.int64), np.empty(0, np.int64)
        crowded = None  # the key whose first rows went out as crowded already
        for b in itertools.chain(batches, [None]):
            if b is None:
                k, fp, whole = rest_k, rest_fp, len(rest_k)
            else:
                k = np.concatenate([rest_k, b.column(0).to_numpy()])
                fp = np.concatenate([rest_fp, b.column(1).to_numpy()])
                whole = int(np.searchsorted(k, k[-1])) if len(k) else 0  # the last key may go on
                if len(k) - whole > bucket_limit:
                    whole = len(k)
            k, fp, rest_k, rest_fp = k[:whole], fp[:whole], k[whole:], fp[whole:]
            if not len(k):
                continue
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            size = np.diff(np.append(first, len(k)))
            late = (k[first] == crowded) if crowded is not None else np.zeros(len(first), bool)
            many = (size > bucket_limit) | late
            for at, n in zip(first[many], size[many]):
                yield batch(fp[at:at + n])
                crowded = k[at]
            two = first[(size == 2) & ~many]
            left, right, key = [fp[two]], [fp[two + 1]], [k[two]]
            for at, n in zip(first[(size > 2) & ~many], size[(size > 2) & ~many]):
                i, j = np.triu_indices(n, 1)
                part = fp[at:at + n]
                close = np.bitwise_count((part[i] ^ part[j]).view(np.uint64)) <= distance
                left.append(part[i[close]])
                right.append(part[j[close]])
                key.append(np.full(len(left[-1]), k[at]))
            yield batch(*verified(*map(np.concatenate, (left, right, key))))

    return run


def links(fps: DataFrame, distance: int, segments: int, prefix: int,
          bucket_limit: int) -> DataFrame:
    """Links (a, b) between different fingerprints ``fps(fp)`` with the right components.

    Every pair within ``distance`` bits is linked, directly or, in crowded buckets, through a
    third fingerprint; no pair beyond it is linked directly.
    """
    masks = chain_masks(segments, distance, prefix)
    low = len(masks).bit_length()
    listed = F.array(*[F.struct(F.lit(_signed(m)).alias("m"), F.lit(k).alias("k"))
                       for k, m in enumerate(masks)])
    filed = fps.select(F.explode(F.transform(listed, lambda x: F.shiftleft(F.xxhash64(
        x["m"], F.col("fp").bitwiseAND(x["m"])), low).bitwiseOR(x["k"]))).alias("k"), "fp")
    met = materialize(
        filed.repartition(partitions(fps.sparkSession), "k").sortWithinPartitions("k")
        .mapInArrow(_meet(segments, distance, masks, low, bucket_limit), "a long, b long")
        .distinct(), "simhash-met")
    pairs = met.filter("b is not null")

    near, far = distance // 2, distance - distance // 2
    flips = [(sum(1 << b for b in bits), k <= near)
             for k in range(far + 1) for bits in combinations(range(BITS), k)]
    around = F.expr("array(" + ",".join(
        f"named_struct('x', {_signed(x)}L, 'near', {str(c).lower()})".replace(
            "-9223372036854775808L", "shiftleft(1L, 63)") for x, c in flips) + ")")
    crowd = met.filter("b is null").select(F.col("a").alias("fp"))
    balls = (crowd.select("fp", F.explode(around).alias("f"))
             .select("fp", F.col("fp").bitwiseXOR(F.col("f.x")).alias("z"), "f.near")
             .groupBy("z").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("a"),
                               F.collect_list("fp").alias("all"))
             .filter(F.col("a").isNotNull() & (F.size("all") > 1)))
    stars = (balls.select("a", F.explode("all").alias("b")).filter("a <> b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return pairs.unionByName(stars)


def _members(docs: DataFrame, shingle: int, distance: int, segments: int, prefix: int,
             bucket_limit: int) -> DataFrame:
    """(doc_id, fp, component, component_id) for each row; ``component`` is a fingerprint of it."""
    rows = materialize(fingerprints(docs, shingle), "simhash-rows")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-fps")
    found = links(fps.select("fp"), distance, segments, prefix, bucket_limit)
    parts = connected_components(found, "simhash")
    member = fps.join(parts, fps["fp"] == parts["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    lowest = member.groupBy("component").agg(F.min("low").alias("component_id"))
    named = materialize(member.join(lowest, "component").select("fp", "component", "component_id"),
                        "simhash-named")
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, segments: int = 10,
                    prefix: int = 7, bucket_limit: int = 256) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    return _members(docs, shingle, distance, segments, prefix, bucket_limit).select(
        "doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, segments: int = 10,
                         prefix: int = 7, bucket_limit: int = 256) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Of several rows with that id the smallest fingerprint decides, then any.  Columns of any name
    pass through.
    """
    members = materialize(_members(docs, shingle, distance, segments, prefix, bucket_limit),
                          "simhash-members")
    # Nulls come last: a component without any id still keeps a row.
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("k"), "fp")
    kept = members.groupBy("component").agg(F.min(first).alias("x")).select("x.k", "x.fp")
    repeated = materialize(members.groupBy(F.col("doc_id").alias("k")).count().filter("count > 1")
                           .select("k"), "simhash-repeated")
    # A document is one struct, so none of its columns can be mistaken for one of these.
    whole = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("k"))
    if repeated.isEmpty():
        return same_key(whole, kept, ["k"], "left_semi").select("doc.*")
    once = same_key(same_key(whole, repeated, ["k"], "left_anti"), kept, ["k"], "left_semi")

    @F.pandas_udf("long")
    def marked(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t.encode(), shingle)) for t in texts], dtype="int64")

    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    again = same_key(whole, repeated, ["k"], "left_semi").withColumn(
        "fp", marked(text))
    again = same_key(again, kept, ["k", "fp"], "left_semi").dropDuplicates(["k", "fp"])
    return once.select("doc.*").unionByName(again.select("doc.*"))
