"""Exact deduplication: an extendible-hash index kept on shared files.

1. Every scan task folds the exact copies it sees itself into one *entry* (hash of the
   normalised text, smallest id, number of rows), comparing bytes, and writes document rows
   and entries to the shared folder.  However many copies a text has, a task adds at most one
   entry of it for each ``flush_bytes`` of distinct text.
2. The directory: a histogram of hash prefixes is split on the driver; a bucket over its
   capacity gives way to two buckets of one bit more, and the directory doubles whenever a
   bucket reaches its depth.  It holds ``entries / capacity`` buckets and no document.
3. Owner tasks get whole buckets, i.e. ranges of hash values, sorted by hash.  Entries of one
   hash form a chain; bytes are compared along it, and equal texts become one group.
4. Every document reads its group through its entry, a key that no more documents share
   than one scan task holds.

Edge cases: a null text is an empty one; a text of white space only becomes one blank, which is
not the empty text; a null ``doc_id`` ranks last (``keep_id`` is null only if the whole group has
null ids); of several rows with the smallest id exactly one is kept; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import WS, doc_text, partitions, same_key, utf8
from tillpoint.operators.persist import BATCH_BYTES, BATCH_ROWS, materialize

_ROWS = ("doc_id long, text_sha256 string, entry long, first boolean, head boolean, h long, "
         "low long, n long, body binary")
_GROUPS = "entry long, bucket long, chain int, keep_id long, keep_entry long, group_size long"
MAX_BUCKETS = 1 << 16
MAX_DEPTH = 22


def normalise(text: bytes) -> bytes:
    """Every run of white space as one blank, leading and trailing ones too."""
    inner = b" ".join(text.split())
    if not text or inner == text:
        return text
    lead = b" " if text[:1].isspace() else b""
    return lead + inner + (b" " if inner and text[-1:].isspace() else b"")


def _entries(flush_bytes: int, key_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, serial = TaskContext.get().partitionId() << 36, 0
        seen: dict[bytes, list] = {}
        size = 0

        names = ("doc_id", "text_sha256", "entry", "first", "head", "h", "low", "n", "body")
        types = [pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(),
                 pa.int64(), pa.int64(), pa.binary()]

        def sent(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*rows), types)], list(names))

        def flush():
            """What is held, in batches as small as those that come in."""
            rows, held = [], 0
            while seen:
                body, (entry, ids) = seen.popitem()
                known = [i for i in ids if i is not None]
                low = min(known) if known else None
                digest = hashlib.sha256(body).hexdigest()
                h = xxhash.xxh64_intdigest(body) >> (64 - key_bits) << (64 - key_bits)
                h -= (h >> 63) << 64
                first = ids.index(low)
                for k, i in enumerate(ids):
                    rows.append((i, digest, entry, k == first, k == 0, h if k == 0 else None, low,
                                 len(ids), body if k == 0 else None))
                    held += len(body) if k == 0 else 0
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield sent(rows)
                        rows, held = [], 0
            if rows:
                yield sent(rows)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                body = normalise(text)
                if (at := seen.get(body)) is None:
                    at = seen[body] = [base + serial, []]
                    serial += 1
                    size += len(body) + 200
                at[1].append(i)
                size += 16
                if size > flush_bytes:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


class Directory:
    """Directory of an extendible hash: 2**depth slots, each naming a bucket.

    Buckets are numbered in the order of their hash ranges.
    """

    def __init__(self, depth: int, slots: np.ndarray, local: list[int]):
        self.depth, self.slots, self.local = depth, slots, local

    @staticmethod
    def build(hashes: DataFrame, capacity: int, max_depth: int = MAX_DEPTH) -> Directory:
        """Split overfull buckets until each fits, from counts of hash prefixes only."""
        total = hashes.count()
        capacity = max(capacity, -(-total // MAX_BUCKETS))
        known = min(max_depth, max(1, (total // capacity).bit_length() + 2))

        def histogram(bits: int) -> np.ndarray:
            rows = (hashes.groupBy(F.shiftrightunsigned("h", 64 - bits).alias("slot")).count()
                    .toArrow())
            counts = np.zeros(1 << bits, np.int64)
            counts[rows["slot"].to_numpy()] = rows["count"].to_numpy()
            return counts

        counts, leaves, todo = histogram(known), [], [(0, 0)]
        while todo:
            depth, prefix = todo.pop()
            if depth > known:
                known = min(max_depth, known + 4)
                counts = histogram(known)
            width = 1 << (known - depth)
            held = int(counts[prefix * width:(prefix + 1) * width].sum())
            if held > capacity and depth < max_depth:
                todo += [(depth + 1, 2 * prefix), (depth + 1, 2 * prefix + 1)]
            else:
                leaves.append((depth, prefix))
        deepest = max(d for d, _ in leaves)
        leaves.sort(key=lambda x: x[1] << (deepest - x[0]))
        slots = np.repeat(np.arange(len(leaves)), [1 << (deepest - d) for d, _ in leaves])
        return Directory(deepest, slots, [d for d, _ in leaves])

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame(pa.table({
            "slot": pa.array(np.arange(len(self.slots)), pa.int64()),
            "bucket": pa.array(self.slots, pa.int64())}))


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the bytes of the entries of each hash; rows come sorted by bucket and hash."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["entry", "bucket", "chain", "keep_id", "keep_entry", "group_size"]
    at, chain, out = None, {}, []

    def close():
        for k, (_, members) in enumerate(sorted(chain.items(), key=lambda x: x[1][0][0])):
            low = min(((m[1] is None, m[1] or 0, m[0]) for m in members))
            size = sum(m[2] for m in members)
            for entry, _, _ in members:
                out.append((entry, at[0], k, None if low[0] else low[1], low[2], size))

    def batch():
        cols = list(zip(*out)) or [[]] * 6
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    for b in batches:
        keys = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
        small = zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist())
        for key, member, body in zip(keys, small, utf8(b.column(5))):
            if key != at:
                close()
                chain.clear()
                at = key
            chain.setdefault(body, []).append(member)  # a dict compares the bytes
        if len(out) >= 10_000:
            yield batch()
    close()
    if out:
        yield batch()


def exact_groups(docs: DataFrame, capacity: int = 8192, flush_bytes: int = 32 << 20,
                 key_bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    ``capacity``: entries of a bucket before it splits (more only above 65,536 buckets).
    ``flush_bytes``: distinct text a scan task holds.  ``key_bits``: leading hash bits in use.
    """
    spark = docs.sparkSession
    rows = materialize(doc_text(docs).mapInArrow(_entries(flush_bytes, key_bits), _ROWS),
                       "dedup-rows")
    heads = rows.filter("head").select("entry", "h", "low", "n", "body")
    directory = Directory.build(heads.select("h").distinct(), capacity)
    slot = F.shiftrightunsigned("h", 64 - directory.depth) if directory.depth else F.lit(0)
    owned = (heads.withColumn("slot", slot.cast("long")).join(directory.frame(spark), "slot")
             .select("bucket", "h", "entry", "low", "n", "body")
             .repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "h"))
    index = materialize(owned.mapInArrow(_chains, _GROUPS), "dedup-index")
    return rows.select("doc_id", "text_sha256", "entry", "first").join(index, "entry").select(
        "doc_id", "keep_id", "group_size",
        (F.col("first") & (F.col("entry") == F.col("keep_entry"))).alias("kept"),
        "text_sha256", "bucket", "chain")


def drop_copies(docs: DataFrame, **parameters) -> DataFrame:
    """The documents that stay, with all their columns.

    Of rows that share both id and normalised text one stays; rows that share only the id are
    judged each by its own text.  Columns of any name pass through.
    """
    groups = materialize(exact_groups(docs, **parameters).select(
        F.col("doc_id").alias("k"), F.col("text_sha256").alias("sha"), "kept"), "dedup-groups")
    kept = groups.filter("kept").select("k", "sha")
    repeated = materialize(groups.groupBy("k").count().filter("count > 1").select("k"), "dedup-repeated")
    # A document is one struct, so none of its columns can be mistaken for one of these.
    whole = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("k"))
    if repeated.isEmpty():
        return same_key(whole, kept, ["k"], "left_semi").select("doc.*")
    body = F.regexp_replace(F.coalesce(F.col("doc.text").cast("string"), F.lit("")), WS, " ")
    once = same_key(same_key(whole, repeated, ["k"], "left_anti"), kept, ["k"], "left_semi")
    again = same_key(same_key(whole, repeated, ["k"], "left_semi").withColumn("sha", F.sha2(body, 256)),
                     kept, ["k", "sha"], "left_semi").dropDuplicates(["k", "sha"])
    return once.select("doc.*").unionByName(again.select("doc.*"))
