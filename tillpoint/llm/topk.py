"""Exact top-k by inner product: no-random-access aggregation over sorted lists.

Vectors become integers, floor(256 x).  Candidates lie in blocks of at most ``block_rows`` rows; a
block keeps, for each component, the order of its rows by value: one sorted list a component.  A
query q reads list j from its top where q_j > 0 and from its bottom where q_j < 0 (and not where it
is 0), so contributions q_j x_j come in falling order.  All its lists are read on, ``chunk`` entries at
a time, and each entry is added to its row where it comes up; no row is looked up:

* lower bound of a row: what its entries so far give, and for each list in which it has not come up
  the least that the list's far end can give;
* upper bound: the same with the value that the list has reached for each of those;
* a row whose upper bound is below the query's k-th best lower bound is out.  No upper bound is below
  the sum of what the lists have reached, so bounds are compared only once that sum is below.

Reading stops when no more rows are left than are to be found, or than are worth another chunk;
final scores of the rows left come from one pass over their stored vectors.  The k-th best score of
a query so far carries over to the next blocks of a task as its threshold, and a block none of whose rows
can reach it is left before the first entry.  A query block first meets one shard alone; what its
queries reach there is the threshold with which they begin in every shard.

The queries are a stated set.  They meet the candidates block by block: candidate blocks are dealt
to shards, each query block goes to every shard once, and the k best rows of every pair of blocks
are merged by query.  A task holds one block of each side and the thresholds of one query
block (those of the query blocks that begin in its shard, in the first pass).

On dense vectors of little spread the bounds meet late, after half of the entries or more, so fewer
entries are read than a full product has terms, but each costs more than a term.

Edge cases: vectors that are null or hold null or non-finite components take no part; only vectors of
one length are compared; empty vectors score 0 with each other; a query with fewer candidates than k
gets all; rows that share a vec_id are separate candidates, and a query row excludes itself only; a
row without a vec_id is no query, but a candidate, behind all others of its score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import partitions
from tillpoint.operators.persist import materialize

_BLOCK = "block long, dim int, rids binary, ids binary, named binary, rows binary"
LOWEST = np.iinfo(np.int64).min // 2
_FOUND = "query_rid long, query_id long, rid long, vec_id long, score long"


def _blocks(block_rows: int):
    """Pack rows (rid, vec_id, v) into blocks of one vector length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 36
        held: dict[int, list] = {}

        def block(dim, rows):
            nonlocal at
            at += 1
            rids, ids, vectors = zip(*rows)
            values = np.array(vectors, "<i8").reshape(len(rows), dim)
            return pa.RecordBatch.from_pydict({
                "block": [at], "dim": pa.array([dim], pa.int32()),
                "rids": [np.array(rids, "<i8").tobytes()],
                "ids": [np.array([i or 0 for i in ids], "<i8").tobytes()],
                "named": [np.array([i is not None for i in ids]).tobytes()], "rows": [values.tobytes()]})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                rows = held.setdefault(len(row[2]), [])
                rows.append(row)
                if len(rows) == block_rows:
                    yield block(len(row[2]), held.pop(len(row[2])))
        for dim, rows in held.items():
            yield block(dim, rows)

    return run


class Lists:
    """The sorted lists of a block of candidates: all from the top, then all from the bottom."""

    mask_bytes = 96 << 20  # of kept masks

    def __init__(self, rids: bytes, ids: bytes, named: bytes, rows: bytes, dim: int):
        self.rids, self.ids = np.frombuffer(rids, "<i8"), np.frombuffer(ids, "<i8")
        self.named = np.frombuffer(named, bool)
        self.x = np.frombuffer(rows, "<i8").reshape(len(self.rids), dim)
        self.largest = int(np.abs(self.x).max(initial=0))
        order = np.argsort(self.x, axis=0, kind="stable").T
        values = np.take_along_axis(self.x.T, order, 1)
        self.order = np.vstack([order[:, ::-1], order])
        self.values = np.vstack([values[:, ::-1], values])
        place = np.empty(self.order.shape, np.int32)
        np.put_along_axis(place, self.order, np.arange(len(self.x), dtype=np.int32)[None, :], 1)
        self.place = np.ascontiguousarray(place.T)
        self.block, self.cuts = None, {}
        self.masks: dict[int, np.ndarray] = {}

    def cut(self, chunk: int, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows and gains (what an entry has above its list's far end), one line a list and chunk;
        and the values that each list has reached at the start and at the end of each chunk.

        Lists are filled up with a row behind the last one, which gains nothing.
        """
        if (chunk, kind) not in self.cuts:
            n = len(self.x)
            more = -n % chunk
            gains = self.values - self.values[:, -1:]
            ends = np.minimum(np.arange(0, n + more + 1, chunk), n) - 1
            self.cuts = {(chunk, kind): (
                np.pad(self.order, ((0, 0), (0, more)), constant_values=n).reshape(-1, chunk),
                np.pad(gains, ((0, 0), (0, more))).astype(kind).reshape(-1, chunk),
                self.values[:, np.maximum(ends, 0)].astype(kind))}
        return self.cuts[chunk, kind]

    def unread(self, depth: int) -> np.ndarray:
        """1 for each row and list in which it has not come up among the first ``depth`` entries."""
        if depth not in self.masks:
            mask = (self.place >= depth).astype(np.float32)
            if sum(m.nbytes for m in self.masks.values()) + mask.nbytes > self.mask_bytes:
                return mask
            self.masks[depth] = mask
        return self.masks[depth]


class Work:
    """Entries read and vectors resolved, to compare with a full product."""

    def __init__(self):
        self.entries = self.resolved = 0


def _added(rows: np.ndarray, amounts: np.ndarray, n: int, exact: bool) -> np.ndarray:
    """Sum of the amounts of each row; whole numbers below 2**53 are exact in a double."""
    if exact:
        return np.bincount(rows.ravel(), amounts.ravel(), n)
    out = np.zeros(n, np.int64)
    np.add.at(out, rows, amounts)
    return out


def nra(lists: Lists, q: np.ndarray, own: int, k: int, floor: int, chunk: int = 256,
        work: Work | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(candidate rows, scores) of one query: at least the k best rows that reach ``floor``.

    ``own``: row id of the query, never its own candidate.  ``floor``: a score that k other
    candidates already reach.
    """
    n, work = len(lists.x), work or Work()
    alive = np.flatnonzero(lists.rids != own)
    if not len(alive):
        return alive, np.empty(0, np.int64)
    falling, rising = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
    columns = np.concatenate([falling, rising + len(q)])
    exact = lists.largest * int(np.abs(q).max(initial=0)) * max(1, len(q)) < 2**52
    kind = np.float64 if exact else np.int64
    order, gains, values = lists.cut(chunk, kind)
    weights = np.concatenate([q[falling], q[rising]]).astype(kind)[:, None]
    # What the lists give together at the end of each chunk; no unread row has more.
    reached = values.take(columns, axis=0) * weights
    sums, far, chunks = reached.sum(axis=0), reached[:, -1], reached.shape[1] - 1
    if sums[0] < floor:
        return alive[:0], np.empty(0, np.int64)
    lower, at, kth = np.full(n + 1, far.sum()), 0, floor
    while at < chunks and len(columns) and len(alive) > max(k, chunk):
        # On to the next chunk, or to the first one behind which the threshold puts rows out.
        low = np.flatnonzero(sums[1:] < floor)
        end = max(at + 1, low[0] + 1 if len(low) else 0)
        lines = (columns[:, None] * chunks + np.arange(at, end)).ravel()
        rows, given = order.take(lines, axis=0), gains.take(lines, axis=0)
        given.reshape(len(columns), -1)[:] *= weights
        work.entries += len(columns) * (min(n, end * chunk) - at * chunk)
        lower += _added(rows, given, n + 1, exact)
        at = int(end)
        best = lower[alive]
        kth = max(floor, int(np.partition(best, len(best) - k)[len(best) - k]))
        if sums[at] < kth:
            gap, depth = reached[:, at] - far, min(n, at * chunk)
            if exact:
                # In single precision, with more than its rounding on top: no bound gets too low.
                open_ = np.zeros(2 * len(q), np.float32)
                open_[columns] = gap
                unread = lists.unread(depth)
                more = ((unread @ open_)[alive] if 2 * len(alive) > n
                        else unread.take(alive, axis=0) @ open_)
                more += np.float32(gap.sum() * (len(q) + 4) * 2.0**-22)
            else:
                more = (lists.place[alive[:, None], columns] >= depth) @ gap
            alive = alive[best + more >= kth]
    work.resolved += len(alive)
    return alive, lists.x[alive] @ q


def _best(lists: Lists, rows: np.ndarray, scores: np.ndarray, k: int):
    """The k best of some rows; ties go to smaller ids, rows without an id last."""
    if len(rows) > k:
        rows, scores = (v[scores >= np.partition(scores, len(scores) - k)[len(scores) - k]]
                        for v in (rows, scores))
        order = np.lexsort((lists.ids[rows], ~lists.named[rows], -scores))[:k]
        rows, scores = rows[order], scores[order]
    return rows, scores


def _met(row: dict, lists: Lists | None) -> tuple:
    """Row ids, ids and vectors of a query block and the lists of the block that it meets."""
    if lists is None or row["block"] != lists.block:
        lists = Lists(row["rids"], row["ids"], row["named"], row["rows"], row["dim"])
        lists.block = row["block"]
    own, names = np.frombuffer(row["q_rids"], "<i8"), np.frombuffer(row["q_ids"], "<i8")
    return lists, own, names, np.frombuffer(row["q_rows"], "<i8").reshape(len(own), row["dim"])


def _first(k: int, chunk: int):
    """For each query block the k-th best score of its queries in the blocks that it meets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, kept = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                lists, own, _, queries = _met(row, lists)
                known = kept.setdefault(row["q_block"], np.full((len(own), k), LOWEST))
                for i, q in enumerate(queries):
                    scores = nra(lists, q, own[i], k, known[i, 0], chunk)[1]
                    known[i] = np.sort(np.concatenate([known[i], scores]))[-k:]
        yield pa.RecordBatch.from_pydict({
            "q_block": pa.array(kept, pa.int64()),
            "floors": pa.array([v[:, 0].tobytes() for v in kept.values()], pa.binary())})

    return run


def _search(k: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, q_block, kept = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                lists, own, names, queries = _met(row, lists)
                if row["q_block"] != q_block:
                    q_block, kept = row["q_block"], np.full((len(own), k), LOWEST)
                    if row["floors"] is not None:
                        kept[:] = np.frombuffer(row["floors"], "<i8")[:, None]
                out: list[tuple] = []
                for i, q in enumerate(queries):
                    found, scores = _best(lists, *nra(lists, q, own[i], k, kept[i, 0], chunk), k)
                    out += [(int(own[i]), int(names[i]), int(lists.rids[r]),
                             int(lists.ids[r]) if lists.named[r] else None, int(score))
                            for r, score in zip(found, scores)]
                    kept[i] = np.sort(np.concatenate([kept[i], scores]))[-k:]
                columns = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 ["query_rid", "query_id", "rid", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = 4096, query_rows: int = 512,
          scale: int = 256, chunk: int = 256) -> DataFrame:
    """Per query its k best candidates: query_id, rank (from 1), vec_id, score; ties to smaller id.

    ``is_query``: condition on ``vectors`` that states the query set.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    known = materialize(
        vectors.filter(v.isNotNull()).filter(finite)
        .select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"),
                F.coalesce(is_query, F.lit(False)).alias("is_query"))
        .withColumn("rid", F.monotonically_increasing_id()), "topk-vectors")
    n = partitions(spark)
    rows = known.select("rid", "vec_id", "v")
    blocks = materialize(
        rows.repartition(n, "rid").mapInArrow(_blocks(block_rows), _BLOCK)
        .withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(n))), "topk-blocks")
    asked = (known.filter("is_query and vec_id is not null").select("rid", "vec_id", "v")
             .repartition(max(1, n // 4), "rid").mapInArrow(_blocks(query_rows), _BLOCK))
    asked = materialize(asked.select(
        F.col("block").alias("q_block"), "dim", F.col("rids").alias("q_rids"),
        F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows")), "topk-queries")
    # Each query block first meets one shard, for thresholds to begin with in all the others.
    once = asked.withColumn("shard", F.pmod(F.xxhash64("q_block"), F.lit(n)))
    floors = materialize(
        once.join(blocks.hint("merge"), ["shard", "dim"]).mapInArrow(
            _first(k, chunk), "q_block long, floors binary"), "topk-floors")
    everywhere = asked.join(floors, "q_block", "left").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    # Query blocks are the streamed side: each meets all blocks of its shard one after the other, so
    # the thresholds of one query block are held at a time.
    met = everywhere.withColumn("shard", F.col("shard").cast("long")).join(
        blocks.hint("merge"), ["shard", "dim"])
    found = materialize(met.mapInArrow(_search(k, chunk), _FOUND), "topk-found")
    order = Window.partitionBy("query_rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
