import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tillpoint.llm.topk import Lists, Work, _first, nra, top_k


def brute(rows, k=5, every=50):
    good = [(n, i, tuple(int(np.floor(256 * float(x))) for x in v)) for n, (i, v) in enumerate(rows)
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, i, q in good:
        if i is not None and i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for m, j, v in good
                           if m != n and len(v) == len(q))[:k]
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(found)]
    return sorted(out, key=str)


def got(df, **kw):
    return sorted(map(tuple, top_k(df, F.pmod("vec_id", F.lit(50)) == 0, **kw)
                      .select("query_id", "rank", "vec_id", "score").collect()), key=str)


@pytest.mark.parametrize("blocks", [dict(), dict(block_rows=32, query_rows=2)])
def test_whole_table(spark, blocks):
    df = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/embeddings.parquet")
    assert got(df, **blocks) == brute([(r.vec_id, r.embedding) for r in df.collect()])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [0.5, -0.25]), (2, None), (3, [nan, 1.0]),
            (4, [inf, 1.0]), (5, [None, 1.0]), (50, []), (51, []), (100, [1.0]), (7, [1.0, 2.0]),
            (8, [1.0, 2.0]), (None, [9.0, 9.0]), (None, [1.0, 2.0]), (None, None), (150, [-1e6, 1e6]), (9, [1e6, -1e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn(
        "score", F.lit(0))
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == []


def lists_of(x):
    ids = np.arange(len(x), dtype="<i8").tobytes()
    return Lists(ids, ids, np.ones(len(x), bool).tobytes(), x.astype("<i8").tobytes(), x.shape[1])


def read(x, queries, k, chunk, floor=None):
    """Work of all queries, whose best rows are compared with a full product."""
    lists, work = lists_of(x), Work()
    lowest = np.iinfo(np.int64).min // 2
    for i, q in enumerate(queries):
        rows, scores = nra(lists, q, i, k, lowest if floor is None else floor[i], chunk, work)
        full = x @ q
        assert (full[rows] == scores).all() and i not in rows
        best = sorted(np.delete(full, i), reverse=True)[:k]
        want = [s for s in best if floor is None or s >= floor[i]]
        assert sorted(scores.tolist(), reverse=True)[:len(want)] == want
    return work


def test_reading_stops_early_and_loses_nothing():
    rng = np.random.default_rng(0)
    x = rng.integers(-3, 4, (400, 12))
    x[:6] *= 200  # clear winners
    work = read(x, x[:4], 3, 16)
    assert work.entries + 12 * work.resolved < 0.5 * 4 * x.size


def test_work_is_below_a_full_product():
    """Entries read and rows resolved, for unit vectors of 64 components and for skewed ones."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4096, 64))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    floors = [np.sort(np.delete(x @ q, i))[-5] for i, q in enumerate(x[:20])]
    for kw in (dict(), dict(floor=floors)):
        work = read(x, x[:20], 5, 256, **kw)
        assert work.entries + 64 * work.resolved < 0.9 * 20 * x.size
    skewed = np.floor(10 * rng.pareto(1.2, (4096, 16))).astype(np.int64)
    work = read(skewed, skewed[:20], 5, 256)
    assert work.entries + 16 * work.resolved < 0.3 * 20 * skewed.size


def test_block_below_the_threshold_is_not_read():
    x = np.ones((100, 4), np.int64)
    lists, work = lists_of(x), Work()
    rows, _ = nra(lists, np.ones(4, np.int64), -1, 5, 5, 16, work)
    assert len(rows) == work.entries == work.resolved == 0


def test_thresholds_of_the_first_shard():
    """What a query block carries to all shards is the k-th best score of each of its queries."""
    x = np.random.default_rng(2).integers(-9, 10, (700, 8))
    packed = dict(dim=8, named=np.ones(700, bool).tobytes(), rows=x.astype("<i8").tobytes(), block=1,
                  **{c: np.arange(700, dtype="<i8").tobytes() for c in ("rids", "ids")})
    asked = dict(q_block=5, q_rids=np.arange(20, dtype="<i8").tobytes(),
                 q_ids=np.arange(20, dtype="<i8").tobytes(), q_rows=x[:20].astype("<i8").tobytes())
    [found] = _first(3, 64)(iter([pa.RecordBatch.from_pylist([packed | asked])]))
    floors = np.frombuffer(found["floors"][0].as_py(), "<i8")
    assert floors.tolist() == [sorted(np.delete(x @ q, i))[-3] for i, q in enumerate(x[:20])]


@pytest.mark.parametrize("n", [1, 255, 256, 700])
@pytest.mark.parametrize("scale", [1, 1 << 27])  # sums beyond a double's whole numbers, too
def test_chunks_that_do_not_divide_the_block(n, scale):
    x = scale * np.random.default_rng(n).integers(-9, 10, (n, 6))
    read(x, x[:10], 5, 64)
    read(x, x[:10], 5, 64, [sorted(np.delete(x @ q, i))[-min(5, n - 1)] if n > 1 else 0
                            for i, q in enumerate(x[:10])])
