"""Python workers get and give small batches, whatever the session allows."""
from types import SimpleNamespace

import pyarrow as pa

from tillpoint.llm import exact_dedup
from tillpoint.operators.persist import BATCH_BYTES, BATCH_ROWS, materialize


def test_batches_to_a_worker(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})

    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(k) for k in keys]
    rows = materialize(spark.range(5 * BATCH_ROWS).coalesce(1).mapInArrow(
        sizes, "n long, size long")).collect()
    assert sum(r.n for r in rows) == 5 * BATCH_ROWS and max(r.n for r in rows) <= BATCH_ROWS
    wide = spark.range(64).coalesce(1).selectExpr("repeat('x', 1000000) AS text")
    rows = materialize(wide.mapInArrow(sizes, "n long, size long")).collect()
    assert sum(r.n for r in rows) == 64 and max(r.size for r in rows) <= BATCH_BYTES + 2_000_000
    assert [spark.conf.get(k) for k in keys] == before


def test_batches_from_the_dedup_scan(monkeypatch):
    monkeypatch.setattr(exact_dedup, "TaskContext",
                        SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    texts = [f"{i} " + "x" * 10_000 for i in range(1000)] + ["the same"] * (3 * BATCH_ROWS)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    out = list(exact_dedup._entries(32 << 20, 64)(iter([batch])))
    assert max(b.num_rows for b in out) <= BATCH_ROWS
    assert max(b.column("body").nbytes for b in out) <= BATCH_BYTES + 100_000
    rows = [r for b in out for r in b.to_pylist()]
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    assert sorted(r["n"] for r in rows if r["head"]) == [1] * 1000 + [3 * BATCH_ROWS]
    assert sum(r["first"] for r in rows) == sum(r["body"] is not None for r in rows) == 1001
