"""Keyed upsert, change feed, versioned table and the streaming incremental load."""

import os

import pytest
from pyspark.sql import functions as F

from tillpoint.operators import merge as M
from tillpoint.sources.files import VersionedTable, write_parquet
from tillpoint.streaming.incremental import run_upserts

SCHEMA = "id long, name string, amount double"


def test_upsert_updates_inserts_and_keeps_nulls(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], SCHEMA)
    batch = spark.createDataFrame([(2, "B", None), (4, "d", 4.0), (None, "n", 9.0)], SCHEMA)
    res = M.upsert(target, batch, "id")
    rows = {(r["id"], r["name"]): r for r in res.collect()}
    assert rows[(2, "B")]["amount"] is None          # NULL in the batch wins (no coalesce)
    assert rows[(2, "B")]["_op"] == "update"
    assert rows[(4, "d")]["_op"] == "insert"
    assert rows[(None, "n")]["_op"] == "insert"      # a NULL key never matches
    assert rows[(1, "a")]["_op"] == "unchanged"
    v = M.validation(target, res, batch, "id", "amount").first()
    assert (v["rows_before"], v["rows_after"], v["inserted"], v["updated"]) == (3, 5, 2, 1)
    assert v["duplicate_keys_after"] == 0 and v["updated_values_match"]


def test_duplicate_batch_key_is_an_error(spark):
    target = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    batch = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], SCHEMA)
    with pytest.raises(Exception, match="duplicate id"):
        M.merged(M.upsert(target, batch, "id")).collect()


def test_batch_counts_on_orders(spark):
    import __spark_entry__ as E

    v = E.queries()["merge_validation"](spark, "/root/testdata/sf0.01").first()
    assert (v["updated"], v["inserted"]) == (200, 150)
    assert v["rows_after"] == v["rows_before"] + 150
    assert v["duplicate_keys_after"] == 0 and v["updated_values_match"]


def test_versioned_table_and_history(spark, scratch):
    t = VersionedTable(spark, os.path.join(scratch, "t"))
    t.write_initial(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA))
    t.merge(spark.createDataFrame([(2, "b", 5.0), (3, "c", 3.0)], SCHEMA), "id")
    assert t.versions() == [0, 1]
    assert t.read(0).count() == 2 and t.read(1).count() == 3
    h = [tuple(r) for r in t.history().collect()]
    assert h == [(0, "WRITE", 2, 0, 2), (1, "MERGE", 1, 1, 3)]


def test_stream_applies_each_batch_file_as_a_version(spark, scratch):
    t = VersionedTable(spark, os.path.join(scratch, "t"))
    t.write_initial(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA))
    batches = os.path.join(scratch, "batches")
    write_parquet(spark.createDataFrame([(2, "b", 20.0), (3, "c", 3.0)], SCHEMA).coalesce(1),
                  os.path.join(batches, "b1"))
    write_parquet(spark.createDataFrame([(3, "c", 30.0), (4, "d", 4.0)], SCHEMA).coalesce(1),
                  os.path.join(batches, "b2"))
    latest = run_upserts(spark, os.path.join(batches, "*"), t, "id", SCHEMA, files_per_batch=1,
                         checkpoint=os.path.join(scratch, "ckpt"))
    assert len(t.versions()) == 3 and t.versions()[0] == 0  # one version per batch file
    final = {r["id"]: r["amount"] for r in t.read().collect()}
    assert final == {1: 1.0, 2: 20.0, 3: 30.0, 4: 4.0}


def _started(spark, scratch):
    t = VersionedTable(spark, os.path.join(scratch, "t"))
    t.write_initial(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA))
    return t


def test_replayed_batch_is_applied_once(spark, scratch):
    t = _started(spark, scratch)
    batch = spark.createDataFrame([(2, "b", 7.0), (3, "c", 3.0)], SCHEMA)
    assert t.merge(batch, "id", batch_id="s/0") == 1
    assert t.merge(batch, "id", batch_id="s/0") == 1     # run again after a failure
    assert t.versions() == [0, 1]
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "a", 1.0), (2, "b", 7.0), (3, "c", 3.0)]


def test_restart_with_a_lost_commit_applies_nothing_twice(spark, scratch):
    t = _started(spark, scratch)
    batches, ckpt = os.path.join(scratch, "batches"), os.path.join(scratch, "ckpt")
    write_parquet(spark.createDataFrame([(2, "b", 7.0), (3, "c", 3.0)], SCHEMA).coalesce(1),
                  os.path.join(batches, "b1"))
    files = os.path.join(batches, "*")
    assert run_upserts(spark, files, t, "id", SCHEMA, checkpoint=ckpt) == 1
    for name in ("0", ".0.crc"):
        os.remove(os.path.join(ckpt, "commits", name))
    assert run_upserts(spark, files, VersionedTable(spark, t.root), "id", SCHEMA, checkpoint=ckpt) == 1
    assert [r["rows_updated"] for r in t.history().collect()] == [0, 1]


def test_half_written_version_is_ignored(spark, scratch):
    t = _started(spark, scratch)
    for kind in ("current", "changes"):
        os.makedirs(os.path.join(t.root, kind, ".spark-staging-1", "_version=1", "_temporary"))
    assert t.versions() == [0] and t.read().count() == 2
    assert t.merge(spark.createDataFrame([(5, "e", 5.0)], SCHEMA), "id") == 1
    assert t.read().count() == 3


def test_batch_cut_short_is_applied_by_the_next_call(spark, scratch, monkeypatch):
    """The writer dies between the changes and the ranges; nothing is lost or applied twice."""
    t = _started(spark, scratch)
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_apply", lambda self, version: None)
        assert t.merge(spark.createDataFrame([(2, "b", 7.0), (None, "n", 1.0)], SCHEMA), "id",
                       batch_id="s/0") == 1
    assert t.merge(spark.createDataFrame([(2, "b", 7.0), (None, "n", 1.0)], SCHEMA), "id",
                   batch_id="s/0") == 1
    assert sorted(map(str, t.read().collect())) == sorted(map(str, spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", 7.0), (None, "n", 1.0)], SCHEMA).collect()))
    t._apply(1)  # once more changes nothing, rows without a key included
    assert t.read().count() == 3 and t.merge(
        spark.createDataFrame([(2, "b", 9.0)], SCHEMA), "id") == 2
    assert [tuple(r) for r in t.history().collect()] == [
        (0, "WRITE", 2, 0, 2), (1, "MERGE", 1, 1, 3), (2, "MERGE", 0, 1, 3)]


def test_older_versions_are_read_from_the_changes(spark, scratch):
    t = VersionedTable(spark, os.path.join(scratch, "t"), parts=3)
    states = [{k: float(k) for k in range(-5, 20)}]
    t.write_initial(spark.createDataFrame([(k, "x", v) for k, v in states[0].items()], SCHEMA), "id")
    for n, batch in enumerate(({1: 10.0, 30: 1.0}, {1: 11.0, -5: None, 40: 2.0}, {30: 3.0}), 1):
        assert t.merge(spark.createDataFrame([(k, "y", v) for k, v in batch.items()], SCHEMA),
                       "id") == n
        states.append({**states[-1], **batch})
    for n, state in enumerate(states):
        assert {r.id: r.amount for r in t.read(n).collect()} == state
        assert t.read(n).count() == len(state)
    with pytest.raises(ValueError):
        t.read(9)


def test_only_touched_parts_are_rewritten(spark, scratch):
    t = VersionedTable(spark, os.path.join(scratch, "t"), parts=8)
    t.write_initial(spark.range(1000).selectExpr("id", "'x' AS name", "0.0D AS amount"), "id")

    def files():
        return {d: sorted(os.listdir(os.path.join(t.root, "current", d)))
                for d in os.listdir(os.path.join(t.root, "current")) if d.startswith("_range=")}

    before = files()
    t.merge(spark.createDataFrame([(3, "y", 1.0)], SCHEMA), "id")
    after = files()
    assert len(before) == len(after) == 8
    assert [d for d in before if before[d] != after[d]] == ["_range=0"]
    assert t.read(1).count() == 1000 and t.read(1).filter("name = 'y'").count() == 1
    assert t.read(0).filter("name = 'y'").count() == 0


def test_batch_that_revises_two_columns(spark):
    target = spark.createDataFrame([(75, 10.0, 2.5), (101, 1.0, -1.0)], "id long, sales double, profit double")
    rows = M.make_batch(target, "id", ["sales", "profit"]).collect()
    assert sorted(tuple(r) for r in rows) == [(75, 11.0, 2.75), (203, 1.0, -1.0)]
