from pathlib import Path

from tillpoint.operators.persist import settings, size_of
from tillpoint.sources import files


def test_sizes():
    assert [size_of(x) for x in ("10", "67108864b", "4m", "4MB", "-1", "2g")] == [
        10, 1 << 26, 4 << 20, 4 << 20, -1, 2 << 30]


def test_settings_are_bounded_and_put_back(spark):
    key, other = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    before = spark.conf.get(key), spark.conf.get(other)
    with settings(spark, {key: 1000}, {other: 77}):
        assert spark.conf.get(key) == "1000" and spark.conf.get(other) == "77"
        with settings(spark, {key: 5000}, {other: 5}):
            assert spark.conf.get(key) == "1000" and spark.conf.get(other) == "77"
    assert (spark.conf.get(key), spark.conf.get(other)) == before


def test_partitions_follow_the_files(spark, scratch, monkeypatch):
    """More input means more tasks, not larger ones; the rows are the distinct ones."""
    at = str(Path(scratch, "in put"))
    spark.range(30_000).selectExpr("id % 20000 AS a", "CAST(NULL AS string) AS b").write.parquet(at)
    raw = spark.read.parquet(at)
    assert files.input_bytes(raw) == sum(p.stat().st_size for p in Path(at).glob("*.parquet"))
    monkeypatch.setattr(files, "INPUT_A_PARTITION", files.input_bytes(raw) // 40)
    monkeypatch.setattr(files, "SHUFFLED_A_TASK", 1)
    monkeypatch.setattr(files, "settings", kept := Kept(files.settings))
    got = files.append_distinct(str(Path(scratch, "out")), raw, ["a", "b"])
    assert got.count() == got.distinct().count() == 20_000 and got.filter("b IS NULL").count() == 20_000
    assert kept.least["spark.sql.shuffle.partitions"] >= 40
    twice = files.append_distinct(str(Path(scratch, "out")), raw.limit(0), ["a", "b"])
    assert twice.count() == 20_000


class Kept:
    """The bounds that a call of ``settings`` asked for."""

    def __init__(self, run):
        self.run = run

    def __call__(self, spark, most, least):
        self.least = self.least if hasattr(self, "least") else least
        return self.run(spark, most, least)
