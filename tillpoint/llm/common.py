"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.operators.persist import materialize

# The white space of every contract here: blank, tab, line feed, vertical tab, form feed,
# carriage return.
WS = r"[\x20\x09-\x0D]+"
NOT_WS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def doc_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of a document table, null texts as empty ones."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, null as empty, one value at a time."""
    for value in pc.cast(column, pa.binary()):
        yield value.as_py() or b""


def unsigned_hex(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def same_key(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys, where a null equals a null; the left columns only."""
    on = F.lit(True)
    for c in keys:
        on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.alias("l").join(right.alias("r"), on, how).select("l.*")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's edges, those that join two of its trees: same components, fewer edges."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        kept = []
        for k, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                kept.append(k)
        yield batch.take(pa.array(kept, pa.int64()))


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) of the undirected graph ``edges(a, b)``; component = smallest node.

    Each task first thins its edges to a spanning forest, so that a crowded group brings edges in
    proportion to its nodes.  Then min-label propagation with pointer jumping.  Labels and edges stay distributed; each
    round is written to the checkpoint folder, so a lost executor costs a re-read and the
    lineage never grows.  The join on the far end of an edge is followed by a partial
    aggregation, so AQE may split the partition of a node with very many links.
    """
    thin = materialize(edges.select("a", "b").mapInArrow(_forest, "a long, b long"),
                       f"{label}-forest")
    both = materialize(
        thin.unionByName(thin.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{label}-edges")
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        .select("node", F.least("node", "m").alias("component")), f"{label}-labels")
    while True:
        heard = (both.join(labels, both["b"] == labels["node"])
                 .groupBy(both["a"].alias("node")).agg(F.min("component").alias("heard")))
        step = materialize(
            labels.join(heard, "node")
            .select("node", F.col("component").alias("old"),
                    F.least("component", "heard").alias("component")), f"{label}-step")
        up = step.select(F.col("node").alias("parent"), F.col("component").alias("grand"))
        jumped = materialize(
            step.join(up, step["component"] == up["parent"], "left")
            .select("node", "old", F.coalesce(F.least("component", "grand"), "component")
                    .alias("component")), f"{label}-labels")
        labels = jumped.select("node", "component")
        if jumped.filter(F.col("old") != F.col("component")).isEmpty():
            return labels
