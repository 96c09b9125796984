r"""Source divergence audit: how far the sources of a language differ in their words.

A language keeps the terms found in at least ``min_documents`` of its documents.  A group is one
(language, source); its smoothed share of a kept term, in billionths, is

    p = 1 + floor(10^9 * (count + 5) / (N + 5 * V))        N: its kept counts, V: kept terms

and the distance of two groups is the sum of abs(p - q) over all kept terms of the language.

The group-term counts form a matrix for each language, rows in order of falling N, columns in order of
falling document frequency, so that zeros gather in one corner.  It is kept as a K-squared tree: a
leaf is a tile of ``tile_rows`` x ``tile_columns`` cells, a node has K x K children, and only
quadrants with a count are stored.  A pair of row ranges goes down the tree together:

* a column range that is zero in both is priced at once, its width times abs(p0 - q0), as every
  term of it has the same share p0 in a group;
* any other range is split, until two leaves (or a leaf and nothing) meet and their cells are
  compared.

A step of this descent is a join with the tree's next level.  The rows of a join are bounded by
nodes, never by documents, a tile is bounded by its area, and the distances are added up by pairs of
groups, which are the result.

All arithmetic is on whole numbers.  Edge cases: a null text, language or source is the empty one; a
group without any term has N = 0; a language without kept terms gives distance 0 to all its pairs;
rows that share an id are documents each; an empty table gives no row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import partitions, utf8
from tillpoint.operators.persist import materialize

# A-Z, a-z and everything beyond ASCII are letters; A-Z are lowered, all else divides terms.
_LETTERS = bytes(c | 0x20 if chr(c).isalpha() and c < 0x80 else c if c >= 0x80 else 0x20
                 for c in range(256))
_COUNTED = "lang string, source string, term string, n long, df long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def _count(max_entries: int):
    """Counts of terms and of documents with them, for each group a task meets.

    A group is also reported with a null term, so that none is lost for want of terms.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (total, found) in held.items():
                words = [None, *total]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(words), pa.string()),
                    pa.array([source] * len(words), pa.string()),
                    pa.array(words, pa.binary()).cast(pa.string()),
                    pa.array([0, *total.values()], pa.int64()),
                    pa.array([0, *map(found.__getitem__, total)], pa.int64())],
                    ["lang", "source", "term", "n", "df"])
            held.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(),
                                          batch.column(1).to_pylist(), utf8(batch.column(2))):
                total, found = held.setdefault((lang, source), (Counter(), Counter()))
                own = Counter(terms(text))
                total.update(own)
                found.update(own.keys())
            if sum(len(total) for total, _ in held.values()) > max_entries:
                yield from flush()
        yield from flush()

    return run


def count_terms(docs: DataFrame, max_entries: int = 500_000) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents; a null term for each group."""
    def plain(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    return (docs.select(plain("lang"), plain("source"), plain("text"))
            .mapInArrow(_count(max_entries), _COUNTED)
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")))


def numbered(frame: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``frame`` with each language's rows numbered from 0 in a strict order.

    Range partitions are numbered each on its own and shifted by the counts before them, so a
    language with most of the rows is spread like any other.
    """
    spread = materialize(
        frame.repartitionByRange(partitions(frame.sparkSession), "lang", *order)
        .withColumn("part", F.spark_partition_id()), "divergence-order")
    before = spread.groupBy("lang", "part").count().select(
        "lang", "part", F.coalesce(F.sum("count").over(Window.partitionBy("lang").orderBy("part")
                                   .rowsBetween(Window.unboundedPreceding, -1)),
                                   F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)) - 1
    return (spread.withColumn("own", own).join(before, ["lang", "part"])
            .withColumn(out, F.col("before") + F.col("own")).drop("part", "own", "before"))


def share(count: str, total: str, kept: str = "v") -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * kept)), exact."""
    return F.expr(f"1 + (cast(1000000000 as decimal(10, 0)) * cast({count} + 5 as decimal(20, 0))"
                  f" div cast({total} + 5 * {kept} as decimal(20, 0)))")


def matrix(docs: DataFrame, min_documents: int) -> tuple[DataFrame, DataFrame]:
    """(groups, cells) of the count matrices.

    groups: lang, source, row, s (groups of the language), v, p0 (share of a term not found).
    cells, counts above zero only: lang, source, row, term, col, p, q (share in the language).
    """
    counts = materialize(count_terms(docs), "divergence-counts")
    kept = materialize(numbered(
        counts.filter("term is not null").groupBy("lang", "term")
        .agg(F.sum("df").alias("df"), F.sum("n").alias("total")).filter(F.col("df") >= min_documents),
        [F.desc("df"), F.col("term")], "col"), "divergence-terms")
    known = counts.filter("n > 0").join(kept.select("lang", "term", "col", "total"), ["lang", "term"])
    known = materialize(known.select("lang", "source", "term", "col", "n", "total"),
                        "divergence-known")
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_all"))
    groups = (counts.filter("term is null").select("lang", "source").distinct()
              .join(known.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"],
                    "left").fillna(0, ["n"]))
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s"))
    groups = materialize(
        numbered(groups, [F.desc("n"), F.col("source")], "row")
        .join(sizes.join(languages, "lang", "left").fillna(0, ["v", "n_all"]), "lang")
        .withColumn("p0", F.when(F.col("v") > 0, share("0", "n"))), "divergence-groups")
    sides = groups.select("lang", "source", "row", "v", "n_all", F.col("n").alias("n_group"))
    cells = materialize(
        known.join(sides, ["lang", "source"])
        .select("lang", "source", "row", "term", "col", share("n", "n_group").alias("p"),
                share("total", "n_all").alias("q")), "divergence-cells")
    return groups.select("lang", "source", "row", "s", "v", "p0"), cells


def _compare(tile_rows: int, tile_columns: int, max_matrices: int = 2000):
    """Distances of two leaves' rows over their columns, added up for each pair of row blocks."""
    def dense(cells, p0: np.ndarray, width: int) -> np.ndarray:
        out = np.repeat(p0[:, None], width, axis=1)
        if cells is not None:
            packed = np.array(cells, np.int64)
            at = packed >> 31
            out[at // tile_columns, at % tile_columns] = packed & ((1 << 31) - 1)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, i, j), total in held.items():
                a, b = np.indices(total.shape).reshape(2, -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * total.size, pa.string()),
                     pa.array(a + i * tile_rows, pa.int64()), pa.array(b + j * tile_rows, pa.int64()),
                     pa.array(total.ravel(), pa.int64())], ["lang", "a", "b", "f"])
            held.clear()

        for batch in batches:
            for r in batch.to_pylist():
                a = dense(r["mine"], np.array(r["p0_i"], np.int64), r["width"])
                b = dense(r["other"], np.array(r["p0_j"], np.int64), r["width"])
                f = np.abs(a[:, None, :] - b[None, :, :]).sum(axis=2)
                key = (r["lang"], r["i"], r["j"])
                held[key] = held[key] + f if key in held else f
            if len(held) > max_matrices:
                yield from flush()
        yield from flush()

    return run


def distances(groups: DataFrame, cells: DataFrame, k: int = 4, tile_rows: int = 16,
              tile_columns: int = 1024) -> DataFrame:
    """(lang, source, p0, other, other_p0, f) for every ordered pair of groups of a language."""
    rows, columns = F.floor(F.col("row") / tile_rows), F.floor(F.col("col") / tile_columns)
    packed = F.expr(f"shiftleft((row % {tile_rows}) * {tile_columns} + col % {tile_columns}, 31) | p")
    tiles = materialize(cells.groupBy("lang", rows.alias("i"), columns.alias("c"))
                        .agg(F.collect_list(packed).alias("cells")), "divergence-tiles")
    # p0 of the rows of a block: at most tile_rows values.
    blocks = materialize(
        groups.groupBy("lang", "s", "v", rows.alias("i"))
        .agg(F.sort_array(F.collect_list(F.struct("row", "p0"))).alias("x"))
        .select("lang", "s", "v", "i", F.col("x.p0").alias("p0s")), "divergence-blocks")
    largest = blocks.agg(F.max("s"), F.max("v")).first()
    wanted = max(1, -(-(largest[0] or 0) // tile_rows), -(-(largest[1] or 0) // tile_columns))
    depth = next(d for d in range(64) if k ** d >= wanted)

    def quadrants(level: int) -> DataFrame:
        """The stored quadrants of a level of the tree."""
        span = k ** (depth - level)
        return tiles.select("lang", F.expr(f"i div {span}").alias("i"),
                            F.expr(f"c div {span}").alias("c")).distinct()

    def looked_up(pairs: DataFrame, level: int) -> DataFrame:
        """Which of the two quadrants of each (lang, i, j, c) is stored, and the columns in it."""
        tree, span = quadrants(level), tile_columns * k ** (depth - level)
        mine = tree.withColumn("at_i", F.lit(True))
        other = tree.select("lang", F.col("i").alias("j"), "c", F.lit(True).alias("at_j"))
        return materialize(
            pairs.join(mine, ["lang", "i", "c"], "left").join(other, ["lang", "j", "c"], "left")
            .withColumn("width", F.least(F.col("v") - F.col("c") * span, F.lit(span))),
            "divergence-level")

    front = looked_up(blocks.filter("v > 0").select("lang", "s", "v").distinct().select(
        "*", *[F.lit(0).cast("long").alias(c) for c in "ijc"]), 0)
    empty = "at_i is null and at_j is null"
    priced = []
    for level in range(depth + 1):
        span = k ** (depth - level)  # leaf blocks of a quadrant's side
        leaves = F.least(F.lit(span), F.ceil(F.col("s") / tile_rows) - F.col("i") * span)
        others = F.least(F.lit(span), F.ceil(F.col("s") / tile_rows) - F.col("j") * span)
        side = lambda c, n: F.explode(F.sequence(
            F.col(c) * span, F.col(c) * span + n - 1)).alias(f"{c}_leaf")
        priced.append(front.filter(empty).groupBy("lang", "s", "i", "j").agg(
            F.sum("width").alias("width")).select("lang", "i", "j", "s", "width", side("i", leaves))
            .select("lang", "j", "s", "width", "i_leaf", side("j", others))
            .select("lang", F.col("i_leaf").alias("i"), F.col("j_leaf").alias("j"), "width"))
        if level == depth:
            break
        child = lambda c: F.explode(F.sequence(
            F.col(c) * k, F.col(c) * k + k - 1)).alias(c)
        below, size = front.filter(f"not ({empty})").select("lang", "s", "v", "i", "j", "c"), span // k
        pairs = (below.select("lang", "s", "v", "j", "c", child("i"))
                 .select("lang", "s", "v", "i", "c", child("j"))
                 .filter((F.col("i") <= F.col("j")) & (F.col("j") * tile_rows * size < F.col("s")))
                 .select("lang", "s", "v", "i", "j", child("c"))
                 .filter(F.col("c") * tile_columns * size < F.col("v")))
        front = looked_up(pairs, level + 1)

    met = (front.filter(f"not ({empty})").select("lang", "i", "j", "c", "width")
           .join(tiles.withColumnRenamed("cells", "mine"), ["lang", "i", "c"], "left")
           .join(tiles.select("lang", F.col("i").alias("j"), "c", F.col("cells").alias("other")),
                 ["lang", "j", "c"], "left")
           .join(blocks.select("lang", "i", F.col("p0s").alias("p0_i")), ["lang", "i"])
           .join(blocks.select("lang", F.col("i").alias("j"), F.col("p0s").alias("p0_j")),
                 ["lang", "j"]))
    compared = (met.select("lang", "i", "j", "width", "mine", "other", "p0_i", "p0_j")
                .mapInArrow(_compare(tile_rows, tile_columns), "lang string, a long, b long, f long")
                .groupBy("lang", "a", "b").agg(F.sum("f").alias("f")))
    zero = priced[0]
    for more in priced[1:]:
        zero = zero.unionByName(more)
    zero = zero.filter("i <= j").groupBy("lang", "i", "j").agg(F.sum("width").alias("zero"))

    # The result's pairs, a row block beside each block from its own on.
    ends = blocks.select("lang", "i", F.explode(F.sequence(
        F.col("i"), F.ceil(F.col("s") / tile_rows) - 1)).alias("j"))
    first = groups.select("lang", rows.alias("i"), F.col("row").alias("a"),
                          F.col("source").alias("source_a"), F.col("p0").alias("p0_a"))
    second = groups.select("lang", rows.alias("j"), F.col("row").alias("b"),
                           F.col("source").alias("source_b"), F.col("p0").alias("p0_b"))
    pairs = (ends.join(zero, ["lang", "i", "j"], "left").join(first, ["lang", "i"])
             .join(second, ["lang", "j"]).filter("a < b").join(compared, ["lang", "a", "b"], "left")
             .withColumn("f", F.coalesce("f", F.lit(0)) + F.coalesce(
                 F.col("zero") * F.abs(F.col("p0_a") - F.col("p0_b")), F.lit(0))))

    def way(a, b):
        return F.struct(F.col(f"source_{a}").alias("source"), F.col(f"source_{b}").alias("other"))

    return pairs.select("lang", F.explode(F.array(way("a", "b"), way("b", "a"))).alias("w"), "f"
                        ).select("lang", "w.source", "w.other", "f")


def audit(docs: DataFrame, min_documents: int = 30, top: int = 50, **parameters) -> DataFrame:
    """lang, source, part, item, value, rank.

    part ``pair``: the other sources, by falling distance.  part ``term``: the ``top`` terms by
    which a group exceeds its language, of those it has.
    """
    groups, cells = matrix(docs, min_documents)

    def ranked(frame: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return frame.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                            F.row_number().over(order).cast("int").alias("rank"))

    pairs = distances(groups, cells, **parameters).select(
        "lang", "source", F.col("other").alias("item"), F.col("f").alias("value"))
    above = cells.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return ranked(pairs, "pair").unionByName(ranked(above, "term").filter(F.col("rank") <= top))
