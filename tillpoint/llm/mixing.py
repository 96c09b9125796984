"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating, and share 150 % of all
words by weight; a target stops at twice its source's size, and the excess is shared again by
weight until none is above.

Positions: a source's schedule is a piecewise linear rate over training time.  Its integral is the
source's demand for words up to a time; a document that covers the words [a, b) of its source's
demand is read when the demand reaches their middle, i.e. at the inverse of the integral.  Documents
are then range-sorted by that time.

A source's documents lie in hash order; their places are prefix sums over hash buckets of about
``rows_per_bucket`` rows and then inside a bucket, so a source with a third of all rows is
spread like any other.  A source is read in whole passes, then up to the rest of its target.  For the
rest, classes of length (powers of four) go from long to short: each class gives its share of the
rest, plus or minus what the longer ones left open, as the first documents of its hash order, to the
document whose end is nearest.  So a long document is taken or left, and shorter ones make up for it
either way; the selection leans to no length.  What then still differs is made up for by documents
added and left out: the sum of short ones that comes nearest, then one more, one less, or one
against another as long as that brings the source nearer.  No length is used twice.

Edge cases: a null text has size 0; an empty document is read as often as its source's whole passes
say; rows that share an id count each; equal rows are interchangeable, and numbered before they are
hashed, so that many of them are spread too; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import NOT_WS, partitions
from tillpoint.operators.persist import materialize
from tillpoint.operators.windows import ordered_window

WEIGHTS = (3, 1, 2)
# Rates at the start and the end of training, for each weight in turn: heavy sources come
# early, light ones late, the others evenly.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)))


def ranked(keys: DataFrame, key: str) -> DataFrame:
    """``keys`` with ``rank`` (from 0) in the order of the distinct column ``key``.

    Range partitions are ranked each on its own and shifted by the counts before them.
    """
    spread = materialize(
        keys.repartitionByRange(partitions(keys.sparkSession), key)
        .withColumn("part", F.spark_partition_id()), "mix-ranked")
    before = (spread.groupBy("part").count()
              .withColumn("before", F.sum("count").over(
                  Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))))
    own = F.row_number().over(Window.partitionBy("part").orderBy(key)) - 1
    return (spread.withColumn("own", own).join(before.select("part", "before"), "part")
            .withColumn("rank", F.col("own") + F.coalesce("before", F.lit(0)))
            .drop("part", "own", "before"))


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """(sk, source_size, tier, target) for ``sources(sk, source_size)``."""
    n = len(weights)
    tier = F.pmod(F.col("rank"), F.lit(n)).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), tier + 1)
    known = materialize(ranked(sources, "sk").select(
        "sk", "source_size", tier.alias("tier"), weight.alias("weight")), "mix-sources")
    total, rate = known.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return known.select("sk", "source_size", "tier", F.lit(0.0).alias("target"))
    rate, capped = share * total / rate, -1
    limit = cap * F.col("source_size")
    while True:  # the rate rises only, so a source that is capped once stays so
        over = F.col("weight") * rate > limit
        taken, weigh, count = known.agg(
            F.sum(F.when(over, limit).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
            F.sum(over.cast("int"))).first()
        if count == capped or not weigh:
            break
        rate, capped = (share * total - taken) / weigh, count
    return known.select("sk", "source_size", "tier",
                        F.least(limit, F.col("weight") * rate).alias("target"))


def inverse(schedule, u: Column) -> Column:
    """Time at which the schedule's integral reaches the share ``u`` of its total."""
    spans = [(t0, r0, (r1 - r0) / (t1 - t0), (r0 + r1) / 2 * (t1 - t0))
             for (t0, r0), (t1, r1) in zip(schedule, schedule[1:])]
    total, done, out = sum(s[3] for s in spans), 0.0, None
    for k, (t0, rate, slope, area) in enumerate(spans):
        y = F.greatest(u * total - done, F.lit(0.0))
        t = (F.lit(t0) + y / rate if slope == 0 else
             F.lit(t0) + (F.sqrt(F.greatest(F.lit(0.0), rate * rate + 2 * slope * y)) - rate) / slope)
        done += area
        last = k == len(spans) - 1
        out = (t if last else F.when(u * total <= done, t)) if out is None else (
            out.otherwise(t) if last else out.when(u * total <= done, t))
    return out


_EARLIER = (Window.unboundedPreceding, -1)
_FAMILY = 64  # equal rows that are numbered together
SHORT = 40  # different lengths, the shortest ones, whose sums are all looked at


def _sources(docs: DataFrame) -> tuple[Column, Column, Column]:
    """Key, size and source of a document."""
    size = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")),
                          F.lit(NOT_WS)).cast("long")
    return (F.col("doc_id").cast("long"), size,
            F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")))


def _placed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, sk, size, h): h orders a source's documents, equal rows get different ones."""
    doc_id, size, sk = _sources(docs)
    equal = materialize(
        docs.select(doc_id.alias("doc_id"), sk.alias("sk"), size.alias("size"))
        .groupBy("doc_id", "sk", "size").agg(F.count(F.lit(1)).alias("m")), "mix-equal")
    many = (equal.filter("m > 1")
            .withColumn("family", F.explode(F.expr(f"sequence(0, (m - 1) div {_FAMILY})")))
            .repartition(partitions(docs.sparkSession), "doc_id", "family")
            .withColumn("n", F.explode(F.expr(f"sequence(family * {_FAMILY}, "
                                              f"least(m, (family + 1) * {_FAMILY}) - 1)"))))
    columns = ["doc_id", "sk", "size"]
    return (equal.filter("m = 1").select(*columns, F.lit(0).cast("long").alias("n"))
            .unionByName(many.select(*columns, F.col("n").cast("long").alias("n")))
            .select(*columns, F.xxhash64("doc_id", "size", "n").alias("h")))


def _with_offsets(cells: DataFrame, keys: list[str], wide: int, out: str) -> DataFrame:
    """``cells`` with the words of the buckets before each, summed by zones of ``wide`` buckets."""
    cells = cells.withColumn("zone", F.floor(F.col("bucket") / wide))
    zones = (cells.groupBy(*keys, "zone").agg(F.sum("words").alias("words")).select(
        *keys, "zone", F.coalesce(F.sum("words").over(
            Window.partitionBy(*keys).orderBy("zone").rowsBetween(*_EARLIER)), F.lit(0)).alias("z")))
    inside = F.coalesce(F.sum("words").over(
        Window.partitionBy(*keys, "zone").orderBy("bucket").rowsBetween(*_EARLIER)), F.lit(0))
    return (cells.withColumn("inside", inside).join(zones, [*keys, "zone"])
            .withColumn(out, F.col("z") + F.col("inside")).drop("zone", "z", "inside"))


def _cuts(rows: DataFrame, cells: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with what each class of length gives to the rest of its source's target.

    cuts: of each class, how many words its first documents give together.  gap: words still missing
    in the end.  A class looks at its cells, and at the documents of the one cell in which its share
    ends.  What is known of a source is one row, carried from class to class, so a class costs the
    driver a small plan however many went before.
    """
    state = targets.withColumns({"gap": F.lit(0.0), "cuts": F.expr("cast(map() as map<int, bigint>)")})
    classes = cells.filter("cls >= 0").select("cls").distinct().collect()
    for cls in sorted((r[0] for r in classes), reverse=True):
        own = F.try_element_at("words", F.lit(cls))
        ideal = F.col("rest") / F.greatest("source_size", F.lit(1)) * own
        asked = state.withColumns({"all": F.coalesce(own, F.lit(0)),
                                   "x": F.col("gap") + F.coalesce(ideal, F.lit(0.0))})
        end = (cells.filter(F.col("cls") == cls).select("sk", "bucket", "offset", "words")
               .join(asked.select("sk", "x"), "sk").filter("offset <= x and x < offset + words")
               .drop("words"))
        upto = Window.partitionBy("sk", "bucket").orderBy("h", "doc_id").rowsBetween(
            Window.unboundedPreceding, 0)
        ends = (rows.filter(F.col("cls") == cls).select("sk", "bucket", "h", "doc_id", "size")
                .join(end, ["sk", "bucket"])
                .withColumn("b", F.col("offset") + F.sum("size").over(upto)))
        near = ends.groupBy("sk").agg(
            F.coalesce(F.max(F.when(F.col("b") <= F.col("x"), F.col("b"))), F.min("offset")).alias("low"),
            F.min(F.when(F.col("b") > F.col("x"), F.col("b"))).alias("high"))
        nearest = F.when(F.col("high") - F.col("x") < F.col("x") - F.col("low"), F.col("high")
                         ).otherwise(F.col("low"))
        cut = (F.when(F.col("x") <= 0, 0).when(F.col("x") >= F.col("all"), F.col("all"))
               .otherwise(nearest)).cast("long")
        state = materialize(asked.join(near, "sk", "left").select(
            *targets.columns, (F.col("x") - cut).alias("gap"),
            F.map_concat("cuts", F.create_map(F.lit(cls), cut)).alias("cuts")), "mix-cut")
    return state


def _nearest_sum(gap: float, free: list[int], held: list[int], span: int = 1 << 17) -> tuple[list, list]:
    """Sizes to add and to leave out whose sum is nearest to ``gap``, among all such sums.

    ``reach`` has a bit for every sum within ``span`` words; the sums before each size tell which
    ones made the best.
    """
    steps, reach, whole = [*free, *(-y for y in held)], 1 << span, (1 << (2 * span + 1)) - 1
    before = []
    for step in steps:
        before.append(reach)
        reach |= (reach << step if step > 0 else reach >> -step) & whole
    at = max(-span, min(span, round(gap))) + span
    for off in range(2 * span + 1):
        found = [p for p in (at - off, at + off) if 0 <= p <= 2 * span and reach >> p & 1]
        if found:
            break
    place = min(found, key=lambda p: abs(p - span - gap))
    if abs(place - span - gap) >= abs(gap):
        return [], []
    used = []
    for step, reach in zip(reversed(steps), reversed(before)):
        if not reach >> place & 1:
            used.append(step)
            place -= step
    return [x for x in used if x > 0], [-y for y in used if y < 0]


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each source the sizes to add (not fits) and to leave out (fits) that bring it nearer.

    A source's row holds its distinct sizes, as many as its longest document has words at most.
    """
    def best(gap: float, free: np.ndarray, held: np.ndarray) -> tuple:
        found = (abs(gap), 0, 0)
        for y in (0, *held.tolist()):  # 0: nothing is left out, nothing is added
            at = int(np.searchsorted(free, gap + y))
            for x in (0, *free[max(0, at - 1):at + 1].tolist()):
                found = min(found, (abs(gap + y - x), x, y), key=lambda t: t[0])
        return found[1:]

    for b in batches:
        out = []
        for r in b.to_pylist():
            gap, free, held = r["gap"], *(np.array(sorted(r[c]), np.int64) for c in ("free", "held"))
            if gap is None:
                continue
            more, less = _nearest_sum(gap, free[:SHORT].tolist(), held[:SHORT].tolist())
            out += [(r["sk"], x, False) for x in more] + [(r["sk"], y, True) for y in less]
            gap += sum(less) - sum(more)
            free, held = np.setdiff1d(free, more), np.setdiff1d(held, less)
            x, y = best(gap, free, held)
            while x or y:
                out += [(r["sk"], size, fits) for size, fits in ((x, False), (y, True)) if size]
                gap, free, held = gap - x + y, free[free != x], held[held != y]
                x, y = best(gap, free, held)
        columns = list(zip(*out)) or [[]] * 3
        kinds = (pa.string(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         ["sk", "size", "fits"])


def _mixed(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share: float = 1.5,
           cap: float = 2.0, rows_per_bucket: int = 500) -> DataFrame:
    """What ``mix`` returns, written in no order, with ``at`` to sort it by."""
    rows = materialize(_placed_rows(docs), "mix-rows")
    buckets = max(1, -(-rows.count() // rows_per_bucket))
    wide = max(1, int(buckets ** 0.5))
    cls = F.when(F.col("size") > 0, F.floor(F.log2("size") / 2)).otherwise(-1).cast("int")
    rows = rows.withColumns({"bucket": F.pmod("h", F.lit(buckets)), "cls": cls})
    cells = materialize(rows.groupBy("sk", "cls", "bucket").agg(F.sum("size").alias("words")),
                        "mix-cells")
    by_class = (cells.filter("cls >= 0").groupBy("sk", "cls").agg(F.sum("words").alias("words"))
                .groupBy("sk").agg(F.map_from_entries(F.collect_list(F.struct("cls", "words")))
                                   .alias("words")))
    targets = materialize(
        source_targets(cells.groupBy("sk").agg(F.sum("words").alias("source_size")),
                       weights, share, cap)
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(
            F.col("target") / F.greatest("source_size", F.lit(1)))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .join(by_class, "sk", "left"), "mix-targets")
    whole = materialize(_with_offsets(
        cells.groupBy("sk", "bucket").agg(F.sum("words").alias("words")), ["sk"], wide, "first")
        .drop("words"), "mix-whole")
    located = materialize(_with_offsets(cells, ["sk", "cls"], wide, "offset")
                          .join(whole, ["sk", "bucket"]), "mix-located")
    state = _cuts(rows, located, targets)
    # Documents meet what is known of their source by (source, bucket, class), which none crowds.
    known = located.drop("words").join(state.drop("words"), "sk").withColumn(
        "cut", F.try_element_at("cuts", F.col("cls"))).drop("cuts")
    in_source = Window.partitionBy("sk", "bucket").orderBy("h", "doc_id").rowsBetween(*_EARLIER)
    in_class = Window.partitionBy("sk", "bucket", "cls").orderBy("h", "doc_id").rowsBetween(
        Window.unboundedPreceding, 0)
    placed = materialize(
        rows.join(known, ["sk", "cls", "bucket"])
        .withColumn("start", F.col("first") + F.coalesce(F.sum("size").over(in_source), F.lit(0)))
        .withColumn("fits", F.coalesce((F.col("size") > 0) & (
            F.col("offset") + F.sum("size").over(in_class) <= F.col("cut")), F.lit(False)))
        .select("doc_id", "sk", "bucket", "size", "start", "fits", "source_size", "tier", "target",
                "passes", "rest", "gap", "h"), "mix-placed")

    known_sizes = (placed.filter("size > 0 and rest > 0").groupBy("sk").agg(
        F.first("gap").alias("gap"), F.collect_set(F.when(~F.col("fits"), F.col("size"))).alias("free"),
        F.collect_set(F.when(F.col("fits"), F.col("size"))).alias("held")))
    changes = known_sizes.mapInArrow(_changes, "sk string, size long, fits boolean")
    places = cells.select("sk", "bucket").distinct().join(changes, "sk")
    first = (placed.join(places, ["sk", "bucket", "size", "fits"])
             .groupBy("sk", "size", "fits", "bucket").agg(F.min("start").alias("start"))
             .groupBy("sk", "size", "fits").agg(F.min(F.struct("start", "bucket")).alias("x"))
             .select("sk", "x.bucket", "size", "x.start", F.lit(True).alias("flipped")))
    chosen = materialize(
        placed.join(first, ["sk", "bucket", "size", "start"], "left")
        .withColumn("more", F.col("fits") != F.coalesce("flipped", F.lit(False)))
        .drop("flipped", "fits"), "mix-chosen")
    partial = materialize(chosen.groupBy("sk", "bucket").agg(
        F.sum(F.when(F.col("more"), F.col("size")).otherwise(0)).alias("words")), "mix-partial")
    got = partial.groupBy("sk").agg(F.sum("words").alias("got"))
    lasts = _with_offsets(partial, ["sk"], wide, "before").drop("words").join(got, "sk")
    words = F.col("passes") * F.col("source_size") + F.col("got")
    own = F.coalesce(F.sum(F.when(F.col("more"), F.col("size")).otherwise(0)).over(in_source), F.lit(0))
    copies = (F.col("passes") + F.col("more").cast("long")).cast("int")

    def times(k: Column) -> Column:
        at = k * F.col("source_size") + F.when(k == F.col("passes"), F.col("last")).otherwise(
            F.col("start"))
        u = (at + F.col("size") / 2) / F.greatest(F.col("words"), F.lit(1))
        out = inverse(schedules[0], u)
        for t in range(1, len(schedules)):
            out = F.when(F.col("tier") % len(schedules) == t, inverse(schedules[t], u)).otherwise(out)
        return out

    result = (chosen.join(lasts, ["sk", "bucket"]).withColumn("last", F.col("before") + own)
              .withColumn("copies", copies).withColumn("words", words)
              .withColumn("positions", F.when(F.col("copies") > 0, F.transform(
                  F.sequence(F.lit(0), F.col("copies") - 1), times))
                  .otherwise(F.array().cast("array<double>"))))
    spread = F.shiftrightunsigned("h", 1) / F.lit(float(1 << 63))  # of documents not taken
    return materialize(result.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies", "positions",
        F.col("sk").alias("source_key"),
        F.when(F.col("copies") > 0, F.col("positions")[0]).otherwise(1 + spread).alias("at")),
        "mix-result")


def mix(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share: float = 1.5,
        cap: float = 2.0, rows_per_bucket: int = 500) -> DataFrame:
    """One row per document, range-sorted by its first position (documents not taken last).

    Columns: doc_id, size, source_size, target, taken, copies, positions (one training time
    in [0, 1] for each copy), source_key.
    """
    return (_mixed(docs, weights, schedules, share, cap, rows_per_bucket)
            .repartitionByRange(partitions(docs.sparkSession), "at")
            .sortWithinPartitions("at", "doc_id").drop("at"))


def training_order(docs: DataFrame, **parameters) -> DataFrame:
    """The documents as training reads them: a row for each copy, range-sorted by position.

    Rows that share id, size and source are told apart by the hash of their texts: the n-th of them
    takes the n-th place of theirs.  Columns of any name pass through.
    """
    key = ["k", "size", "sk"]
    made = _mixed(docs, **parameters).select(
        F.col("doc_id").alias("k"), "size", F.col("source_key").alias("sk"), "positions",
        F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0)).alias("at"))
    doc_id, size, sk = _sources(docs)
    # A document is one struct, so none of its columns can be mistaken for one of these.
    whole = docs.select(F.struct("*").alias("doc"), doc_id.alias("k"), size.alias("size"),
                        sk.alias("sk"), F.xxhash64(F.col("text").cast("string")).alias("o"))
    twice = materialize(made.groupBy(*key).count().filter("count > 1").select(*key), "mix-twice")

    def same(a: str, b: str, names=key) -> Column:
        out = F.lit(True)
        for c in names:
            out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
        return out

    taken = made.filter(F.size("positions") > 0)
    if twice.isEmpty():
        out = whole.alias("w").join(taken.alias("m"), same("w", "m"))
    else:
        def numbered(frame: DataFrame, by: str) -> DataFrame:
            left = frame.alias("w").join(twice.alias("t"), same("w", "t"), "left_semi")
            return ordered_window(left, [(by, True)], key, row_number="n", split_ties=True)

        def single(frame: DataFrame) -> DataFrame:
            left = frame.alias("w").join(twice.alias("t"), same("w", "t"), "left_anti")
            return left.withColumn("n", F.lit(1).cast("bigint"))

        w = single(whole).unionByName(numbered(whole, "o"))
        m = single(taken).unionByName(numbered(made, "at").filter(F.size("positions") > 0))
        out = w.alias("w").join(m.alias("m"), same("w", "m", [*key, "n"]))
    out = out.select("w.doc", F.col("w.k").alias("k"), F.explode("m.positions").alias("p"))
    return (out.repartitionByRange(partitions(docs.sparkSession), "p")
            .sortWithinPartitions("p", "k").select("doc.*"))
