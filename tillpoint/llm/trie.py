r"""Conversation prefix trie, rolled up by bands of depth.

A node is a distinct sequence of first turns; its members are the conversations that start with it.
Sums over a node's subtree (leaves, tokens that sharing the prefix saves) are found in bands of
``band`` depths:

1. *Within a band.*  A node adds its own figures to its ancestors inside its band, at most ``band`` of
   them.  The top of a band (band root) then holds the sums of its part of the band.
2. *Across bands.*  The band roots are a trie of their own, ``band`` times less deep, which is rolled up
   in the same way; its totals are complete.
3. A complete band root adds its total to the nodes of the band above that lie over it.

So the rounds grow with the logarithm of the depth to the base ``band``, and no row is exploded to
more than ``band`` rows, however deep the trie is.

A prefix is known by two 64-bit sums (exclusive or) over hashes of (depth, SHA-256 of role and text),
one hundred and twenty-eight bits that need no turn's text.  They are running sums in blocks of
``block`` depths, turns are numbered by range-bucketed windows, and ancestors are gathered by
(conversation, band), so a conversation with a third of all turns is spread like any other.

The digest of the conversations that end at a node is a sequential hash by definition.  Ids are sorted
and joined to chunks in parallel; of a node that spans several chunks one task hashes the chunks one
after the other and holds one of them at a time.

Edge cases: a null role or text is an empty one; null turn numbers come first; turns with equal numbers
are ordered by role and text; rows without a conv_id are one conversation that keeps its own turns,
has no part in the smallest member and an empty text in the list of ends; equal turns count as often
as they stand; the remainder of a negative id is negative; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import NOT_WS, partitions
from tillpoint.operators.persist import materialize
from tillpoint.operators.windows import ordered_window

NODE = ["depth", "x1", "x2"]
NOTHING = hashlib.sha256(b"").hexdigest()


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, said, words) of every turn, in its conversation's order."""
    plain = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return (ordered_window(plain, [("turn", True), ("role", True), ("text", True)], ["conv_id"],
                           row_number="pos", split_ties=True)
            .select("conv_id", "pos", said.alias("said"),
                    F.regexp_count("text", F.lit(NOT_WS)).cast("long").alias("words")))


def rebuild(turns: DataFrame, family: int, borrowed: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(steps, conversations) after each conversation took over its family's first turns.

    The first h turns of conversation c are those of conversation c - c % ``family``, where
    h = crc32(c) % (``borrowed`` + 1); its own turns after its first h follow.

    steps: conv_id, depth from 1, said, words.  conversations: conv_id, total (steps).
    """
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))  # never null, so it joins
    lengths = materialize(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")),
                          "trie-lengths")
    h = F.when(F.col("conv_id").isNull(), 0).otherwise(
        F.crc32(F.col("conv_id").cast("string")) % (borrowed + 1))
    asked = lengths.select("conv_id", "own", h.alias("h"), name.alias("name"),
                           (F.col("conv_id") - F.col("conv_id") % family).alias("leader"))
    led = lengths.select(F.col("conv_id").alias("leader"), F.col("own").alias("led"))
    known = materialize(
        asked.join(led, "leader", "left")
        .withColumn("taken", F.least(F.col("h"), F.coalesce("led", F.lit(0)))), "trie-known")
    # Every block of a conversation's turns finds what is known of it under a key of its own.
    spread = known.select("name", "h", "taken", F.explode(
        F.sequence(F.lit(0), F.floor(F.col("own") / block))).alias("part"))
    own = (turns.select("conv_id", "pos", "said", "words", name.alias("name"),
                        F.floor(F.col("pos") / block).alias("part"))
           .join(spread, ["name", "part"]).filter("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "said",
                   "words"))
    first = turns.filter(F.col("pos") <= borrowed).select(
        F.col("conv_id").alias("leader"), F.col("pos").alias("depth"), "said", "words")
    taken = (known.filter("h > 0").select("conv_id", "leader", "h").join(first, "leader")
             .filter("depth <= h").select("conv_id", "depth", "said", "words"))
    total = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return own.unionByName(taken), known.select("conv_id", "name", total.alias("total"))


def prefixes(steps: DataFrame, conversations: DataFrame, block: int) -> DataFrame:
    """(conv_id, name, depth, x1, x2, words) of every prefix, the empty one at depth 0 too."""
    def part(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), F.col("depth"), F.col("said"))

    name = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    rows = materialize(
        steps.select("conv_id", name.alias("name"), F.col("depth").cast("long").alias("depth"),
                     part(1).alias("y1"), part(2).alias("y2"), "words")
        .withColumn("part", F.floor(F.col("depth") / block)), "trie-steps")
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (rows.groupBy("name", "part").agg(F.bit_xor("y1").alias("y1"), F.bit_xor("y2").alias("y2"))
             .select("name", "part", *[F.coalesce(F.bit_xor(y).over(before), F.lit(0)).alias(b)
                                       for y, b in (("y1", "b1"), ("y2", "b2"))]))
    upto = Window.partitionBy("name", "part").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0)
    made = rows.join(bases, ["name", "part"]).select(
        "conv_id", "name", "depth", F.col("b1").bitwiseXOR(F.bit_xor("y1").over(upto)).alias("x1"),
        F.col("b2").bitwiseXOR(F.bit_xor("y2").over(upto)).alias("x2"), "words")
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "x1", "x2", "words")]
    return made.unionByName(conversations.select("conv_id", "name", *zero))


def climbing(rows: DataFrame, band: int, step: int) -> DataFrame:
    """Prefixes below the root with ``up``: the prefixes over them down from their band's root.

    Only depths that are multiples of ``step`` count, ``band`` of them to a band.  A band root
    looks up to the root of the band above.
    """
    at = F.expr(f"depth div {step}")
    bands = F.when((at > 0) & (at % band == 0), F.array(F.expr(f"depth div {step * band}") - 1,
                                                        F.expr(f"depth div {step * band}"))
                   ).otherwise(F.array(F.expr(f"depth div {step * band}")))
    listed = (rows.filter(F.col("depth") % step == 0)
              .select("conv_id", "name", F.explode(bands).alias("band"), "depth", "x1", "x2", "words")
              .groupBy("conv_id", "name", "band")
              .agg(F.sort_array(F.collect_list(F.struct(*NODE, "words"))).alias("line")))
    ids = F.transform("line", lambda s: F.struct(*[s[c].alias(c) for c in NODE]))
    return (listed.withColumn("ids", ids)
            .select("conv_id", "ids", F.posexplode("line").alias("at", "s")).filter("at > 0")
            .select("conv_id", "s.*", F.slice("ids", F.lit(1), F.col("at")).alias("up")))


def rollup(tree: DataFrame, rows: DataFrame, band: int, step: int, deepest: int) -> DataFrame:
    """(depth, x1, x2, leaves, saved): sums over subtrees of ``tree(depth, x1, x2, up, leaves, saved)``."""
    def summed(frame: DataFrame) -> DataFrame:
        return frame.groupBy(*NODE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    root = (F.col("depth") % (step * band)) == 0
    inside = F.when(root, F.array(F.struct(*NODE))).otherwise(
        F.concat("up", F.array(F.struct(*NODE))))
    within = summed(tree.select(F.explode(inside).alias("a"), "leaves", "saved")
                    .select("a.*", "leaves", "saved"))
    if deepest // step < band:
        return within
    within = materialize(within, "trie-within")
    lines = climbing(rows, band, step * band).select(*NODE, "up").distinct()
    tops = within.filter(root).join(lines, NODE, "left").withColumn("up", F.coalesce(
        "up", F.array().cast(lines.schema["up"].dataType)))
    complete = materialize(rollup(tops, rows, band, step * band, deepest), "trie-complete")
    # The first of ``up`` is the band root above, which is complete already.
    handed = summed(
        complete.filter("depth > 0").join(tree.select(*NODE, "up"), NODE)
        .select(F.explode(F.slice("up", F.lit(2), F.size("up"))).alias("a"), "leaves", "saved")
        .select("a.*", "leaves", "saved"))
    others = within.filter(~root).join(
        handed.select(*NODE, F.col("leaves").alias("l"), F.col("saved").alias("s")), NODE, "left")
    return others.select(*NODE, *[(F.col(c) + F.coalesce(d, F.lit(0))).alias(c)
                                  for c, d in (("leaves", "l"), ("saved", "s"))]).unionByName(complete)


_ENDS = "depth long, x1 long, x2 long, lead long, ids string, digest string"


def _chunks(size: int):
    """Rows (depth, x1, x2, conv_id, name) in order to digests, or chunks of what may go on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at, lead, names, whole = None, None, [], False

        def close(last: bool) -> None:
            if names:
                ids = ",".join(names)
                done = whole and last
                out.append((*at, lead, None if done else ids,
                            hashlib.sha256(ids.encode()).hexdigest() if done else None))

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 6
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if k < 4 else pa.string()) for k, c in enumerate(columns)],
                ["depth", "x1", "x2", "lead", "ids", "digest"])

        for b in batches:
            for *node, conv_id, name in zip(*(c.to_pylist() for c in b.columns)):
                if node != at:
                    close(True)
                    whole = at is not None  # a node behind another one starts here
                    at, lead, names = node, conv_id, []
                elif len(names) == size:
                    close(False)
                    whole, lead, names = False, conv_id, []
                names.append(name)
            yield batch()
        close(False)  # the next partition may go on with this node
        yield batch()

    return run


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order to one digest for each node; one chunk is held at a time."""
    at, digest = None, None
    for b in batches:
        out = []
        for *node, ids in zip(*(c.to_pylist() for c in b.columns)):
            if node != at:
                if at is not None:
                    out.append((*at, digest.hexdigest()))
                at, digest = node, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64() if k < 3 else pa.string()) for k, c in enumerate(columns)],
            [*NODE, "digest"])
    if at is not None:
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([v], pa.int64()) for v in at], pa.array([digest.hexdigest()])],
            [*NODE, "digest"])


def end_digests(ends: DataFrame, chunk: int) -> DataFrame:
    """(depth, x1, x2, digest) for nodes where a conversation ends: ends(depth, x1, x2, conv_id, name)."""
    n = partitions(ends.sparkSession)
    made = materialize(
        ends.select(*NODE, "conv_id", "name").repartitionByRange(n, *NODE, "conv_id")
        .sortWithinPartitions(*NODE, "conv_id").mapInArrow(_chunks(chunk), _ENDS), "trie-ends")
    parts = (made.filter("digest is null").select(*NODE, "lead", "ids").repartition(n, *NODE)
             .sortWithinPartitions(*NODE, "lead").select(*NODE, "ids"))
    return made.filter("digest is not null").select(*NODE, "digest").unionByName(
        parts.mapInArrow(_hash_chunks, "depth long, x1 long, x2 long, digest string"))


def prefix_trie(turns: DataFrame, family: int = 20, borrowed: int = 3, band: int = 16,
                block: int = 1024, chunk: int = 512) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    steps, conversations = rebuild(materialize(numbered_turns(turns), "trie-turns"), family, borrowed,
                                   block)
    rows = materialize(prefixes(steps, conversations, block), "trie-prefixes")
    counts = [F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("low"),
              F.min("words").alias("words")]
    below = climbing(rows, band, 1)
    root = rows.filter("depth = 0").groupBy(*NODE).agg(*counts).withColumn(
        "up", F.array().cast(below.schema["up"].dataType))
    nodes = materialize(below.groupBy(*NODE, "up").agg(*counts).unionByName(root.select(
        *NODE, "up", "n_convs", "low", "words")), "trie-nodes")
    over = F.element_at("up", -1)
    children = (nodes.filter("depth > 0").groupBy(*[over[c].alias(c) for c in NODE])
                .agg(F.count(F.lit(1)).alias("n_children")))
    tree = materialize(
        nodes.join(children, NODE, "left").fillna(0, ["n_children"])
        .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "trie-tree")
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    sums = rollup(tree.select(*NODE, "up", "leaves", "saved"), rows, band, 1, deepest)
    ends = end_digests(
        conversations.select("name", F.col("total").alias("depth")).join(rows, ["name", "depth"]),
        chunk)
    parents = tree.select(*[F.col(c).alias(f"p_{c}") for c in NODE], F.col("low").alias("parent"))
    # try_element_at: the root has nothing over it.
    above = F.try_element_at("up", F.lit(-1))
    return (tree.select(*NODE, "n_convs", "low", "n_children",
                        *[above[c].alias(f"p_{c}") for c in NODE])
            .join(sums, NODE).join(ends, NODE, "left")
            .join(parents, [f"p_{c}" for c in NODE], "left")
            .select(F.col("low").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"),
                    "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"),
                    F.coalesce("digest", F.lit(NOTHING)).alias("ends_sha256")))
