import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillpoint.llm.trie import end_digests, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, family=20, borrowed=3):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, mine in turns.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % (borrowed + 1)
        lead = turns.get(c - int(math.fmod(c, family)), []) if h else []
        rebuilt[c] = lead[:h] + mine[h:]
    nodes = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes[tuple(seq[:d])].append(c)
    n_children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            n_children[path[:-1]] += 1
    for path, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not n_children[path]
            saved[path[:d]] += (len(members) - 1) * words

    def low(path):
        return min((c for c in nodes[path] if c is not None), default=None)

    out = []
    for path, members in nodes.items():
        ends = sorted((c for c in members if len(rebuilt[c]) == len(path)),
                      key=lambda c: (c is not None, c or 0))
        listed = ",".join("" if c is None else str(c) for c in ends)
        out.append((low(path), len(path), low(path[:-1]) if path else None, len(members),
                    n_children[path], leaves[path], saved[path],
                    hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=order)


def order(row):
    return [(x is not None, x if x is not None else 0) for x in row]


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=order)


@pytest.fixture(scope="module")
def deep():
    """Conversations of up to 70 turns with shared beginnings, some empty after the rebuilding."""
    rng = np.random.default_rng(13)
    rows = []
    for c in range(90):
        common = int(rng.integers(0, 60))
        n = int(rng.choice([1, 2, 3, 10, 40, 70]))
        kind = c % 3
        for t in range(n):
            text = f"w{kind} " * (t % 5 + 1) if t < common else f"own {c} {t}"
            rows.append((c + 7, t if t else None, "user" if t % 2 == 0 else "assistant", text))
    return rows


@pytest.mark.parametrize("band,block", [(2, 4), (16, 1024)])
def test_deep_trie_matches_brute_force(spark, deep, band, block):
    turns = spark.createDataFrame(deep, SCHEMA)
    assert rows_of(prefix_trie(turns, band=band, block=block, chunk=3)) == brute(deep)


def test_table_matches_brute_force(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(prefix_trie(turns)) == brute(rows)


def test_edges(spark):
    rows = [(1, 0, None, None), (1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", "a b"),
            (None, 0, "user", "x"), (None, 1, None, "y z"), (20, 0, "user", "hi"),
            (21, 0, "user", "hi"), (22, 0, "user", "hi"), (22, 0, "user", "hi"), (-7, 0, "a", "b"),
            (23, 0, "user", ""), (24, 5, "user", "x " * 50_000), (25, 5, "", "user")]
    turns = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("pos", "depth", "up", "x1", "name", "band", "said", "words", "own",
                               "low", "leaves", "saved", "_b", "_K", "part", "total")})
    assert rows_of(prefix_trie(turns)) == brute(rows)
    assert prefix_trie(turns.filter("false")).count() == 0


def test_one_conversation_with_most_turns(spark):
    rows = [(40, t, "user", f"t{t}") for t in range(300)] + [(c, 0, "user", "t0") for c in range(50)]
    turns = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(prefix_trie(turns, band=4, block=16)) == brute(rows)


def test_digest_of_a_node_over_many_chunks(spark):
    """A crowded node is hashed chunk by chunk, across partitions."""
    rows = [(1, 5, 6, c, str(c)) for c in range(-50, 3000)] + [(2, k, 0, k, str(k)) for k in range(40)]
    ends = spark.createDataFrame(rows, "depth long, x1 long, x2 long, conv_id long, name string")
    made = {(r.depth, r.x1): r.digest for r in end_digests(ends, 64).collect()}
    assert len(made) == 41
    listed = ",".join(str(c) for c in range(-50, 3000))
    assert made[1, 5] == hashlib.sha256(listed.encode()).hexdigest()
    assert made[2, 9] == hashlib.sha256(b"9").hexdigest()
