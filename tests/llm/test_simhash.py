import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import INTERNAL
import xxhash

from tillpoint.llm.common import connected_components
from tillpoint.llm.simhash import (chain_masks, drop_near_duplicates, fingerprint, links,
                                   near_duplicates, viable_chain)


def brute_fingerprint(text, n=4):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), 42)
         for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, distance):
    u = np.array(fps, np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= distance
    label = np.arange(len(u))
    while True:
        new = np.where(near, label[None, :], len(u)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    label = brute_components(fps, 4)
    low = {c: min((i for (i, _), x in zip(rows, label) if x == c and i is not None), default=None)
           for c in set(label)}
    return sorted([(i, f"{f:016x}", low[c]) for (i, _), f, c in zip(rows, fps, label)], key=str)


def test_whole_table(documents, texts):
    assert sorted(map(tuple, near_duplicates(documents).collect()), key=str) == brute(texts)


def test_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert sorted(map(tuple, near_duplicates(edge_docs).collect()), key=str) == brute(rows)
    assert near_duplicates(no_docs).count() == 0
    kept = drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    one_of_each(rows, kept.collect())


def one_of_each(rows, kept):
    """Exactly one row of every component, with the component's smallest id."""
    fps = sorted({brute_fingerprint(t or "") for _, t in rows})
    label = dict(zip(fps, brute_components(fps, 4).tolist()))
    ids = {}
    for i, t in rows:
        ids.setdefault(label[brute_fingerprint(t or "")], []).append(i)
    lowest = {c: min((i for i in v if i is not None), default=None) for c, v in ids.items()}
    found = [(label[brute_fingerprint(r.text or "")], r.doc_id) for r in kept]
    assert sorted(found, key=str) == sorted(lowest.items(), key=str)


def test_rows_of_one_id_are_told_apart(spark):
    """Near copies under one id, one id in several components, components without any id."""
    words = [f"w{k}" for k in range(400)]
    rows = [(7, " ".join(words)), (7, " ".join(words[:-1])), (7, "quite another text of the same id"),
            (7, "quite another text of the same id"), (8, " ".join(words[1:])), (9, "alone here in peace"),
            (None, "no id at all, first text"), (None, "no id at all, first text"),
            (None, "without any id as well, but different words stand here"), (3, ""), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("!") for c in INTERNAL})
    out = drop_near_duplicates(docs)
    assert out.columns == docs.columns and all(r.k == "!" for r in out.collect())
    one_of_each(rows, out.collect())


def test_fingerprint_of_long_text():
    text = "Word other " * 40_000 + "End"
    assert fingerprint(text.encode(), 4) == brute_fingerprint(text)


def test_every_close_pair_shares_a_chain():
    rng = np.random.default_rng(3)
    masks = np.array(chain_masks(10, 4, 7), np.uint64)
    for _ in range(3000):
        x = np.uint64(sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 5)), False)))
        assert viable_chain(np.array([x]), 10, 4)[0]
        assert ((x & masks) == 0).any()


@pytest.mark.parametrize("distance, limit", [(4, 256), (4, 3), (3, 3), (2, 2)])
def test_links_against_all_pairs(spark, distance, limit):
    rng = np.random.default_rng(distance + limit)
    fps = set()
    for size in (150, 20, 5, 3, 2, 1, 1):  # the first group crowds its buckets
        base = int(rng.integers(0, 2**63))
        for _ in range(size):
            bits = rng.choice(64, int(rng.integers(0, 5)), replace=False)
            fps.add(base ^ sum(1 << int(b) for b in bits))
    fps = sorted(fps)
    df = spark.createDataFrame([(x - ((x >> 63) << 64),) for x in fps], "fp long").repartition(3)
    found = connected_components(links(df, distance, 10, 7, limit), "t").toPandas()
    named = {n % 2**64: c % 2**64 for n, c in found[["node", "component"]].values.tolist()}
    label = brute_components(fps, distance)
    groups = lambda names: {frozenset(x for x, c in zip(fps, names) if c == n) for n in set(names)}
    assert groups([named.get(x, x) for x in fps]) == groups(label.tolist())
