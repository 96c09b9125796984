import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tillpoint.llm.exact_dedup import Directory, drop_copies, exact_groups, normalise


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[norm(text)].append(i)
    out = []
    for body, ids in groups.items():
        low = min((i for i in ids if i is not None), default=None)
        kept = ids.index(low)
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, low, len(ids), k == kept, sha) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def got(df):
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=str)


@given(st.text(alphabet=" \t\n\x0b\x0c\rab\x85é", max_size=12))
def test_normalise(text):
    assert normalise(text.encode()) == norm(text).encode()


def test_whole_table(documents, texts):
    assert got(exact_groups(documents)) == brute(texts)


@pytest.mark.parametrize("key_bits, capacity, flush", [(3, 1, 1 << 20), (64, 4, 300), (64, 8192, 64)])
def test_collisions_splits_and_flushes(spark, documents, texts, key_bits, capacity, flush):
    spread = documents.repartition(5, "doc_id")
    found = exact_groups(spread, capacity=capacity, key_bits=key_bits, flush_bytes=flush)
    assert got(found) == brute(texts)
    if key_bits == 3:
        assert found.agg({"chain": "max"}).first()[0] > 0  # different texts under one hash


def test_directory_doubles(spark):
    hashes = spark.createDataFrame([(int(x),) for x in np.arange(1 << 10, dtype=np.int64) << 50],
                                   "h long")  # crowded under one prefix
    d = Directory.build(hashes, capacity=64)
    assert len(d.slots) == 1 << d.depth and max(d.local) == d.depth
    assert sorted(set(d.slots.tolist())) == list(range(len(d.local)))


def test_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert got(exact_groups(edge_docs)) == brute(rows)
    assert exact_groups(no_docs).count() == 0 and drop_copies(no_docs).count() == 0


def test_drop_copies(edge_docs, documents, texts):
    kept = drop_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    want = sorted([r[0] for r in brute([(r.doc_id, r.text) for r in edge_docs.collect()]) if r[3]], key=str)
    assert sorted([r.doc_id for r in kept.collect()], key=str) == want
    assert drop_copies(documents).count() == sum(r[3] for r in brute(texts))
