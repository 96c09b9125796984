import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillpoint.llm.packing import TOKENIZER, Words, best_fit, pack

PATH = public_tokenizers.path(TOKENIZER)
TOK = Tokenizer.from_file(PATH)
WORDS = Words(PATH, limit=500)


def ids_of(text):
    return [*TOK.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, out, capacity):
    """Every document's pieces are whole and every sequence is gapless; the sequence count."""
    want = sorted(tuple(ids_of(t)) for _, t in rows)
    by_bin = defaultdict(list)
    for r in out:
        by_bin[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    for part in by_bin.values():
        part.sort(key=lambda r: r.offset)
        assert [r.offset for r in part] == [sum(x.length for x in part[:k]) for k in range(len(part))]
        assert sum(r.length for r in part) <= capacity
    pieces = sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, tuple(r.ids)) for r in out)
    assert all(p[3] == p[2] * capacity for p in pieces)
    assert sum(r.length for r in out) == sum(map(len, want))
    if len({i for i, _ in rows}) == len(rows):
        whole = defaultdict(list)
        for _, i, _, _, ids in pieces:
            whole[i] += ids
        assert sorted(map(tuple, whole.values())) == want
    return len(by_bin)


def test_whole_table(documents, texts):
    out = pack(documents, with_ids=True).collect()
    total = sum(r.length for r in out)
    assert check(texts, out, 4096) <= -(-total // 4096) + 1


@pytest.mark.parametrize("items_per_task", [3, 20_000])
def test_rounds_over_many_partitions(documents, texts, items_per_task):
    out = pack(documents.repartition(9, "doc_id"), capacity=512, chunk=7, with_ids=True,
               items_per_task=items_per_task).collect()
    total = sum(r.length for r in out)
    assert check(texts, out, 512) <= 1.15 * total / 512 + 2


def test_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    check(rows, pack(edge_docs, with_ids=True).collect(), 4096)
    assert pack(no_docs).count() == 0


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet=st.sampled_from(list("aAbT.,'s! \t\n\x0b\x0c\x85\xa0 é́̈İKß漢9<|>")),
               max_size=30))
def test_words_as_the_tokenizer(text):
    for t in (text, text + "<|endoftext|>", "<|ENDOFTEXT|>" + text):
        got = np.frombuffer(WORDS.encode([t.encode()])[0], "<u4").tolist()
        assert got == TOK.encode(t, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit(sizes):
    bins = best_fit([(s, [(k, 0, 0, s, 0, 0, None)]) for k, s in enumerate(sizes)], 50)
    assert sum(u for u, _ in bins) == sum(sizes) and all(u <= 50 for u, _ in bins)
    assert sorted(m[0] for _, ms in bins for m in ms) == list(range(len(sizes)))
    under = sorted(u for u, _ in bins)[:2]
    assert len(under) < 2 or sum(under) > 50
