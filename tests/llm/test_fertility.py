import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tillpoint.llm.fertility import MEASURES, bands, judge, measure, repeated

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    earlier = sum(x in lines[:k] for k, x in enumerate(lines))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), earlier,
            len(covered), failed)


def base_of(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words,
            row.base_failed)


@pytest.fixture(scope="module")
def judged(documents):
    return judge(documents, class_documents=20).collect()


def test_counts_match_brute_force(judged, texts):
    assert sorted((r.doc_id, *base_of(r)) for r in judged) == sorted(
        (i, *base(t)) for i, t in texts)


def test_token_figures_match_the_vocabulary(judged, texts):
    pieces = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    by_id = {r.doc_id: r for r in judged}
    for i, text in texts[:60]:
        words = WORD.findall(text)
        ids = [t for w in words for t in pieces.encode(w)]
        row = by_id[i]
        assert row.n_tokens == len(ids)
        if ids:
            shares = [n / len(ids) for n in Counter(ids).values()]
            assert row.chars_per_piece == pytest.approx(sum(map(len, words)) / len(ids))
            assert row.byte_share == pytest.approx(sum(map(pieces.is_byte, ids)) / len(ids))
            assert row.entropy == pytest.approx(-sum(p * math.log2(p) for p in shares))


def test_verdicts_match_brute_force_bands(judged):
    """Medians and deviations of every class over all documents, by sorting."""
    def keys(r):
        size = int(math.log2(r.n_tokens))
        return [(r.lang, r.script, size), (r.lang, r.script, -1), (None, r.script, -1)]

    def median(values):
        return sorted(values)[(len(values) - 1) // 2]

    # half up, as Spark rounds
    bins = {m: [math.floor(getattr(r, m) / w + 0.5) for r in judged]
            for m, (w, _, _) in MEASURES.items()}
    classes = {}
    for k, r in enumerate(judged):
        for key in keys(r) if r.n_tokens else []:
            classes.setdefault(key, []).append(k)
    for r in judged:
        outside = []
        known = [classes[k] for k in keys(r) if len(classes[k]) >= 20] if r.n_tokens else []
        for m, (w, least, two_sided) in MEASURES.items():
            if known:
                values = [bins[m][k] for k in known[0]]
                mid = median(values)
                reach = 4.5 * (1 + 64 / r.n_tokens) * max(1.4826 * w * median([abs(v - mid) for v in values]), least)
                x = getattr(r, m)
                if x > w * mid + reach + 1e-9 or two_sided and x < w * mid - reach - 1e-9:
                    outside.append(m)
        assert r.outside == outside and r.kept == (not r.base_failed and not outside)


def test_junk_goes_and_good_documents_stay(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = judge(docs).filter("not base_failed").join(labels_of(spark), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    poor = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(poor) < 0.6


def labels_of(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")


def test_foreign_script_is_outside_its_language(spark):
    """Fallback bytes and few characters a token, beside many ordinary texts."""
    words = "the quick brown fox jumps over a lazy dog and then runs back home".split()
    rng = np.random.default_rng(11)
    rows = [(k, " ".join(rng.choice(words, 60)), "en") for k in range(120)]
    rows += [(1000, "𒀀𒀁𒀂𒀃 " * 3 + " ".join(f"𒀀{chr(0x12000 + j)}" for j in range(37)), "en")]
    rows += [(1001, " ".join(f"zxq{j}vkj{j * j}w" for j in range(40)), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    by_id = {r.doc_id: r for r in judge(docs).collect()}
    assert all(by_id[k].kept for k in range(120))
    assert by_id[1000].byte_share > 0.5 and by_id[1000].script == "symbols"
    assert "chars_per_piece" in by_id[1001].outside and not by_id[1001].kept


def test_edges(edge_docs, no_docs):
    rows = judge(edge_docs).collect()
    texts = [r.text or "" for r in edge_docs.select("text").collect()]
    assert sorted(map(base_of, rows)) == sorted(map(base, texts))
    assert judge(no_docs).count() == 0


def test_repeated_windows_of_long_text():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 6, 3000)
    windows = Counter(tuple(ids[k:k + 5]) for k in range(len(ids) - 4))
    covered = {k + j for k in range(len(ids) - 4) if windows[tuple(ids[k:k + 5])] > 1
               for j in range(5)}
    assert repeated(ids) == len(covered)


def test_bands_count_every_document_once(documents):
    """A class's documents are summed, never listed: rows are bounded by bins, not by documents."""
    measured = measure(documents.unionByName(documents)).cache()
    doubled = {(r.lang, r.script, r.size): r for r in bands(measured, 4.5, 40).collect()}
    single = {(r.lang, r.script, r.size): r
              for r in bands(measure(documents), 4.5, 20).collect()}
    assert doubled == single
    assert measured.agg(F.max("n_tokens")).first()[0] > 1000
