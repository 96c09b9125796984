import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillpoint.llm.divergence import audit, distances, matrix, terms

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(rows, min_documents, top=50):
    """Dense sums over all kept terms, in whole numbers."""
    found, counts = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        own = words(text)
        found[lang].update(set(own))
        counts[lang, source].update(own)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in found[lang].items() if n >= min_documents)
        v = len(kept)

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * v) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        found_items = defaultdict(list)
        for a, b in permutations(sources, 2):
            found_items[a, "pair"].append((b, sum(abs(p[a][t] - p[b][t]) for t in kept)))
        for s in sources:
            found_items[s, "term"] += [(t, p[s][t] - q[t]) for t in kept
                                       if counts[lang, s][t] and p[s][t] > q[t]]
        for (s, part), items in found_items.items():
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            items = items[:top] if part == "term" else items
            out += [(lang, s, part, t, f, k + 1) for k, (t, f) in enumerate(items)]
    return sorted(out)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value",
                                                 "rank").collect())


def plain(docs):
    return [(r.lang, r.source, r.text) for r in docs.select("lang", "source", "text").collect()]


@pytest.mark.parametrize("k,tile_rows,tile_columns", [(4, 16, 1024), (2, 3, 7), (3, 1, 50)])
def test_audit_matches_dense_sums(documents, k, tile_rows, tile_columns):
    made = rows_of(audit(documents, 5, k=k, tile_rows=tile_rows, tile_columns=tile_columns))
    assert made == brute(plain(documents), 5)


def test_sparse_matrix_is_priced_by_quadrants(spark):
    """Sources with words of their own: nearly all quadrants are zero and never compared."""
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{chr(97 + s)}{''.join(chr(97 + int(x)) for x in rng.integers(0, 3, 3))}"
                         for _ in range(30)), "en", f"s{s}")
            for s in range(12) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert rows_of(audit(docs, 2, k=2, tile_rows=1, tile_columns=8)) == brute(plain(docs), 2)


def test_largest_values_stay_exact(spark):
    """One group with nearly all words: shares near 10^9 beside shares near 1."""
    rows = [(k, "big " * 5000 + ("rare" if k else ""), "en", "a") for k in range(4)]
    rows += [(9, "rare big rare", "en", "b"), (10, None, "en", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert rows_of(audit(docs, 2)) == brute(plain(docs), 2)


def test_edges(spark, edge_docs, no_docs):
    assert rows_of(audit(edge_docs, 2)) == brute(plain(edge_docs), 2)
    assert rows_of(audit(edge_docs, 100)) == brute(plain(edge_docs), 100)
    assert audit(no_docs).count() == 0
    alone = spark.createDataFrame([(1, "a b", "en", "s")],
                                  "doc_id long, text string, lang string, source string")
    assert rows_of(audit(alone, 1)) == brute(plain(alone), 1) == []


def test_terms_lower_ascii_letters_only():
    text = "Straße ÉTÉ x1y_Z \x7f q"
    assert [t.decode() for t in terms(text.encode())] == words(text) == [
        "straße", "ÉtÉ", "x", "y", "z", " q"]


def test_empty_quadrants_never_reach_the_cells(documents):
    """The leaves that are compared hold a stored tile on one side at least."""
    groups, cells = matrix(documents, 5)
    made = distances(groups, cells, k=2, tile_rows=2, tile_columns=16)
    both = {(r.lang, r.source, r.other): r.f for r in made.collect()}
    assert both and all(both[lang, b, a] == f for (lang, a, b), f in both.items())
    assert cells.filter(F.col("p") <= 0).count() == 0
