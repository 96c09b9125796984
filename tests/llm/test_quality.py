import math

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tillpoint.llm.quality import _hashed, drop_poor, score_documents


@pytest.fixture(scope="module")
def larger(spark):
    sf = SF.replace("0.001", "0.01")
    return (spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


def test_held_out_accuracy(larger):
    docs, labels = larger
    test = labels.filter("doc_id % 3 = 0")
    scores = score_documents(docs, labels.filter("doc_id % 3 <> 0")).cache()
    assert scores.count() == docs.count()
    rows = scores.join(test, "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    poor = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in poor) >= 0.85 * len(poor)


def test_stage_agrees_with_scores(larger):
    docs, labels = larger
    kept = {r.doc_id for r in score_documents(docs, labels).filter("kept").collect()}
    rest = drop_poor(docs, labels)
    assert rest.columns == docs.columns and {r.doc_id for r in rest.collect()} == kept


def test_edges(spark, edge_docs, no_docs, larger):
    labels = larger[1]
    assert score_documents(no_docs, labels).count() == 0
    out = score_documents(edge_docs, labels).collect()  # hardly any label: nothing to learn
    assert len(out) == edge_docs.count() and all(r.kept and r.score == 0.5 for r in out)
    both = edge_docs.drop("label").unionByName(larger[0], allowMissingColumns=True)
    doubled = labels.unionByName(labels).unionByName(
        spark.createDataFrame([(1, None, None), (None, 0, 0)], labels.schema))
    scored = score_documents(both, doubled).collect()
    assert len(scored) == both.count() and all(0 <= r.score <= 1 for r in scored)
    assert drop_poor(both, doubled).columns == both.columns


def plain_views(r):
    """Both views of a document by plain loops: {bin: weight} and a list of bins."""
    text = (r.text or "").encode()
    words = text.split()
    repeats = max(0, sum(a == b for a, b in zip(words, words[1:])) - 1)
    counts = {}
    for a, b, c in zip(text, text[1:], text[2:]):
        code = ((a << 16 | b << 8 | c) * 2654435761 % 2**32 >> 8) % 511
        counts[code] = counts.get(code, 0) + 1
    grams = {}
    if len(text) > 2:
        counts[511] = 8 * repeats
        total = sum(counts.values())
        grams = {k: round(255 * math.sqrt(n / total)) ** 2 for k, n in counts.items()}

    def log(x):
        return min(63, int(2 * math.log2(1 + x)))

    capitals, digits = sum(65 <= c <= 90 for c in text), sum(48 <= c <= 57 for c in text)
    letters = capitals + digits + sum(97 <= c <= 122 or c > 127 for c in text)
    blanks = sum(c == 32 or 9 <= c <= 13 for c in text)
    lines, n = text.split(b"\n"), max(1, len(text))
    odd = 1 - (letters + blanks + text.count(b",") + text.count(b".")) / n if text else 0
    shares = (capitals / n, digits / n, odd, 1 - len(set(lines)) / len(lines), repeats / (blanks + 8))
    return grams, [_hashed(r.source), _hashed(r.lang), 63 if r.n_chars is None else log(max(0, r.n_chars)),
                   log(len(lines)), log(n / len(lines)), log(letters / (blanks + 1)),
                   *(min(63, int(64 * x)) for x in shares)]


def platt(pairs):
    """Logistic fit by plain Newton steps, scores in the middle of their bins."""
    good, bad = sum(y for _, y in pairs), sum(1 - y for _, y in pairs)
    if not good or not bad:
        return 1.0, 0.0
    data = [((min(399, max(0, int((z + 20) / 40 * 400))) + 0.5) / 400 * 40 - 20,
             (good + 1) / (good + 2) if y else 1 / (bad + 2)) for z, y in pairs]
    a, b = 0.5, 0.0
    for _ in range(200):
        g1, g2, h11, h12, h22 = -1e-3 * a, 0.0, 1e-3, 0.0, 1e-6
        for x, t in data:
            p = 1 / (1 + math.exp(-(a * x + b)))
            w = p * (1 - p) + 1e-9 / len(data)
            g1, g2 = g1 + (t - p) * x, g2 + t - p
            h11, h12, h22 = h11 + w * x * x, h12 + w * x, h22 + w
        det = h11 * h22 - h12 * h12
        a += max(-0.5, min(0.5, (g1 * h22 - g2 * h12) / det))
        b += max(-2.0, min(2.0, (g2 * h11 - g1 * h12) / det))
    return max(a, 1e-3), b


def clip(z):
    return max(-20.0, min(20.0, z))


def brute(rows, label, held, rounds=2, confident=0.97):
    """Combined and single scores of every document, learnt by plain loops."""
    views = {r.doc_id: plain_views(r) for r in rows}

    def fit(by_view):
        grams, bins = [[0] * 512 for _ in range(2)], [[[0] * 64 for _ in range(11)] for _ in range(2)]
        for i, c in by_view["text"].items():
            for k, w in views[i][0].items():
                grams[c][k] += w
        for i, c in by_view["meta"].items():
            for f, b in enumerate(views[i][1]):
                bins[c][f][b] += 1
        text = [[math.log((x / 255**2 * 50 + 0.5) / (sum(g) / 255**2 * 50 + 256)) for x in g] for g in grams]
        meta = [[[math.log((x + 0.5) / (sum(f) + 32)) for x in f] for f in c] for c in bins]

        def raw(i):
            g, b = views[i]
            t = 20 * sum(w * (text[1][k] - text[0][k]) for k, w in g.items()) / max(1, sum(g.values()))
            return t, sum(meta[1][f][x] - meta[0][f][x] for f, x in enumerate(b))

        raws = {i: raw(i) for i in views}
        tested = [(raws[i], y) for i, y in label.items() if i in held and i in raws]
        lines = [platt([(z[v], y) for z, y in tested]) for v in (0, 1)]
        return {i: [clip(a * clip(z) + b) for z, (a, b) in zip(raws[i], lines)] for i in views}

    known = {i: y for i, y in label.items() if i in views and i not in held}
    odds = fit({"text": known, "meta": known})
    for _ in range(rounds):
        guessed = []
        for view in (0, 1):
            p = {i: 1 / (1 + math.exp(-odds[i][view])) for i in views if i not in label}
            guessed.append(known | {i: int(x >= confident) for i, x in p.items()
                                    if x >= confident or x <= 1 - confident})
        odds = fit({"text": guessed[1], "meta": guessed[0]})
    return {i: sum(z) / 2 for i, z in odds.items()}


def test_scores_match_brute_force(documents, labels):
    """Features, counts, exchanged labels, calibration and the mean, all by plain loops."""
    rows = documents.collect()
    held = {r.doc_id for r in documents.filter(
        F.pmod(F.xxhash64(F.col("doc_id"), F.lit("held out")), F.lit(1000)) < 200).collect()}
    label = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    want = brute(rows, label, held)
    for r in score_documents(documents, labels).collect():
        z = math.log(r.score / (1 - r.score))
        assert z == pytest.approx(want[r.doc_id], abs=1e-3), r
        assert r.kept == (r.score >= 0.5)
