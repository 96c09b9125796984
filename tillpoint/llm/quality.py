"""Quality classifier by co-training of two views.

The text view sees the content: a histogram of hashed byte trigrams of the whole text.  The
metadata view sees the page: source, language, length, lines, and the shares of capitals, digits,
symbols, repeated lines and repeated words, each as a few bins.  Both are naive Bayes models, so training is
counting: every round is one pass over the written features in which all documents take part.

* Round 0 fits both views on the labelled documents.
* In each later round a view's confident verdicts on documents without a label (calibrated
  probability beyond ``confident``) train the other view, beside the labelled documents.
* Each view is calibrated (Platt) on labelled documents held out by a hash of their id, from a
  histogram of scores.
* The combined score of a document averages the calibrated log odds of its views.

All sums are of whole numbers, so a rerun gives the same models.  What reaches the driver are class
sums and histograms of fixed size.  No sample is taken.

Edge cases: a null text is an empty one and is judged by its metadata; null source, language or
length are values of their own; a document with several labels counts as good only if all say
so; without labels of both classes nothing can be learnt and every document gets 0.5 and stays; an
empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import utf8
from tillpoint.operators.persist import materialize

GRAMS = 512
BINS = 64
META = ("source", "lang", "length", "lines", "line length", "word length", "capitals", "digits",
        "symbols", "repeated lines", "repeated words")
SIZES = {"text": GRAMS, "meta": BINS * len(META)}
SCORE_BINS = 400  # of score histograms, over log odds from -20 to 20
_MODEL = "view string, label int, sums array<long>, n long"


def text_view(text: bytes, repeats: int) -> np.ndarray:
    """Square roots of the shares of trigram bins, in 255ths.

    The last bin stands for words said twice in a row, at a word's length each.
    """
    a = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(GRAMS, np.uint8)
    codes = ((a[:-2] << 16 | a[1:-1] << 8 | a[2:]) * np.uint32(2654435761)) >> np.uint32(8)
    counts = np.bincount(codes % np.uint32(GRAMS - 1), minlength=GRAMS)
    counts[-1] = 8 * repeats
    return np.rint(255 * np.sqrt(counts / counts.sum())).astype(np.uint8)


def _hashed(value) -> int:
    if value is None:
        return BINS - 1
    return int.from_bytes(pd.util.hash_array(np.array([value], object), hash_key="0" * 16)
                          .tobytes()[:4], "little") % (BINS - 1)


def _log(x: float) -> int:
    return min(BINS - 1, int(2 * np.log2(1 + x)))


def meta_view(text: bytes, source, lang, n_chars, known: dict, repeats: int) -> np.ndarray:
    """Bin of each metadata feature."""
    a = np.frombuffer(text, np.uint8)
    n = max(1, len(a))
    per_byte = np.bincount(a, minlength=256)
    capitals, digits = per_byte[65:91].sum(), per_byte[48:58].sum()
    small = per_byte[97:123].sum() + per_byte[128:].sum() + capitals + digits
    blanks = per_byte[32] + per_byte[9:14].sum()
    plain = small + blanks + per_byte[44] + per_byte[46]
    lines = text.split(b"\n")
    repeated = 1 - len(set(lines)) / len(lines)
    for value in (source, lang):
        if value not in known:
            known[value] = _hashed(value)
    return np.array([
        known[source], known[lang], BINS - 1 if n_chars is None else _log(max(0, n_chars)),
        _log(len(lines)), _log(n / len(lines)), _log(small / (blanks + 1)),
        *(min(BINS - 1, int(BINS * share)) for share in
          (capitals / n, digits / n, 1 - plain / n if len(a) else 0, repeated,
           repeats / (blanks + 8)))], np.uint8)


def _views(text, source, lang, n_chars) -> tuple[np.ndarray, np.ndarray]:
    known: dict = {}
    texts, metas = [], []
    for t, s, l, c in zip(utf8(text), source, lang, n_chars):
        words = t.split()
        repeats = max(0, sum(map(eq, words, words[1:])) - 1)  # once may be chance
        texts.append(text_view(t, repeats))
        metas.append(meta_view(t, s, l, c, known, repeats))
    return (np.array(texts, np.uint8).reshape(-1, GRAMS),
            np.array(metas, np.uint8).reshape(-1, len(META)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text, meta = _views(b.column(1), *(b.column(k).to_pylist() for k in (2, 3, 4)))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([r.tobytes() for r in text], pa.binary()),
             pa.array([r.tobytes() for r in meta], pa.binary())], ["doc_id", "text", "meta"])


@dataclass
class Model:
    """Log odds of each view's bins, and its calibration (slope, intercept)."""

    text: np.ndarray
    meta: np.ndarray
    calibration: dict

    def raw(self, text: np.ndarray, meta: np.ndarray) -> dict:
        weights = np.square(text.astype(np.float64))
        total = np.maximum(1.0, weights.sum(axis=1))
        places = meta.astype(np.int64) + BINS * np.arange(len(META))
        return {"text": 20 * (weights @ self.text) / total, "meta": self.meta[places].sum(axis=1)}

    def odds(self, text: np.ndarray, meta: np.ndarray) -> dict:
        """Calibrated log odds of either view."""
        return {v: np.clip(self.calibration[v][0] * np.clip(r, -20, 20) + self.calibration[v][1],
                           -20, 20) for v, r in self.raw(text, meta).items()}


def _sigmoid(z):
    return 1 / (1 + np.exp(-z))


def _arrays(b: pa.RecordBatch) -> tuple:
    text = np.frombuffer(b"".join(b.column("text").to_pylist()), np.uint8).reshape(-1, GRAMS)
    meta = np.frombuffer(b"".join(b.column("meta").to_pylist()), np.uint8).reshape(-1, len(META))
    label = np.array([-1 if x is None else x for x in b.column("label").to_pylist()], np.int64)
    return text, meta, label, np.array(b.column("held").to_pylist(), bool)


def _counts(model: Model | None, confident: float):
    """Class sums of both views of a task's documents, by true or by the other view's label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {(v, c): [np.zeros(n, np.int64), 0] for v, n in SIZES.items() for c in (0, 1)}
        for b in batches:
            text, meta, label, held = _arrays(b)
            if not len(label):
                continue
            own = {"text": np.where(held, -1, label), "meta": np.where(held, -1, label)}
            if model is not None:
                odds = model.odds(text, meta)
                for view, other in (("text", "meta"), ("meta", "text")):
                    p = _sigmoid(odds[other])
                    guess = np.where(p >= confident, 1, np.where(p <= 1 - confident, 0, -1))
                    own[view] = np.where((label < 0) & ~held, guess, own[view])
            for c in (0, 1):
                at = own["text"] == c
                sums["text", c][0] += np.square(text[at].astype(np.int64)).sum(axis=0)
                sums["text", c][1] += int(at.sum())
                at = own["meta"] == c
                places = meta[at].astype(np.int64) + BINS * np.arange(len(META))
                sums["meta", c][0] += np.bincount(places.ravel(), minlength=SIZES["meta"])
                sums["meta", c][1] += int(at.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in sums]), pa.array([k[1] for k in sums], pa.int32()),
             pa.array([s[0].tolist() for s in sums.values()], pa.list_(pa.int64())),
             pa.array([s[1] for s in sums.values()], pa.int64())], ["view", "label", "sums", "n"])

    return run


def _histograms(model: Model):
    """Counts of held-out labelled documents by view, label and score bin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, meta, label, held = _arrays(b)
            for view, raw in model.raw(text, meta).items():
                at = held & (label >= 0)
                bins = np.clip((raw[at] + 20) / 40 * SCORE_BINS, 0, SCORE_BINS - 1).astype(np.int64)
                keys, counts = np.unique(2 * bins + label[at], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([view] * len(keys), pa.string()), pa.array(keys, pa.int64()),
                     pa.array(counts, pa.int64())], ["view", "key", "n"])

    return run


def _platt(counts: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic fit to score counts [bins, 2], with smoothed targets."""
    x = (np.arange(SCORE_BINS) + 0.5) / SCORE_BINS * 40 - 20
    bad, good = counts.sum(axis=0)
    if not bad or not good:
        return 1.0, 0.0
    targets = ((good + 1) / (good + 2), 1 / (bad + 2))
    slope, shift = 0.5, 0.0
    for _ in range(50):
        p = _sigmoid(slope * x + shift)
        both = counts.sum(axis=1)
        gap = counts[:, 1] * targets[0] + counts[:, 0] * targets[1] - both * p
        w = both * p * (1 - p) + 1e-9
        g = np.array([(gap * x).sum() - 1e-3 * slope, gap.sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, shift = slope + np.clip(step[0], -0.5, 0.5), shift + np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(slope, 1e-3), shift


def _fit(features: DataFrame, model: Model | None, confident: float) -> Model | None:
    sums = (features.mapInArrow(_counts(model, confident), _MODEL)
            .select("view", "label", "n", F.posexplode("sums").alias("at", "s"))
            .groupBy("view", "label", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
            .toPandas())
    log = {}
    for view, size in SIZES.items():
        by_class = []
        for c in (0, 1):
            part = sums[(sums["view"] == view) & (sums["label"] == c)]
            if part.empty or not part["n"].max():
                return None
            counts = np.zeros(size)
            counts[part["at"]] = part["s"]
            if view == "text":
                counts = counts / 255**2 * 50  # a document counts as fifty trigrams
                by_class.append(np.log((counts + 0.5) / (counts.sum() + 0.5 * size)))
            else:
                counts = counts.reshape(len(META), BINS)
                by_class.append(np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True)
                                                         + 0.5 * BINS)).ravel())
        log[view] = by_class[1] - by_class[0]
    fitted = Model(log["text"], log["meta"], {})
    rows = (features.filter("held and label is not null")
            .mapInArrow(_histograms(fitted), "view string, key long, n long")
            .groupBy("view", "key").agg(F.sum("n").alias("n")).toPandas())
    for view in SIZES:
        counts = np.zeros(2 * SCORE_BINS)
        part = rows[rows["view"] == view]
        counts[part["key"].astype(int)] = part["n"]
        fitted.calibration[view] = _platt(counts.reshape(SCORE_BINS, 2))
    return fitted


def co_train(docs: DataFrame, labels: DataFrame, rounds: int = 2, confident: float = 0.97,
             hold_out: float = 0.2) -> tuple[DataFrame, Model | None]:
    """(features of all documents, model after ``rounds`` exchanges of pseudo-labels)."""
    features = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang",
                           F.col("n_chars").cast("long").alias("n_chars")).mapInArrow(
        _features, "doc_id long, text binary, meta binary")
    known = (labels.filter("quality is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
             .agg(F.min("quality").cast("int").alias("label")))
    held = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(1000)) < int(1000 * hold_out)
    features = materialize(
        features.join(known, features["doc_id"] == known["id"], "left").drop("id")
        .withColumn("held", F.coalesce(F.col("label").isNotNull() & held, F.lit(False))),
        "quality-features")
    model = _fit(features.filter("label is not null"), None, confident)
    for _ in range(rounds if model is not None else 0):
        model = _fit(features, model, confident) or model
    return features, model


def _judged(model: Model | None, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
    if model is None:
        return [np.full(len(text), 0.5)] * 3
    odds = model.odds(text, meta)
    return [_sigmoid(z) for z in (odds["text"], odds["meta"], (odds["text"] + odds["meta"]) / 2)]


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
                    **parameters) -> DataFrame:
    """One row per document: doc_id, text_score, metadata_score, score, kept."""
    features, model = co_train(docs, labels, **parameters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, meta, _, _ = _arrays(b)
            scores = _judged(model, text, meta)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(s) for s in scores),
                 pa.array(scores[2] >= threshold)],
                ["doc_id", "text_score", "metadata_score", "score", "kept"])

    return features.mapInArrow(run, "doc_id long, text_score double, metadata_score double, "
                                    "score double, kept boolean")


def drop_poor(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
              **parameters) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    _, model = co_train(docs, labels, **parameters)

    @F.pandas_udf("boolean")
    def good(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]
             ) -> Iterator[pd.Series]:
        for text, source, lang, n_chars in batches:
            none = lambda s: [None if pd.isna(x) else x for x in s]
            views = _views(pa.array(none(text), pa.string()), none(source), none(lang),
                           [None if x is None else int(x) for x in none(n_chars)])
            yield pd.Series(_judged(model, *views)[2] >= threshold)

    return docs.filter(good("text", "source", "lang", F.col("n_chars").cast("long")))
