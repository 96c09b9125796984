r"""Quality rules by tokeniser fertility.

Two public vocabularies measure every whole text, word by word:

* characters per token of a piece vocabulary with byte fallback, and of a byte-level one;
* the share of the piece vocabulary's tokens that are fallback bytes;
* the entropy of its tokens, in bits, over the text.

Rejection bands belong to a language and script (the ``lang`` column and the script most of the
text's letters are in) and to a class of length, powers of two of the token number, because the
entropy of a short text is low by nature.  A band is the median over all documents of the class,
plus and minus ``width`` robust deviations (the median absolute deviation, at least the measure's
``least``); a text of n tokens gets 1 + ``short_tokens`` / n times that reach, because the few words of
a short text say little.  A class of fewer than ``class_documents`` documents takes the band of its
language and script, one that is small itself that of its script over all languages, and a small
script rejects nothing.  Medians come from counts of fixed-width bins, which
Spark sums like any other count, so every document counts and no list of values is ever held.

Base rules come first: under 10 words, or more than a fifth of the words in repeated windows.

Edge cases: a null or blank text has no words and fails the base rules; a null language is the empty
one; rows that share an id are judged each on its own; an empty table gives no row.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import utf8
from tillpoint.operators.persist import materialize

PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
_MEASURED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, lang string, script string, n_tokens long, "
             "chars_per_piece double, chars_per_byte_token double, byte_share double, "
             "entropy double")
# Measure: (width of a bin, least deviation that counts, bands are two-sided).
MEASURES = {"chars_per_piece": (0.01, 0.04, True), "chars_per_byte_token": (0.01, 0.04, True),
            "byte_share": (0.001, 0.01, False), "entropy": (0.02, 0.06, True)}
# First UTF-8 byte of a letter: script.
SCRIPTS = (("latin", (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCB))),
           ("greek", (0xCD, 0xCE, 0xCF)), ("cyrillic", (0xD0, 0xD1, 0xD2, 0xD3)),
           ("semitic", tuple(range(0xD6, 0xDE))), ("indic", (0xE0,)), ("other", (0xE1, 0xE2)),
           ("east asian", tuple(range(0xE3, 0xEE))), ("symbols", (0xEF, 0xF0, 0xF3, 0xF4)))
_SPACES = [0x20, *range(0x09, 0x0E)]
_SYMBOLS = list(b"#*$%&|<>")
_SCRIPT_OF = np.full(256, len(SCRIPTS), np.int64)
for _k, (_, _lead) in enumerate(SCRIPTS):
    _SCRIPT_OF[list(_lead)] = _k


class Vocabulary:
    """Token figures of words, each tokenised once; a worker keeps at most ``limit`` tokens."""

    def __init__(self, pieces: str, byte_level: str, limit: int = 8_000_000):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(byte_level, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=ranks, special_tokens={})
        size = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(size)])
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.empty(0, np.int32)  # the words' pieces, one word after the other
        self.starts = np.zeros(1, np.int64)
        self.n_bytes = np.empty(0, np.int64)

    def number(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """The numbers of the words of each text."""
        if len(self.flat) > self.limit:
            self.clear()
        new = list(set().union(*texts).difference(self.known))
        if new:
            words = [w.decode() for w in new]
            pieces = self.pieces.encode(words, num_threads=1)
            lengths = np.fromiter(map(len, pieces), np.int64, len(new))
            own = np.fromiter(chain.from_iterable(pieces), np.int32, int(lengths.sum()))
            self.flat = np.concatenate([self.flat, own])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
            encode = self.bytes.encode_ordinary
            self.n_bytes = np.concatenate(
                [self.n_bytes, np.fromiter((len(encode(w)) for w in words), np.int64, len(new))])
            first = len(self.known)
            self.known.update(zip(new, range(first, first + len(new))))
        get = self.known.__getitem__
        return [np.fromiter(map(get, words), np.int64, len(words)) for words in texts]

    def tokens(self, ids: np.ndarray) -> np.ndarray:
        """The pieces of the numbered words, one after the other."""
        start, size = self.starts[ids], self.starts[ids + 1] - self.starts[ids]
        ends = np.cumsum(size)
        return self.flat[np.arange(ends[-1]) + np.repeat(start - ends + size, size)]


def _vocabulary(pieces: str | None, byte_level: str | None) -> Vocabulary:
    """The vocabularies and their known words, kept in the worker process from task to task."""
    if pieces is None or byte_level is None:
        import public_tokenizers

        pieces = pieces or public_tokenizers.path(PIECES)
        byte_level = byte_level or public_tokenizers.path(BYTES)
    kept = vars(sys.modules.setdefault("tillpoint_kept", types.ModuleType("tillpoint_kept")))
    at = f"{pieces}|{byte_level}"
    if at not in kept:
        kept[at] = Vocabulary(pieces, byte_level)
    return kept[at]


def repeated(ids: np.ndarray, window: int = 5) -> int:
    """Words covered by windows that occur at least twice in the text."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    place = np.unique(ids, return_inverse=True)[1]
    code = place[:n]
    for k in range(1, window):  # windows of k + 1 words are numbered from those of k
        code = np.unique(code * len(ids) + place[k:k + n], return_inverse=True)[1]
    often = np.bincount(code)[code] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:n] += often
    edge[window:window + n] -= often
    return int((np.cumsum(edge[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _measure(pieces: str | None, byte_level: str | None, group_bytes: int = 1 << 20):
    columns = [c.split() for c in _MEASURED.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}

    def of_group(group: list, vocabulary: Vocabulary) -> pa.RecordBatch:
        texts = [t.split() for _, _, t in group]
        out = []
        for (doc_id, lang, text), ids in zip(group, vocabulary.number(texts)):
            count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
            chars = int(count.sum() - count[0x80:0xC0].sum() - count[_SPACES].sum())
            letters = np.bincount(_SCRIPT_OF, count, len(SCRIPTS) + 1)[:-1]
            script = SCRIPTS[int(letters.argmax())][0] if letters.any() else ""
            figures = (0, 0.0, 0.0, 0.0, 0.0)
            tokens = vocabulary.tokens(ids) if len(ids) else ids
            if n := len(tokens):  # a word of invisible characters alone has no piece
                held = np.bincount(tokens)
                p = held[held > 0] / n
                figures = (n, chars / n, chars / int(vocabulary.n_bytes[ids].sum()),
                           float(vocabulary.is_byte[tokens].sum() / n),
                           float(abs((p * np.log2(p)).sum())))
            out.append((doc_id, len(ids), chars, int(count[_SYMBOLS].sum()),
                        duplicate_lines(text), repeated(ids), lang, script, *figures))
        return pa.RecordBatch.from_arrays(
            [pa.array(v, kinds[kind]) for v, (_, kind) in zip(zip(*out), columns)],
            [name for name, _ in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(pieces, byte_level)
        group, size = [], 0
        for batch in batches:
            for doc_id, lang, text in zip(batch.column(0).to_pylist(),
                                          batch.column(1).to_pylist(), utf8(batch.column(2))):
                group.append((doc_id, lang, text))
                size += len(text)
                if size >= group_bytes:
                    yield of_group(group, vocabulary)
                    group, size = [], 0
        if group:
            yield of_group(group, vocabulary)

    return run


def measure(docs: DataFrame, pieces: str | None = None,
            byte_level: str | None = None) -> DataFrame:
    """One row per document with its counts and token figures."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
                       ).mapInArrow(_measure(pieces, byte_level), _MEASURED)


def length_class() -> Column:
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int")


def _levels() -> Column:
    """A document's band keys, from the narrowest to the widest."""
    def key(lang, size):
        return F.struct(lang.alias("lang"), F.col("script"), size.alias("size"))

    return F.array(key(F.col("lang"), length_class()), key(F.col("lang"), F.lit(-1)),
                   key(F.lit(None).cast("string"), F.lit(-1)))


def bands(measured: DataFrame, width: float, class_documents: int) -> DataFrame:
    """(lang, script, size, and mid_m, down_m and up_m of every measure m).

    ``size`` -1: all lengths; null ``lang``: all languages.  A text is inside between mid - down
    and mid + up.
    """
    listed = F.array(*[F.struct(F.lit(m).alias("m"), F.round(F.col(m) / w).cast("long").alias("bin"))
                       for m, (w, _, _) in MEASURES.items()])
    key = ["lang", "script", "size", "m"]
    counts = (measured.filter("n_tokens > 0")
              .select(F.explode(_levels()).alias("k"), listed.alias("listed"))
              .select("k.*", F.explode("listed").alias("x"))
              .groupBy("lang", "script", "size", F.col("x.m").alias("m"), F.col("x.bin").alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    # A class has no more bins than a measure has, whatever the number of documents.
    own = Window.partitionBy(*key)

    def middle(frame: DataFrame, value: str, out: str) -> DataFrame:
        run = F.sum("n").over(own.orderBy(value).rangeBetween(Window.unboundedPreceding, 0))
        return (frame.withColumn("run", run).withColumn("all", F.sum("n").over(own))
                .withColumn(out, F.min(F.when(2 * F.col("run") >= F.col("all"), F.col(value)))
                            .over(own)))

    spread = middle(middle(counts, "bin", "median")
                    .withColumn("off", F.abs(F.col("bin") - F.col("median"))), "off", "mad")
    limits = (spread.filter(F.col("all") >= class_documents)
              .groupBy(*key).agg(F.first("median").alias("median"), F.first("mad").alias("mad")))
    out = []
    for m, (w, least, two_sided) in MEASURES.items():
        reach = width * F.greatest(1.4826 * w * F.col("mad"), F.lit(least))
        mine = F.col("m") == m
        down = reach if two_sided else F.lit(float("inf"))
        out += [F.max(F.when(mine, c)).alias(f"{name}_{m}") for name, c in (
            ("mid", w * F.col("median")), ("down", down), ("up", reach))]
    return limits.groupBy("lang", "script", "size").agg(*out)


def judge(docs: DataFrame, width: float = 4.5, class_documents: int = 50,
          short_tokens: int = 64, min_words: int = 10, max_repeat_percent: int = 20,
          **files) -> DataFrame:
    """One row per document: counts, token figures, base_failed, outside (measures) and kept."""
    measured = materialize(measure(docs, **files), "fertility-measured")
    table = materialize(bands(measured, width, class_documents), "fertility-bands")
    names = [f"{side}_{m}" for m in MEASURES for side in ("mid", "down", "up")]
    frame = measured.withColumn("size", length_class())
    levels = [("a", [F.col("lang") == F.col("a_lang"), F.col("size") == F.col("a_size")]),
              ("b", [F.col("lang") == F.col("b_lang"), F.col("b_size") == -1]),
              ("c", [F.col("c_lang").isNull(), F.col("c_size") == -1])]
    for level, (name, on) in zip(("size >= 0", "size = -1 and lang is not null", "lang is null"),
                                 levels):
        side = table.filter(level).select(
            *[F.col(c).alias(f"{name}_{c}") for c in ("lang", "script", "size", *names)])
        condition = F.col("script") == F.col(f"{name}_script")
        for c in on:
            condition = condition & c
        frame = frame.join(side, condition, "left")
    outside = []
    wider = 1 + F.lit(float(short_tokens)) / F.greatest(F.col("n_tokens"), F.lit(1))
    for m in MEASURES:
        def limit(side):
            return F.coalesce(*[F.col(f"{level}_{side}_{m}") for level, _ in levels])

        off = F.col(m) - limit("mid")
        outside.append(F.when((F.col("n_tokens") > 0) & (
            (off < -wider * limit("down")) | (off > wider * limit("up"))), F.lit(m)))
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return (frame.withColumn("base_failed", failed)
            .withColumn("outside", F.array_compact(F.array(*outside)))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", (~F.col("base_failed") & (F.size("outside") == 0)).alias("kept"),
                    "lang", "script", "n_tokens", *MEASURES, "outside"))
