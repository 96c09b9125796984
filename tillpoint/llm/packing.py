"""Best-fit packing of tokenised documents: hierarchical residual packing.

Every scan task tokenises its documents, cuts those longer than a sequence, and packs its own
pieces best-fit in order of falling length.  Sequences that are nearly full are final.  The
underfull ones go on as items of their own: each round deals them to fewer tasks, which pack them
best-fit into one another, until one task has seen them all or a round no longer helps.  A
task's share of a round is ``items_per_task`` sequences, so no task grows with the corpus.  Every
round is a written table.

Edge cases: a null or empty text is the single end token; a document of exactly ``capacity`` tokens
is one piece and one sequence; rows that share an id are packed separately; an empty table gives no
row.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import doc_text, utf8
from tillpoint.operators.persist import materialize

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
_ITEM = ("struct<doc_id: long, piece: int, start: long, length: long, ids_crc32: long, "
         "offset: long, ids: array<int>>")
_BINS = f"sequence_id long, used long, final boolean, items array<{_ITEM}>"
_ITEM_TYPE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64()),
                        ("ids", pa.list_(pa.int32()))])


class Words:
    """Token ids of a text from the ids of its words, as little-endian bytes.

    The tokenizer drops white space and never joins across it, so words are tokenised once and
    kept.  ASCII capitals are lowered and full stops and commas after a small letter split
    off beforehand, as the tokenizer does both itself; texts with its special tokens or with
    combining marks, where the order of the steps could matter, are only cut at white space.
    """

    _STOP = re.compile(rb"(?<=[a-z])([.,])(?=[\x20\x09-\x0D]|\Z)")

    def __init__(self, path: str, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.known = Tokenizer.from_file(path), limit, {}

    def cut(self, text: bytes) -> list[bytes]:
        if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
            return text.split()
        return self._STOP.sub(rb" \1", text.lower()).split()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        cut = [self.cut(t) for t in texts]
        new = list(set().union(*cut).difference(self.known))
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = list(set().union(*cut))
        found = self.tokenizer.encode_batch_fast([w.decode() for w in new],
                                                 add_special_tokens=False)
        self.known.update((w, array("I", e.ids).tobytes()) for w, e in zip(new, found))
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in cut]


def _words(path: str | None) -> Words:
    """The tokenizer and its known words, kept in the worker process from task to task."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    kept = vars(sys.modules.setdefault("tillpoint_kept", types.ModuleType("tillpoint_kept")))
    if path not in kept:
        kept[path] = Words(path)
    return kept[path]


def _pieces(batches: Iterator[pa.RecordBatch], path: str | None, capacity: int, end_id: int,
            with_ids: bool, group_bytes: int = 1 << 20) -> Iterator[tuple[int, list]]:
    """(length, [item]) of every piece of every document."""
    words, end = _words(path), array("I", [end_id]).tobytes()

    def encoded(group):
        for doc_id, ids in zip([d for d, _ in group], words.encode([t for _, t in group])):
            ids += end
            n = len(ids) // 4
            for piece, start in enumerate(range(0, n, capacity)):
                part = ids[4 * start:4 * (start + capacity)]
                own = array("i", part).tolist() if with_ids else None
                yield len(part) // 4, [(doc_id, piece, start, len(part) // 4, zlib.crc32(part), 0, own)]

    group, size = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            group.append((doc_id, text))
            size += len(text)
            if size >= group_bytes:
                yield from encoded(group)
                group, size = [], 0
    yield from encoded(group)


def best_fit(items: list[tuple[int, list]], capacity: int) -> list[tuple[int, list]]:
    """Best-fit by falling length: each item goes where it leaves the least room."""
    bins: list[list] = []
    room: dict[int, list[int]] = {}
    open_rooms = 0  # bit r is set while a bin has room r
    for size, members in sorted(items, key=lambda x: -x[0]):
        fits = open_rooms >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            k = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
        else:
            r, k = capacity, len(bins)
            bins.append([0, []])
        used = bins[k][0]
        bins[k][1] += [(*m[:5], m[5] + used, m[6]) for m in members] if used else members
        bins[k][0] = used + size
        if left := r - size:
            room.setdefault(left, []).append(k)
            open_rooms |= 1 << left
    return [(used, members) for used, members in bins]


def _bins(rows: list) -> pa.RecordBatch:
    keys = _ITEM_TYPE.names
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.bool_()),
         pa.array([[dict(zip(keys, m)) for m in r[3]] for r in rows], pa.list_(_ITEM_TYPE))],
        ["sequence_id", "used", "final", "items"])


def _pack(items: Iterator[tuple[int, list]], capacity: int, slack: int, level: int,
          chunk: int) -> Iterator[pa.RecordBatch]:
    """Pack a stream in chunks; what a chunk leaves underfull is packed with the next."""
    at = (level << 56) | (TaskContext.get().partitionId() << 36)
    held: list[tuple[int, list]] = []
    added, done = 0, False
    while not done:
        while added < chunk:
            item = next(items, None)
            if item is None:
                done = True
                break
            held.append(item)
            added += 1
        bins, held, added, rows = best_fit(held, capacity), [], 0, []
        for used, members in bins:
            full = capacity - used <= slack
            # what later chunks cannot help much is passed on rather than held
            if full or done or len(held) >= chunk:
                rows.append((at, used, full, members))
                at += 1
            else:
                held.append((used, members))
        for k in range(0, len(rows), 2000):
            yield _bins(rows[k:k + 2000])


def pack(docs: DataFrame, capacity: int = 4096, slack: int = 8, end_id: int = END_ID,
         tokenizer_path: str | None = None, with_ids: bool = False, chunk: int = 100_000,
         items_per_task: int = 20_000) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``with_ids`` adds the token ids.  ``slack``: free tokens of a sequence that counts as full.
    """
    def first(batches):
        return _pack(_pieces(batches, tokenizer_path, capacity, end_id, with_ids), capacity,
                     slack, 0, chunk)

    def again(level):
        def run(batches):
            def items():
                for batch in batches:
                    for used, members in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                        yield used, [tuple(m.values()) for m in members]

            return _pack(items(), capacity, slack, level, chunk)

        return run

    tables = [materialize(doc_text(docs).mapInArrow(first, _BINS), "pack-0")]
    left = tables[0].filter("not final")
    waiting = left.count()
    while waiting > 1:
        tasks = -(-waiting // items_per_task)
        merged = materialize(left.select("used", "items").repartition(tasks)
                             .mapInArrow(again(len(tables)), _BINS), f"pack-{len(tables)}")
        tables.append(merged)
        left = merged.filter("not final")
        before, waiting = waiting, left.count()
        if tasks == 1 or merged.count() > 0.99 * before:
            break
    result = left.select("sequence_id", "items")
    for t in tables:
        result = result.unionByName(t.filter("final").select("sequence_id", "items"))
    result = result.select("sequence_id", F.explode("items").alias("i")).select(
        "i.doc_id", "i.piece", "i.start", "i.length", "i.ids_crc32", "sequence_id", "i.offset",
        "i.ids")
    return result if with_ids else result.drop("ids")
