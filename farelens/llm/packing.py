"""Packing token sequences: bounded-space online best fit, then merging leftovers.

Each task reads its documents once, turns them into token ids and keeps
``OPEN`` windows open.  Full windows are cut off a document directly; what is
left of it goes whole into the open window it fits best.  When it fits none,
the fullest window is filled up with a cut of it and emitted, so no emitted
window needs padding.  At the end of a task the open windows are poured
together until at most one partly filled window is left.

Those leftovers (less than one window a task) are merged in rounds over ever
fewer tasks; the last one is cut into power-of-two sequences, which need no
padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import materialize
from farelens.llm.tokens import ByteBpe, merges_by_rank

WINDOW = 1024
OPEN = 16
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
# Leftover windows merged by one task of a merge round.
FAN_IN = 256

_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "task long, sequence long, offset long, ids binary")


class Packer:
    """Open windows of one task; ``done`` collects the pieces of emitted windows."""

    def __init__(self, window: int, n_open: int):
        self.window, self.n_open = window, n_open
        self.open: list[list] = []   # [fill, pieces], sorted by fill
        self.done: list[list] = []

    def add(self, pieces: list[tuple]) -> None:
        """``pieces`` (doc, start, ids) is one document's ids or a leftover window's."""
        for doc, start, doc_tokens, ids in pieces:
            at = 0
            while len(ids) // 4 - at >= self.window:
                self.done.append([(doc, start + at, doc_tokens, ids[4 * at:4 * (at + self.window)])])
                at += self.window
            if 4 * at < len(ids):
                self._place(doc, start + at, doc_tokens, ids[4 * at:])

    def _place(self, doc, start, doc_tokens, ids) -> None:
        n = len(ids) // 4
        fits = [i for i, w in enumerate(self.open) if w[0] + n <= self.window]
        if fits:                                     # best fit: the fullest that still takes it
            w = self.open.pop(fits[-1])
        elif len(self.open) < self.n_open:
            w = [0, []]
        else:                                        # fill up the fullest and emit it
            w = self.open.pop()
            room = self.window - w[0]
            w[1].append((doc, start, doc_tokens, ids[:4 * room]))
            self.done.append(w[1])
            start, ids, n = start + room, ids[4 * room:], n - room
            w = [0, []]
        w[0] += n
        w[1].append((doc, start, doc_tokens, ids))
        if w[0] == self.window:
            self.done.append(w[1])
        else:
            self.open.insert(bisect_left([x[0] for x in self.open], w[0]), w)

    def pour(self) -> list[tuple]:
        """Pours the open windows together; returns the pieces of the one that stays partly filled."""
        flow = [p for w in self.open for p in w[1]]
        self.open, held, fill = [], [], 0
        for doc, start, doc_tokens, ids in flow:
            while ids:
                room = 4 * (self.window - fill)
                held.append((doc, start, doc_tokens, ids[:room]))
                took = len(ids[:room]) // 4
                start, ids, fill = start + took, ids[room:], fill + took
                if fill == self.window:
                    self.done.append(held)
                    held, fill = [], 0
        return held


def _rows(sequences: list[list[tuple]], task: int, first: int, keep_ids: bool) -> pa.RecordBatch:
    cols: dict[str, list] = {k.split()[0]: [] for k in _SCHEMA.split(", ")}
    for number, pieces in enumerate(sequences, first):
        offset = 0
        for doc, start, doc_tokens, ids in pieces:
            n = len(ids) // 4
            for name, value in zip(cols, (doc, start, n, zlib.crc32(ids), doc_tokens, task, number, offset,
                                          ids if keep_ids else None)):
                cols[name].append(value)
            offset += n
    kinds = {"ids": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in cols.items()], names=list(cols))


def _pack(feed: Iterator[list[tuple]], task: int, window: int, n_open: int, last: bool) -> Iterator[pa.RecordBatch]:
    packer, number = Packer(window, n_open), 0
    for pieces in feed:
        packer.add(pieces)
        if len(packer.done) >= 2000:
            yield _rows(packer.done, task, number, False)
            number += len(packer.done)
            packer.done = []
    held = packer.pour()
    if last:                                         # power-of-two sequences need no padding
        left = sum(len(p[3]) // 4 for p in held)
        for bit in range(left.bit_length() - 1, -1, -1):
            if left >> bit & 1:
                room, own = 4 << bit, []
                while room:
                    doc, start, doc_tokens, ids = held.pop(0)
                    own.append((doc, start, doc_tokens, ids[:room]))
                    if len(ids) > room:
                        held.insert(0, (doc, start + room // 4, doc_tokens, ids[room:]))
                    room -= len(own[-1][3])
                packer.done.append(own)
        held = []
    yield _rows(packer.done, task, number, False)
    if held:
        yield _rows([held], task, -1, True)


def _pack_documents(path: str, ranked: bool, window: int, n_open: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end = ByteBpe(path, ranked, added=True), np.array([end_id], dtype="<u4").tobytes()

        def feed():
            for batch in batches:
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    ids = encoder.encode(text.as_py() or "") + end
                    yield [(doc, 0, len(ids) // 4, ids)]

        yield from _pack(feed(), TaskContext.get().partitionId(), window, n_open, False)

    return run


def _merge_leftovers(round_no: int, window: int, n_open: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def feed():
            for batch in batches:
                for row in batch.to_pylist():
                    yield [(row["doc_id"], row["start"], row["doc_tokens"], row["ids"])]

        first, rest = None, feed()
        for first in rest:
            break
        if first is None:
            return
        from itertools import chain

        from pyspark import TaskContext

        # Merge tasks are numbered below zero, apart from the reading tasks.
        task = -(round_no * (1 << 20) + TaskContext.get().partitionId() + 1)
        yield from _pack(chain([first], rest), task, window, n_open, last)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, n_open: int = OPEN,
                   end_id: int = END_ID, fan_in: int = FAN_IN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``docs`` has doc_id and text (NULL: empty; it still has its end id).
    Ids are those of ``Tokenizer.encode`` without special tokens around them;
    an added token written out in a text gets its own id.  Repeated rows are
    packed one by one.  Every sequence is either full or has a power of two
    of ids, so nothing is padded.  An empty table gives no rows.  No shuffle
    of documents; a task holds ``n_open`` windows and the ids of one document,
    however long.
    """
    pieces = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                         .mapInArrow(_pack_documents(tokenizer_path, merges_by_rank(tokenizer_path), window, n_open, end_id), _SCHEMA), "pack_pieces")
    parts, left, round_no = [pieces.filter("sequence >= 0")], pieces.filter("sequence < 0"), 0
    tasks = pieces.select(F.max("task")).first()[0]
    tasks = 0 if tasks is None else tasks + 1
    while tasks:
        round_no += 1
        last = tasks <= fan_in
        tasks = 1 if last else -(-tasks // fan_in)
        # Rows of one leftover window stay together and in order.
        spread = left.repartition(tasks, "task").sortWithinPartitions("task", "offset")
        merged = materialize(spread.mapInArrow(_merge_leftovers(round_no, window, n_open, last), _SCHEMA), "pack_merge")
        parts.append(merged.filter("sequence >= 0"))
        left = merged.filter("sequence < 0")
        if last:
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    sequence_id = F.col("task") * F.lit(1 << 32) + F.col("sequence")
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                      sequence_id.alias("sequence_id"), "offset")
