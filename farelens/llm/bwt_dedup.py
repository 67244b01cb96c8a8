"""Removal of repeated passages by column-wise Burrows-Wheeler construction.

Every byte covered by a 200-byte string that also starts elsewhere goes.
Inserting one symbol of every document per round into one global transform
would take as many passes over it as the longest document has bytes, so
equal strings are first brought together by content and the construction
runs on short pieces, all of them at once and one symbol per round:

1. Each text is cut into segments: maximal runs of window starts whose
   200-byte windows share one minimizer (the smallest hash of a 32-byte gram,
   the leftmost if equal).  The choice depends on the window alone, so equal
   windows lie in segments with the same anchor gram at the same offset.
2. Segments meet by anchor.  A segment that occurs twice as a whole is
   repeated in all its windows.  An anchor seen in one segment only has no
   repeated window.  The rest, different segments around one anchor, goes on.
3. Those segments are cut by the anchor's offset into blocks.  All windows of
   a block share its core, so equal windows lie in blocks with equal anchor,
   offset range and core; blocks that are alone in this are dropped.
4. The others' bytes are routed by that key, and their collection's
   Burrows-Wheeler transform and common prefix array are built column by
   column: round j inserts the j-th last symbol of every piece, updating
   both arrays in one sequential pass.  The core, which every window holds, is
   one symbol, the same for equal bytes only: a piece has at most 85 symbols
   instead of 242 bytes, a window 43 instead of 200, and a round costs one pass
   over all of them.  Neighbours with a common prefix of a window are repeated.
5. The windows' bytes are united per document and removed.

Segments that repeat inside one batch are combined before the shuffle, so a
passage shared by very many documents sends a few rows per task.  An anchor
with more than ``HOT`` different segments is not built in one task: its
blocks are single windows, counted by a 128-bit hash over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import materialize, may_have, spread

WINDOW = 200
GRAM = 32
# Bytes of a text looked at together; longer texts are taken in overlapping chunks.
CHUNK = 1 << 20
# Bytes of short texts looked at together: many at a call, in arrays that stay in the processor's cache.
PACK = 1 << 16
# Bytes of segments whose transform is built together.
BUILD = 1 << 17
HOT = 4096
# Anchor offsets of one block; its core is WINDOW - BLOCK + 1 bytes.
BLOCK = 43
CORE = WINDOW - BLOCK + 1

_POSITION_BITS = 24
_RNG = np.random.default_rng(2024)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = [np.uint64(x) for x in _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Gram hashes, and hashes of arbitrary ranges of one chunk."""

    def __init__(self):
        self.power = _powers(_BASE, CHUNK + WINDOW)
        self.inverse = _powers(_INVERSE, CHUNK + WINDOW)

    def grams(self, data: np.ndarray) -> np.ndarray:
        """Hash of the GRAM bytes at every position, by doubling."""
        h, size, level = _BYTE[data], 1, 0
        while size < GRAM:
            h = h[:-size] * _STEP[level] + h[size:]
            size, level = 2 * size, level + 1
        return _mix(h)

    def ranges(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of data[start:end], the same wherever the bytes stand."""
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * self.power[:len(data)], out=sums[1:])
        return _mix((sums[end] - sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def segments(data: np.ndarray, hasher: Hasher, ends=()) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, windows, offset, anchor, key) arrays, chunk by chunk.

    ``start`` is the first window's start, ``offset`` the anchor's distance
    from it, ``anchor`` the gram's hash, ``key`` the whole segment's.
    ``data`` may hold several texts that end at ``ends``; no window crosses one.
    """
    grams_per_window = WINDOW - GRAM + 1
    for at in range(0, max(0, len(data) - WINDOW + 1), CHUNK - WINDOW + 1):
        part = data[at:at + CHUNK]
        grams = hasher.grams(part)
        low = (grams >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while 2 * size <= grams_per_window:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        rest = grams_per_window - size
        if rest:
            low = np.minimum(low[:-rest], low[rest:])
        place = (low & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        within = np.ones(len(place), dtype=bool)
        for end in ends:
            within[max(0, end - at - WINDOW + 1):max(0, end - at)] = False
        starts = np.flatnonzero(within)
        if not len(starts):
            continue
        place = place[starts]                            # texts have different places
        begin = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        windows = np.diff(np.append(begin, len(place)))
        first, anchor = starts[begin], place[begin]
        keys = hasher.ranges(part, first, first + windows - 1 + WINDOW)
        yield first + at, windows, anchor - first, grams[anchor].view(np.int64), keys.view(np.int64)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a batch of texts (NULL: none) one after the other, and where each begins and the last ends."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    begin = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(data, dtype=np.uint8)[begin[0]:begin[-1]], begin - begin[0]


def listed(lists: pa.Array, *fields: str) -> tuple[np.ndarray, ...]:
    """Row numbers and fields of all structs in a column of lists (NULL: empty)."""
    structs = lists.flatten()
    return (pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64),
            *[pc.struct_field(structs, f).to_numpy(zero_copy_only=False).astype(np.int64) for f in fields])


_SEGMENT = "anchor long, key long, uid long, uid2 long, start long, windows int, offset int, n int"
_SEGMENT_ARROW = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("uid", pa.int64()), ("uid2", pa.int64()),
                            ("start", pa.int64()), ("windows", pa.int32()), ("offset", pa.int32()), ("n", pa.int32())])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a batch of texts.

    The first of equal segments carries their number in the batch as ``n``;
    the others have n = 0: they are known to be repeated and need not travel.
    """
    hasher = Hasher()
    for batch in batches:
        held: list[tuple] = []
        size = 0

        def flush():
            cols = [np.concatenate(c) for c in zip(*held)]
            order = np.lexsort((cols[1], cols[0]))
            new = np.append(True, (cols[0][order][1:] != cols[0][order][:-1]) | (cols[1][order][1:] != cols[1][order][:-1]))
            begin = np.flatnonzero(new)
            n = np.zeros(len(order), dtype=np.int64)
            n[order[begin]] = np.diff(np.append(begin, len(order)))
            return pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype()), f.type)
                                               for c, f in zip([*cols, n], _SEGMENT_ARROW)], schema=_SEGMENT_ARROW)

        data, begin = bytes_of(batch.column("text"))
        uid, uid2 = batch.column("uid").to_numpy(), batch.column("uid2").to_numpy()
        row = 0
        while row < len(uid):                            # a pack of texts, or a long one alone
            end = max(row + 1, int(np.searchsorted(begin, begin[row] + PACK, side="right")) - 1)
            ends = (begin[row + 1:end] - begin[row]).tolist()
            for start, windows, offset, anchor, key in segments(data[begin[row]:begin[end]], hasher, ends):
                start = start + begin[row]
                of = np.searchsorted(begin, start, side="right") - 1
                held.append((anchor, key, uid[of], uid2[of], start - begin[of], windows, offset))
                size += len(start)
            row = end
            if size > 200_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()


_FOUND = "anchor long, uid long, uid2 long, start long, windows int, offset int, n int, kind int"
_FOUND_ARROW = pa.schema([("anchor", pa.int64()), ("uid", pa.int64()), ("uid2", pa.int64()), ("start", pa.int64()),
                          ("windows", pa.int32()), ("offset", pa.int32()), ("n", pa.int32()), ("kind", pa.int32())])
# kind: repeated as a whole; contested; contested by so many that its windows are counted.
REPEATED, CONTESTED, COUNTED = 0, 1, 2


def _settle(anchor: np.ndarray, key: np.ndarray, n: np.ndarray, hot_kind: int, most: int) -> tuple[np.ndarray, ...]:
    """What ``_meet`` emits of whole anchors, as (row, n, kind) arrays."""
    begins = np.append(True, anchor[1:] != anchor[:-1])
    fresh = begins | np.append(True, key[1:] != key[:-1])
    first = np.flatnonzero(fresh)                        # one row per class: equal pieces of an anchor
    total = np.minimum(np.add.reduceat(n.astype(np.int64), first), 2)
    of = np.cumsum(begins)[first] - 1
    classes = np.bincount(of)
    single = np.zeros(len(classes), dtype=bool)
    single[of[total == 1]] = True
    hot = classes > most
    open_ = (hot | (single & (classes > 1)))[of]
    more, twice = np.flatnonzero(~fresh), total == 2
    return (np.concatenate([more, first[twice], first[open_]]),
            np.concatenate([n[more], total[twice], total[open_]]),
            np.concatenate([np.full(len(more) + int(np.count_nonzero(twice)), REPEATED),
                            np.where(hot[of[open_]], hot_kind, CONTESTED)]))


def _meet(hot_kind: int):
    """Streams of pieces sorted by anchor and key (the piece's content), each standing for ``n`` equal ones.

    Emits every repeated piece, and of anchors with different pieces, not all
    of them repeated, one of each.  Holds at most HOT rows: an anchor with
    more different pieces emits them as ``hot_kind`` while they pass.  Anchors
    that begin and end within a batch are settled all at once, those at its
    edges row by row.
    """
    names = ("anchor", "uid", "uid2", "start", "windows", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now = key = first = None      # the anchor, its current key, the key's first row
        total = 0                     # pieces of the current key
        classes: list[tuple] = []     # one row per finished key of the anchor
        single, hot = False, False

        def close_class():
            nonlocal single, hot
            if first is None:
                return
            if total >= 2:
                out.append((*first, total, REPEATED))
            else:
                single = True
            if hot:
                out.append((*first, min(total, 2), hot_kind))
                return
            classes.append((*first, min(total, 2)))
            if len(classes) > HOT:
                hot = True
                out.extend((*c, hot_kind) for c in classes)
                classes.clear()

        def close_anchor():
            nonlocal single, hot
            close_class()
            if not hot and single and len(classes) > 1:
                out.extend((*c, CONTESTED) for c in classes)
            classes.clear()
            single, hot = False, False

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND_ARROW)],
                                              schema=_FOUND_ARROW)

        for batch in batches:
            anchors = batch.column("anchor").to_numpy()
            edges = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
            begin, end = (int(edges[0]), int(edges[-1])) if len(edges) else (batch.num_rows, batch.num_rows)
            if begin < end:
                whole = batch.slice(begin, end - begin)
                take, n, kind = _settle(*[whole.column(c).to_numpy() for c in ("anchor", "key", "n")], hot_kind, HOT)
                if len(take):
                    cols = [whole.column(c).to_numpy()[take] for c in names]
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype()), f.type)
                                                      for c, f in zip([*cols, n, kind], _FOUND_ARROW)],
                                                     schema=_FOUND_ARROW)
            for part in (batch.slice(0, begin), batch.slice(end)):
                for r in zip(*[part.column(c).to_pylist() for c in ("key", "n", *names)]):
                    this, n, row = r[0], r[1], r[2:]
                    if row[0] != now:
                        close_anchor()
                        now, key, first, total = row[0], this, row, n
                    elif this != key:
                        close_class()
                        key, first, total = this, row, n
                    else:
                        out.append((*row, n, REPEATED))
                        total += n
            if len(out) >= 5000:
                yield flush()
                out = []
        close_anchor()
        if out:
            yield flush()

    return run


def construct(flat: np.ndarray, length: np.ndarray, window: int) -> np.ndarray:
    """Which positions of the pieces ``flat`` (symbols from 1) start ``window`` symbols that start elsewhere, too.

    Column-wise construction: ``bwt`` holds, in the order of the suffixes
    inserted so far, the symbol in front of each (0: none yet), ``lcp`` the
    common prefix with the suffix before.  Round j puts the j-th last symbol
    of each piece in front of its newest suffix and inserts the suffix that
    it begins.  Its rank follows from the stable order of ``bwt``; its common
    prefix is one more than the least ``lcp`` between the two tails.
    """
    m, kind, end = len(length), flat.dtype, np.cumsum(length)
    bwt, lcp = np.zeros(m, dtype=kind), np.zeros(m, dtype=np.int16)
    newest = np.arange(m)
    for j in range(1, int(length.max(initial=0)) + 1):
        active = np.flatnonzero(length >= j)
        bwt[newest[active]] = flat[end[active] - j]
        order = np.argsort(bwt, kind="stable")
        none = int(np.count_nonzero(bwt == 0))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        at = rank[newest[active]]                       # where the new suffixes stand in `order`
        new = m - none + at                             # their ranks among all suffixes
        old = np.ones(len(bwt) + len(active), dtype=bool)
        old[new] = False
        next_bwt, next_lcp = np.zeros(len(old), dtype=kind), np.zeros(len(old), dtype=np.int16)
        next_bwt[old], next_lcp[old] = bwt, lcp
        # New suffixes and those right after them get their common prefix anew.
        touched = np.unique(np.concatenate([at, at + 1]))
        touched = touched[touched < len(order)]
        before = touched[touched > none] - 1
        same = before[bwt[order[before]] == bwt[order[before + 1]]]
        next_lcp[m - none + touched] = 0
        if len(same):
            low, high = order[same] + 1, order[same + 1] + 1
            by_low = np.argsort(low, kind="stable")
            spans = np.stack([low[by_low], high[by_low]], axis=1).ravel()
            least = np.minimum.reduceat(np.append(lcp, np.int16(0)), spans)[::2]
            next_lcp[m - none + same[by_low] + 1] = least + 1
        bwt, lcp = next_bwt, next_lcp
        newest[active] = new
    # Ranks of all suffixes, from each piece's end to its beginning.
    order = np.argsort(bwt, kind="stable")
    none = int(np.count_nonzero(bwt == 0))
    step = np.empty(len(order), dtype=np.int64)
    step[order] = m - none + np.arange(len(order))
    shared = lcp >= window
    hit = shared | np.append(shared[1:], False)
    flags = np.zeros(len(flat), dtype=bool)
    at = np.arange(m)
    for j in range(1, int(length.max(initial=0)) + 1):
        active = np.flatnonzero(length >= j)
        at[active] = step[at[active]]
        flags[end[active] - j] = hit[at[active]]
    return flags


def repeated_windows(pieces: list[bytes]) -> list[np.ndarray]:
    """For each piece, which of its positions start a WINDOW-byte string that starts elsewhere in the collection."""
    length = np.array([len(p) for p in pieces], dtype=np.int64)
    flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    # Symbols numbered from 1 in byte order; one byte each unless all 256 occur.
    symbols = np.unique(flat)
    kind = np.uint8 if len(symbols) < 256 else np.uint16
    flags = construct((np.searchsorted(symbols, np.arange(256)) + 1).astype(kind)[flat], length, WINDOW)
    return np.split(flags, np.cumsum(length)[:-1])


def repeated_around(pieces: list[bytes], cores: list[int]) -> list[tuple[int, int, int]]:
    """(piece, first, number) of every run of positions that start a repeated WINDOW-byte string.

    ``cores`` says where in each piece the CORE bytes stand that all its
    windows hold.  They make one symbol, numbered by their bytes.
    """
    numbers: dict[bytes, int] = {}
    symbol = np.array([numbers.setdefault(p[c:c + CORE], 257 + len(numbers)) for p, c in zip(pieces, cores)], dtype=np.int64)
    before = np.array(cores, dtype=np.int64)
    length = np.array([len(p) for p in pieces], dtype=np.int64) - CORE + 1
    begin = np.cumsum(length) - length
    outer = np.frombuffer(b"".join([p[:c] + b" " + p[c + CORE:] for p, c in zip(pieces, cores)]), dtype=np.uint8)
    flat = outer.astype(np.min_scalar_type(256 + len(numbers))) + 1
    flat[begin + before] = symbol
    # A window's last symbols start none, so no run crosses the end of a piece.
    found = runs(construct(flat, length, WINDOW - CORE + 1))
    of = np.searchsorted(begin, [a for a, _ in found], side="right") - 1
    return [(int(i), int(a - begin[i]), n) for i, (a, n) in zip(of, found)]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, number) of every run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])]


def blocks_of(start: np.ndarray, windows: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, ...]:
    """(segment, block, first window's start, windows, core's start) of the segments' blocks of anchor offsets."""
    least = (offset - windows + 1) // BLOCK
    n = offset // BLOCK - least + 1
    of = np.repeat(np.arange(len(n)), n)
    block = least[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    anchor = (start + offset)[of]
    high = np.minimum(offset[of], block * BLOCK + BLOCK - 1)     # offsets fall as windows move right
    low = np.maximum((offset - windows + 1)[of], block * BLOCK)
    return of, block, anchor - high, high - low + 1, anchor - block * BLOCK


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of contested segments: keyed by anchor, offsets and core, with a hash of their whole content.

    ``offset`` is the core's distance from the block's start.
    """
    hasher = Hasher()
    for batch in batches:
        data, begin = bytes_of(batch.column("text"))
        uid, uid2 = batch.column("uid").to_numpy(), batch.column("uid2").to_numpy()
        text, anchor, n, start, windows, offset = listed(batch.column("wanted"), "anchor", "n", "start", "windows", "offset")
        of, block, start, windows, middle = blocks_of(begin[text] + start, windows, offset)
        order = np.argsort(start, kind="stable")
        of, block, start, windows, middle = (c[order] for c in (of, block, start, windows, middle))
        at = 0
        while at < len(start):                           # blocks that begin within PACK bytes at a time
            base, end = start[at], int(np.searchsorted(start, start[at] + PACK, side="right"))
            here = data[base:base + PACK + 2 * WINDOW]
            now = slice(at, end)
            first, core, which = start[now] - base, middle[now] - base, of[now]
            cores = hasher.ranges(here, core, core + CORE)
            whole = hasher.ranges(here, first, first + windows[now] - 1 + WINDOW)
            place = _mix((anchor[which].view(np.uint64) + block[now].astype(np.uint64) * _STEP[7]) ^ (cores * _STEP[6]))
            row = text[which]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype()), f.type) for c, f in zip(
                (place.view(np.int64), whole.view(np.int64), uid[row], uid2[row], start[now] - begin[row], windows[now],
                 core - first, n[which]), _SEGMENT_ARROW)], schema=_SEGMENT_ARROW)
            at = end


_BYTES = "anchor long, kind int, uid long, uid2 long, start long, core int, bytes binary, hash1 long, hash2 long"
_BYTES_ARROW = pa.schema([("anchor", pa.int64()), ("kind", pa.int32()), ("uid", pa.int64()), ("uid2", pa.int64()),
                          ("start", pa.int64()), ("core", pa.int32()), ("bytes", pa.binary()),
                          ("hash1", pa.int64()), ("hash2", pa.int64())])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the blocks to be built, hashes of every window of those to be counted."""
    from hashlib import blake2b

    def rows_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _BYTES_ARROW)], schema=_BYTES_ARROW)

    for batch in batches:
        out = []
        data, begin = bytes_of(batch.column("text"))
        uids, uid2s = batch.column("uid").to_pylist(), batch.column("uid2").to_pylist()
        text, *wanted = listed(batch.column("wanted"), "anchor", "kind", "n", "start", "windows", "offset")
        for i, at, anchor, kind, n, start, windows, core in zip(*[c.tolist() for c in (text, begin[text], *wanted)]):
            first, end, uid, uid2 = at + start, at + start + windows - 1 + WINDOW, uids[i], uid2s[i]
            if kind == CONTESTED:
                out.append((anchor, CONTESTED, uid, uid2, start, core, data[first:end].tobytes(), None, None))
            else:
                block = data[first:end].tobytes()
                for s in range(windows):
                    h = np.frombuffer(blake2b(block[s:s + WINDOW], digest_size=16).digest(), dtype=np.int64)
                    # A block that stands for several equal ones counts twice.
                    out += [(anchor, COUNTED, uid, uid2, start + s, None, None, int(h[0]), int(h[1]))] * n
            if len(out) >= 5000:
                yield rows_of(out)
                out = []
        if out:
            yield rows_of(out)


_SPAN = "uid long, uid2 long, start long, windows int"
_SPAN_ARROW = pa.schema([("uid", pa.int64()), ("uid2", pa.int64()), ("start", pa.int64()), ("windows", pa.int32())])


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream of blocks' bytes sorted by anchor: runs of repeated windows."""
    held, size, now = [], 0, None

    def solve():
        uid, uid2, start, core, pieces = zip(*held)
        rows = [(uid[i], uid2[i], start[i] + a, n) for i, a, n in repeated_around(pieces, core)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SPAN_ARROW)],
                                             schema=_SPAN_ARROW)

    for batch in batches:
        for r in zip(*[batch.column(c).to_pylist() for c in ("anchor", "uid", "uid2", "start", "core", "bytes")]):
            if r[0] != now and size >= BUILD:
                yield from solve()
                held, size = [], 0
            now = r[0]
            held.append(r[1:])
            size += len(r[5])
    if held:
        yield from solve()


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _remove(keep_text: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for batch in batches:
            if not batch.num_rows:
                continue
            data, begin = bytes_of(batch.column("text"))
            row, start, windows = listed(batch.column("spans"), "start", "windows")
            start = start + begin[row]
            order = np.argsort(start, kind="stable")
            row, start = row[order], start[order]
            reach = np.maximum.accumulate(start + windows[order] - 1 + WINDOW)
            # Spans that overlap or touch in one text are one.
            first = np.append(True, (start[1:] > reach[:-1]) | (row[1:] != row[:-1])) if len(row) else np.zeros(0, bool)
            last = np.append(first[1:], True) if len(row) else first
            row, start, end = row[first], start[first], reach[last]
            n_spans = np.bincount(row, minlength=batch.num_rows)
            upto = np.cumsum(n_spans)
            start, end, raw = start.tolist(), end.tolist(), memoryview(data)
            left, digests = [], []
            for at, stop, n, to in zip(begin[:-1].tolist(), begin[1:].tolist(), n_spans.tolist(), upto.tolist()):
                parts = []
                for i in range(to - n, to):
                    parts.append(raw[at:start[i]])
                    at = end[i]
                kept = b"".join([*parts, raw[at:stop]])
                digests.append(sha256(kept).hexdigest())
                left.append(kept if keep_text else len(kept))
            n_bytes = np.diff(begin)
            n_left = np.array([len(x) for x in left] if keep_text else left, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n_bytes, pa.int64()),
                                              pa.array(n_bytes - n_left, pa.int64()), pa.array(n_spans, pa.int64()),
                                              pa.array(digests, pa.string()),
                                              pa.array(left if keep_text else [None] * len(left), pa.binary())],
                                             schema=schema)

    return run


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes).

    ``docs`` has doc_id and text (NULL: empty).  Texts under 200 bytes have no
    window and stay.  Repeated rows are documents of their own, so a repeated
    text of 200 bytes or more goes in all of them.  Rows without an id are
    treated alike.  An empty table gives no rows.
    """
    # uid and uid2 name a row's id and text; rows alike in both have the same repeats.
    once = ["uid", "uid2"]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        F.coalesce("doc_id", F.lit(-1)).cast("long").alias("uid"),
                        F.xxhash64(F.isnull("doc_id"), "text").alias("uid2"))

    def meet(pieces: DataFrame, hot_kind: int) -> DataFrame:
        dealt = pieces.filter("n > 0").repartition("anchor").sortWithinPartitions("anchor", "key")
        return dealt.select("anchor", "key", "n", *once, "start", "windows", "offset").mapInArrow(_meet(hot_kind), _FOUND)

    def texts_of(pieces: DataFrame) -> DataFrame:
        """One row per text with its pieces that are not settled yet."""
        open_ = pieces.filter(F.col("kind") != REPEATED)
        wanted = open_.groupBy(*once).agg(
            F.collect_set(F.struct("anchor", "kind", "start", "windows", "offset", "n")).alias("wanted"))
        return (may_have(texts.select(*once, "text"), once, open_)
                .join(wanted.hint("merge"), once).dropDuplicates(once))

    cut = materialize(texts.select(*once, "text").mapInArrow(_cut, _SEGMENT), "bwt_segments")
    met = materialize(meet(cut, CONTESTED), "bwt_met")
    split = texts_of(met).select(*once, "text", "wanted").mapInArrow(_split, _SEGMENT)
    met_blocks = materialize(meet(split, COUNTED), "bwt_met_blocks")
    fetched = materialize(texts_of(met_blocks).select(*once, "text", "wanted").mapInArrow(_fetch, _BYTES), "bwt_bytes")
    built = (spread(fetched.filter(F.col("kind") == CONTESTED), "anchor").sortWithinPartitions("anchor")
             .select("anchor", *once, "start", "core", "bytes").mapInArrow(_build, _SPAN))
    windows = fetched.filter(F.col("kind") == COUNTED).select("hash1", "hash2", *once, "start")
    twice = windows.groupBy("hash1", "hash2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    counted = windows.join(twice, ["hash1", "hash2"]).select(*once, "start", F.lit(1).alias("windows"))
    spans = cut.filter("n = 0").select(*once, "start", "windows").unionByName(built).unionByName(counted)
    for pieces in (met, met_blocks):
        spans = spans.unionByName(pieces.filter(F.col("kind") == REPEATED).select(*once, "start", "windows"))
    spans = materialize(spans.groupBy(*once).agg(F.collect_set(F.struct("start", "windows")).alias("spans")), "bwt_spans")

    # Texts without a span need not meet any.
    touched = may_have(texts, once, spans).join(spans.hint("merge"), once, "left").select("doc_id", "text", "spans")
    free = may_have(texts, once, spans, absent=True).select("doc_id", "text", F.lit(None).cast(
        "array<struct<start: bigint, windows: int>>").alias("spans"))
    return touched.unionByName(free).mapInArrow(_remove(keep_text), _OUT.replace("kept string", "kept binary"))
