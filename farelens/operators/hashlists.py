"""Which hashes occur twice, found from sorted hash lists of a few bits a row.

Every task sorts the hashes of its rows, names those it has twice itself and
ships the rest, cut by their leading bits, as Elias-Fano lists: the low bits
as they are, the high bits as a bit string of gaps.  With 64 times as many
hash values as rows that is about 9 bits a row and a few more for many
tasks, where a row of key and count takes 16 bytes and up.  The receiving
tasks merge the lists of one cut and name the hashes in two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows whose hashes a task sorts together (8 bytes each).
TOGETHER = 1 << 21
# Hash values per row: the part of sound rows that is looked at twice is one in so many.
SPARSE = 64
_LIST = "cut int, hash long, n int, bits binary"


def encode(values: np.ndarray, space: int) -> bytes:
    """Sorted distinct numbers below ``space`` as an Elias-Fano list."""
    low = max(0, (space // len(values)).bit_length() - 1)
    high = np.zeros(len(values) + (space >> low) + 1, dtype=bool)
    high[(values >> low) + np.arange(len(values))] = True
    lows = (values[:, None] >> np.arange(low)) & 1
    return np.packbits(high).tobytes() + np.packbits(lows.astype(bool)).tobytes()


def decode(bits: bytes, n: int, space: int) -> np.ndarray:
    low = max(0, (space // n).bit_length() - 1)
    size = -(-(n + (space >> low) + 1) // 8)
    raw = np.frombuffer(bits, dtype=np.uint8)
    values = (np.flatnonzero(np.unpackbits(raw[:size]))[:n] - np.arange(n)) << low
    lows = np.unpackbits(raw[size:], count=n * low).reshape(n, low).astype(np.int64)
    return values + lows @ (np.int64(1) << np.arange(low, dtype=np.int64))


def _ship(cuts: int, space: int):
    """Lists of a task's hashes, ``space`` values a cut; a hash it has twice is a row of its own."""
    def listed(hashes: np.ndarray) -> pa.RecordBatch:
        values, times = np.unique(hashes, return_counts=True)
        twice = values[times > 1]
        cols: dict[str, list] = {"cut": (twice // space).tolist(), "hash": twice.tolist(),
                                 "n": [None] * len(twice), "bits": [None] * len(twice)}
        edges = np.searchsorted(values, np.arange(cuts + 1) * space)
        for cut in np.flatnonzero(np.diff(edges)):
            own = values[edges[cut]:edges[cut + 1]] - cut * space
            for name, value in zip(cols, (int(cut), None, len(own), encode(own, space))):
                cols[name].append(value)
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols.values(), kinds)], names=list(cols))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            size += len(held[-1])
            if size >= TOGETHER:
                yield listed(np.concatenate(held))
                held, size = [], 0
        if size:
            yield listed(np.concatenate(held))

    return run


def _merge(space: int):
    """Hashes named already, and those in two lists of a cut; rows come sorted by cut."""
    def twice(cut: int, lists: list[np.ndarray], named: list[int]) -> pa.RecordBatch:
        values = np.sort(np.concatenate(lists)) + cut * space if lists else np.empty(0, np.int64)
        found = np.union1d(values[1:][values[1:] == values[:-1]], np.array(named, dtype=np.int64))
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lists, named = None, [], []
        for batch in batches:
            for cut, h, n, bits in zip(*(batch.column(c).to_pylist() for c in ("cut", "hash", "n", "bits"))):
                if cut != at:
                    if at is not None:
                        yield twice(at, lists, named)
                    at, lists, named = cut, [], []
                if bits is None:
                    named.append(h)
                else:
                    lists.append(decode(bits, n, space))
        if at is not None:
            yield twice(at, lists, named)

    return run


def space_for(rows: int, cuts: int) -> int:
    """Hash values of one cut."""
    return max(1, -(-rows * SPARSE // cuts))


def repeated_hashes(hashes: DataFrame, cuts: int, space: int) -> DataFrame:
    """(hash): every value that two rows of ``hashes`` hold; one column of longs below ``cuts * space``.

    A task holds ``TOGETHER`` hashes, then the hashes of one cut.  Tens of
    millions of copies of one value are one row from each task's run.
    """
    shipped = hashes.mapInArrow(_ship(cuts, space), _LIST)
    dealt = shipped.repartition(cuts, "cut").sortWithinPartitions("cut")
    return dealt.select("cut", "hash", "n", "bits").mapInArrow(_merge(space), "hash long")


def hash_of(keys: list[str], cuts: int, space: int):
    return F.pmod(F.xxhash64(*keys), F.lit(cuts * space)).alias("hash")
