"""MinHash near-duplicates with min-max hashing.

Every permutation of the shingles gives two signature values, its minimum
and its maximum, so 64 hash evaluations give 128 values: the share of equal
values is an unbiased estimate of the Jaccard similarity with less variance
than 128 independent minima.  Bands of four values from four different
permutations name the buckets in which documents meet.

1. One pass over the texts: set size, a 128-bit key of the word sequence,
   band hashes and an 8-bit sketch of the signature.  Documents with one key
   form a class; only its smallest id goes on.
2. Buckets with two classes or more are read as streams of sketches.  Members
   whose estimate may reach the limit are gathered into loose clusters as
   they come, and only the links that join clusters are emitted: at most one
   a member, never all pairs of a bucket.  Components of these links are the
   loose groups; a pair that shares a band and may be similar lies in one.
3. The texts of a loose group meet in cells of bounded size and are compared
   on their full shingle sets.  Only links that join something new are
   emitted again.
4. Components of these links, carried over to the classes.

Large buckets and large groups are divided into blocks; every two blocks meet
in a cell, so no task holds more than two.

A pair of similarity 0.75 shares no band with probability 5e-6 (32 bands of
4), a more similar one with less.  Pairs whose estimate is below 0.6, four
standard deviations under 0.75, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import few_files, materialize, may_have, spread
from farelens.llm.components import connected_components

SHINGLE = 5
PERCENT = 75            # 100 * intersection >= PERCENT * union
PERMUTATIONS = 64
BAND = 4
BANDS = 2 * PERMUTATIONS // BAND
WORD_CACHE = 50_000     # words whose hashes a task keeps, some ten MB
BLOCK = 4_096           # members of a large bucket that stay together
# Members of a loose group that stay together, and their shingles (eight bytes each).
GROUP_BLOCK, GROUP_SHINGLES = 2_048, 4_000_000
MAYBE = 0.6             # estimate from which a pair may be similar

_M1, _M2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class Shingler:
    """Distinct 64-bit shingle hashes of a text's ASCII-lowered words."""

    def __init__(self):
        self.cache: dict[bytes, int] = {}

    def words(self, text: str | None) -> list[bytes]:
        # bytes.lower and bytes.split know ASCII letters and white space only, as asked.
        return text.encode("utf-8", "surrogatepass").lower().split() if text else []

    def shingles(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, dtype=np.uint64)
        import xxhash

        cache = self.cache
        if len(cache) > WORD_CACHE:
            cache.clear()
        for w in set(words):
            if w not in cache:
                cache[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter([cache[w] for w in words], dtype=np.uint64, count=len(words))
        size = min(SHINGLE, len(words))
        out = np.full(len(words) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            out = (out ^ h[i:i + len(out)]) * np.uint64(_M1)
            out ^= out >> np.uint64(31)
        out *= np.uint64(_M2)
        out ^= out >> np.uint64(29)
        return np.unique(out)


def coefficients(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
    return a, b


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima, then maxima, under the permutations x -> a x + b (mod 2^64)."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        values = shingles[at:at + 1024, None] * a + b
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    return np.concatenate([low, high])


def band_hashes(sig: np.ndarray) -> np.ndarray:
    """One hash per band; value i of band k comes from permutation (k + 8 i) mod 64, so all four differ."""
    k = np.arange(BANDS)[:, None]
    i = np.arange(BAND)[None, :]
    # Bands 0..15 and 16..31 take the minima and maxima of alternate slots.
    perm = (k % 16) + 16 * i
    kind = (i + k // 16) % 2
    values = sig[perm + PERMUTATIONS * kind]
    out = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for col in range(BAND):
        out = (out ^ values[:, col]) * np.uint64(_M1)
        out ^= out >> np.uint64(32)
    return (out * np.uint64(_M2)).view(np.int64)


def sketch(sig: np.ndarray) -> bytes:
    return ((sig * np.uint64(_M2)) >> np.uint64(56)).astype(np.uint8).tobytes()


_SIGNED = "doc_id long, key_hi long, key_lo long, n_shingles long, bands array<long>, sketch binary"
_SIGNED_ARROW = pa.schema([("doc_id", pa.int64()), ("key_hi", pa.int64()), ("key_lo", pa.int64()),
                           ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    shingler, (a, b) = Shingler(), coefficients()
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            words = shingler.words(text.as_py())
            shingles = shingler.shingles(words)
            key = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), dtype=np.int64)
            if len(shingles):
                sig = signature(shingles, a, b)
                rows.append((doc, key[0], key[1], len(shingles), band_hashes(sig), sketch(sig)))
            else:
                rows.append((doc, key[0], key[1], 0, None, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SIGNED_ARROW)]
                                         if rows else [pa.array([], f.type) for f in _SIGNED_ARROW],
                                         schema=_SIGNED_ARROW)


class Members:
    """Rows of one cell so far: sketches, sizes, and the cluster of each."""

    def __init__(self):
        self.n = 0
        self.ids = np.zeros(16, dtype=np.int64)
        self.sizes = np.zeros(16, dtype=np.int64)
        self.clusters = np.zeros(16, dtype=np.int64)
        self.table = np.zeros((16, 2 * PERMUTATIONS), dtype=np.uint8)

    def append(self, doc: int, size: int, mine: np.ndarray) -> int:
        at = self.n
        if at == len(self.ids):
            for name in ("ids", "sizes", "clusters", "table"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        self.ids[at], self.sizes[at], self.clusters[at], self.table[at] = doc, size, at, mine
        self.n += 1
        return at

    def near(self, at: int) -> np.ndarray:
        """Earlier rows that may be similar to row ``at``, most likely ones first."""
        size = self.sizes[at]
        sizes = self.sizes[:at]
        rows = np.flatnonzero((100 * np.minimum(sizes, size) >= PERCENT * np.maximum(sizes, size))
                              & (self.ids[:at] != self.ids[at]))
        estimate = (self.table[rows] == self.table[at]).mean(axis=1) if len(rows) else np.zeros(0)
        rows, estimate = rows[estimate >= MAYBE], estimate[estimate >= MAYBE]
        return rows[np.argsort(-estimate, kind="stable")]

    def join(self, i: int, at: int) -> tuple[int, int]:
        """Joins the clusters of two rows; returns the link."""
        clusters = self.clusters[:self.n]
        clusters[clusters == clusters[i]] = clusters[at]
        return int(min(self.ids[i], self.ids[at])), int(max(self.ids[i], self.ids[at]))


_LINKS = "a long, b long"
_LINKS_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _link_batch(links: set[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*sorted(links))], schema=_LINKS_ARROW)


def _loose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream of (bucket, cell, doc_id, n_shingles, sketch), sorted: links that join clusters by estimate."""
    now, cell, links = None, None, set()
    for batch in batches:
        for r in zip(*[batch.column(c).to_pylist() for c in ("bucket", "cell", "doc_id", "n_shingles", "sketch")]):
            if r[:2] != now:
                now, cell = r[:2], Members()
            at = cell.append(r[2], r[3], np.frombuffer(r[4], dtype=np.uint8))
            for i in cell.near(at):
                if cell.clusters[i] != cell.clusters[at]:
                    links.add(cell.join(i, at))
            if len(links) >= 20_000:
                yield _link_batch(links)
                links = set()
    if links:
        yield _link_batch(links)


def similar(mine: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the shingle sets are similar enough to ``mine``."""
    flat = np.concatenate(others)
    at = np.searchsorted(mine, flat)
    hit = mine[np.minimum(at, len(mine) - 1)] == flat
    sizes = np.array([len(o) for o in others])
    common = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * common >= PERCENT * (len(mine) + sizes - common)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream of (group, cell, block, own, doc_id, text), sorted: links on full sets that join something new.

    In a cell of two blocks only rows of different blocks are compared; each
    block has a cell of its own.
    """
    shingler, (a, b) = Shingler(), coefficients()
    now, cell, sets, blocks, links = None, None, [], [], set()
    for batch in batches:
        for group, number, block, own, doc, text in zip(*[batch.column(c).to_pylist() for c in (
                "group", "cell", "block", "own", "doc_id")], batch.column("text")):
            if (group, number) != now:
                now, cell, sets, blocks = (group, number), Members(), [], []
            mine = shingler.shingles(shingler.words(text.as_py()))
            if not len(mine):
                continue
            at = cell.append(doc, len(mine), np.frombuffer(sketch(signature(mine, a, b)), dtype=np.uint8))
            sets.append(mine)
            blocks.append(block)
            near = cell.near(at)
            if not own:
                near = near[np.array(blocks)[near] != block]
            # The most likely row of every cluster first, then what is left of the clusters not reached.
            while len(near := near[cell.clusters[near] != cell.clusters[at]]):
                _, first = np.unique(cell.clusters[near], return_index=True)
                tried = near[first]
                reached = tried[similar(mine, [sets[i] for i in tried])]
                for i in reached:
                    links.add(cell.join(i, at))
                near = np.delete(near, first)
            if len(links) >= 20_000:
                yield _link_batch(links)
                links = set()
    if links:
        yield _link_batch(links)


def signatures(docs: DataFrame) -> DataFrame:
    """One row per document: set size, word sequence key, band hashes, sketch."""
    return materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sign, _SIGNED),
                       "minmax_signatures")


def _cells(df: DataFrame, blocks: Column, block: Column, own_cells: bool) -> DataFrame:
    """Rows dealt to cells of two blocks (or one, if there is but one); ``own_cells``: also to their block's own."""
    df = df.withColumns({"blocks": blocks.cast("int"), "block": F.pmod(block, blocks).cast("int")})
    other = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1),
                     lambda o: F.lit(own_cells) | (o != F.col("block")) | (F.col("blocks") == 1))
    return (df.withColumn("other", F.explode(other))
            .withColumns({"cell": F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"),
                          "own": F.col("block") == F.col("other")})
            .drop("blocks", "other"))


def loose_links(reps: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, of representatives that may be similar, enough to hold their groups together."""
    met = reps.select("doc_id", F.explode("bands").alias("bucket"))
    crowded = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    dealt = _cells(met.join(crowded, "bucket"), F.ceil(F.col("members") / BLOCK), F.xxhash64("doc_id"), False)
    order = ["bucket", "cell", "doc_id"]
    rows = dealt.select(*order).join(reps.select("doc_id", "n_shingles", "sketch"), "doc_id")
    return (spread(rows, "bucket", "cell").sortWithinPartitions(*order)
            .select(*order, "n_shingles", "sketch").mapInArrow(_loose, _LINKS).distinct())


def confirmed_links(docs: DataFrame, reps: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b) similar on their full sets, enough to hold the components of each loose group together."""
    members = reps.select("doc_id", "n_shingles").join(groups, reps["doc_id"] == groups["node"]).select(
        "doc_id", "n_shingles", F.col("component").alias("group"))
    size = members.groupBy("group").agg(F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK),
                                                   F.ceil(F.sum("n_shingles") / GROUP_SHINGLES)).alias("wanted"))
    dealt = _cells(members.join(size, "group"), F.col("wanted"), F.xxhash64("doc_id"), True)
    dealt = dealt.select("doc_id", "group", "cell", "block", "own").distinct()
    # Texts outside all groups are left out before the shuffle, as far as the filter can tell.
    texts = may_have(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"], members)
    return (spread(texts.join(dealt.hint("merge"), "doc_id"), "group", "cell")
            .sortWithinPartitions("group", "cell", "block", "doc_id")
            .select("group", "cell", "block", "own", "doc_id", "text").mapInArrow(_confirm, _LINKS).distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``docs`` has doc_id and text.  A NULL, empty or white-space text has no
    shingles and links with nothing.  Rows sharing a doc_id are one node of
    the graph (their links are pooled).  A row without an id cannot be linked:
    component_id is NULL and it is kept.  An empty table gives no rows.
    """
    signed = signatures(docs)
    rows = signed.count()   # what follows has narrow rows, about as many
    wordy = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = wordy.groupBy("key_hi", "key_lo").agg(F.min("doc_id").alias("rep"))
    classes = materialize(few_files(classes, rows), "minmax_classes")
    reps = (wordy.join(classes, (wordy["key_hi"] == classes["key_hi"]) & (wordy["key_lo"] == classes["key_lo"])
                       & (wordy["doc_id"] == classes["rep"]))
            .select("doc_id", "n_shingles", "bands", "sketch").dropDuplicates(["doc_id", "sketch"]))
    reps = materialize(few_files(reps, rows), "minmax_reps")
    # Rows that share an id join the classes they belong to.
    of_class = wordy.select("doc_id", "key_hi", "key_lo").join(classes, ["key_hi", "key_lo"])
    shared = of_class.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a <> b")
    ties = of_class.join(shared.select("doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    loose = materialize(few_files(loose_links(reps), rows), "minmax_loose")
    groups = connected_components(loose)
    confirmed = materialize(few_files(confirmed_links(docs, reps, groups).unionByName(ties), rows), "minmax_confirmed")
    labels = connected_components(confirmed)
    named = classes.join(labels, classes["rep"] == labels["node"], "left").select(
        "key_hi", "key_lo", F.coalesce("component", "rep").alias("component"))
    known = signed["doc_id"].isNotNull() & (signed["n_shingles"] > 0)
    out = signed.select("doc_id", "n_shingles", F.when(known, F.col("key_hi")).alias("key_hi"),
                        F.when(known, F.col("key_lo")).alias("key_lo")).join(named, ["key_hi", "key_lo"], "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, the one with the smallest id.

    A text without words is a near duplicate of none and stays.  Where rows
    share an id or have none, rows are told apart by a number of their own:
    different texts all stay, whatever their ids, and of equal or similar
    ones any one row does.  An empty table gives no rows; a very long text
    is held by its shingles.
    """
    unsound = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__rows")).filter("doc_id is null or __rows > 1")
    if not unsound.limit(1).count():
        keep = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("__keep_id"))
        return docs.join(keep, docs["doc_id"] == keep["__keep_id"], "left_semi")
    numbered = materialize(docs.withColumn("__row_id", F.monotonically_increasing_id()), "minmax_numbered")
    keep = near_duplicates(numbered.select(F.col("__row_id").alias("doc_id"), "text")).filter("kept").select(
        F.col("doc_id").alias("__keep_id"))
    return numbered.join(keep, numbered["__row_id"] == keep["__keep_id"], "left_semi").drop("__row_id")
