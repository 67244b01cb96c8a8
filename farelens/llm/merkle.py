"""Document fingerprints: Merkle trees over sentences, paragraphs and sections.

Leaves are sentences, in pieces of at most ``LEAF`` characters, grouped into paragraphs
(lines) and sections (runs of paragraphs; a blank line ends one, and so does
a paragraph whose hash says so, which lets sections fall into step again
after an edit).  The fingerprint is the root: equal texts have equal roots.
Unequal trees are compared from the root down: equal branches are passed
over, the first differing branch on every level leads to the edit.

Likeness of two trees is the share of code points under common leaves:
twice the common ones over the sum of both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 24
# Range buckets of the neighbour order for each shuffle partition; the
# driver holds one boundary and one id per bucket; ids that many rows share
# add at most twice as many.
BUCKETS_PER_PARTITION = 4
MAX_BUCKETS = 16_384

_PIECE = "[^.!?\n]{1,%d}[.!?]*\n?|[.!?\n]+" % LEAF


class Tree:
    """Levels of one text's tree; ``first`` lists hold each node's first leaf."""

    __slots__ = ("root", "leaves", "sizes", "paragraphs", "paragraph_first", "sections", "section_first", "n_chars")

    def __init__(self, text: str):
        import re
        from hashlib import blake2b

        pieces = re.findall(_PIECE, text)
        self.n_chars = len(text)
        self.sizes = [len(p) for p in pieces]
        self.leaves = [blake2b(p.encode("utf-8", "surrogatepass"), digest_size=12, person=b"leaf").digest()
                       for p in pieces]
        self.paragraphs, self.paragraph_first, begin = [], [], 0
        self.sections, self.section_first, section = [], [], 0
        last = len(pieces) - 1
        for i, piece in enumerate(pieces):
            if piece[-1] != "\n" and i != last:
                continue
            node = blake2b(b"".join(self.leaves[begin:i + 1]), digest_size=12, person=b"paragraph").digest()
            self.paragraphs.append(node)
            self.paragraph_first.append(begin)
            begin = i + 1
            if i == last or piece.strip() == "" or node[0] < 32:
                self.sections.append(blake2b(b"".join(self.paragraphs[section:]), digest_size=12,
                                             person=b"section").digest())
                self.section_first.append(self.paragraph_first[section])
                section = len(self.paragraphs)
        self.root = blake2b(b"".join(self.sections), digest_size=20, person=b"root").hexdigest()


def likeness(a: Tree, b: Tree) -> float:
    """0 (no common leaf) to 1 (equal); two empty texts are equal."""
    if a.root == b.root:
        return 1.0
    if not a.n_chars or not b.n_chars:
        return 0.0
    counts: dict[bytes, int] = {}
    for leaf in a.leaves:
        counts[leaf] = counts.get(leaf, 0) + 1
    common = 0
    for leaf, size in zip(b.leaves, b.sizes):
        if counts.get(leaf, 0):
            counts[leaf] -= 1
            common += size
    return 2.0 * common / (a.n_chars + b.n_chars)


def first_difference(a: Tree, b: Tree) -> int | None:
    """Code point where ``a``'s first differing leaf begins (its length if it is a prefix), None if equal."""
    from bisect import bisect_left

    if a.root == b.root:
        return None
    leaf = 0
    for nodes_a, first_a, nodes_b, first_b in (
            (a.sections, a.section_first, b.sections, b.section_first),
            (a.paragraphs, a.paragraph_first, b.paragraphs, b.paragraph_first)):
        i, j = bisect_left(first_a, leaf), bisect_left(first_b, leaf)
        while i < len(nodes_a) and j < len(nodes_b) and nodes_a[i] == nodes_b[j]:
            i, j = i + 1, j + 1
        leaf = first_a[i] if i < len(first_a) else len(a.leaves)
    while leaf < len(a.leaves) and leaf < len(b.leaves) and a.leaves[leaf] == b.leaves[leaf]:
        leaf += 1
    return sum(a.sizes[:leaf])


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, edit_start long")
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64()), ("edit_start", pa.int64())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in bucket order, each bucket closed by the first row of the next one (``after`` = 1)."""
    from hashlib import sha256

    rows: list[tuple] = []
    held = None  # (doc_id, text, tree) of the row whose successor is awaited

    def row(current, following):
        doc, text, tree = current
        n = len(text)
        k = n // 3
        edited = text[:n - k] + following[1][:k]
        other = Tree(edited)
        return (doc, n, sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), tree.root, other.root,
                likeness(tree, other), likeness(tree, following[2]), first_difference(tree, other))

    def flush():
        cols = zip(*rows) if rows else [[] for _ in _OUT_ARROW]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT_ARROW)], schema=_OUT_ARROW)

    for batch in batches:
        for doc, text, after in zip(batch.column("doc_id").to_pylist(), batch.column("text"),
                                    batch.column("after").to_pylist()):
            text = text.as_py() or ""
            now = (doc, text, Tree(text))
            if held is not None:
                rows.append(row(held, now))
                if len(rows) >= 2000:
                    yield flush()
                    rows = []
            held = None if after else now
    yield flush()


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness.

    ``docs`` has doc_id and text (NULL: empty).  The next document follows in
    descending doc_id, rows without an id last, equal ids by a hash of the
    text and then by text; after the last comes the first.  The edited text's
    last third is replaced by the next document's beginning.  An empty table
    gives no rows; a single document follows itself.  A text is held whole,
    with three trees of it, whatever its length.

    One shuffle of the texts into range buckets of the order; the first row
    of each bucket is sent along to the bucket before.  An id that many rows
    share, or none, takes as many buckets as its rows ask for, by the text's
    hash.  Tasks read their rows as a stream, whatever the bucket's size.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("mark", F.xxhash64(F.isnull("text"), "text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = min(MAX_BUCKETS, partitions * BUCKETS_PER_PARTITION)
    seen = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5]).alias("cuts"),
                    F.count_if(F.isnull("doc_id")).alias("without"), F.count(F.lit(1)).alias("rows")).first()
    bounds, times = np.unique(np.array(seen.cuts or [], dtype=np.int64), return_counts=True)
    # An id that is a boundary more than once has about that many buckets of rows.
    hot = {int(b): int(t) for b, t in zip(bounds, times) if t > 1}
    none = -(-n * seen.without // max(1, seen.rows))
    width = max([1, none, *hot.values()])

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series, marks: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        ids = ids.fillna(0).astype("int64").to_numpy()
        at = len(bounds) - np.searchsorted(bounds, ids, side="left")
        # Where an id has several buckets, all other ids of its range come before or after them.
        place = np.where(known, 2 * at, 2 * len(bounds) + 2).astype(np.int64)
        parts = np.where(known, 1, none)
        if hot:
            share = pd.Series(ids).map(hot).fillna(1).to_numpy(dtype=np.int64)
            parts = np.where(known, share, parts)
            place -= (known & (share > 1)).astype(np.int64)
        unit = marks.to_numpy().astype(np.float64) / 2.0**64 + 0.5
        inside = np.minimum((unit * parts).astype(np.int64), np.maximum(parts, 1) - 1)
        return pd.Series(place * width + inside).astype("int32")

    placed = docs.withColumn("bucket", bucket_of("doc_id", "mark"))
    # One row per bucket: its first row in the order (nothing of its text but the hash).
    order = F.struct(F.isnotnull("doc_id"), "doc_id", -(F.col("mark").cast("decimal(20,0)")))
    heads = sorted((r.bucket, r.head[1], -int(r.head[2])) for r in
                   placed.groupBy("bucket").agg(F.max(order).alias("head")).collect())
    ahead = spark.createDataFrame([(heads[i - 1][0], head, mark) for i, (_, head, mark) in enumerate(heads)],
                                  "bucket int, head long, head_mark long")
    first_texts = (docs.join(F.broadcast(ahead), docs["doc_id"].eqNullSafe(ahead["head"])
                             & (docs["mark"] == ahead["head_mark"]))
                   .groupBy("bucket", "doc_id", "mark").agg(F.min("text").alias("text")))
    columns = ["bucket", "after", "doc_id", "mark", "text"]
    rows = (placed.withColumn("after", F.lit(0)).select(columns)
            .unionByName(first_texts.withColumn("after", F.lit(1)).select(columns)))
    # Dealt in turn, so that tasks have equally many buckets.
    turn = F.floor(F.col("bucket") / (2 * width)) + F.pmod(F.col("bucket"), F.lit(width))
    ordered = rows.repartitionById(partitions, F.pmod(turn, F.lit(partitions)).cast("int")).sortWithinPartitions(
        "bucket", "after", F.col("doc_id").desc_nulls_last(), "mark", F.col("text").asc_nulls_last())
    return ordered.select("doc_id", "text", "after").mapInArrow(_compare, _OUT)
