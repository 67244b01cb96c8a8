"""Cross-tokenizer alignment: which tokens of a byte-level BPE and of a piece model share bytes.

Per batch both sides are frames of token starts.  Two ``merge_asof`` joins
keyed by document find, for each token start, the other side's token that
covers it; two tokens overlap exactly when one's start lies in the other, so
the union of both directions gives all overlaps.  Byte offsets where both
sides end a token cut the tokens into groups.

How many documents hold an id pair linked is counted over the whole corpus.
The counts go back to the documents in two ways: pairs so frequent that only
``HOT_PAIRS`` of them can exist are broadcast; the rest, each with few rows,
is joined by a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import materialize
from farelens.llm.tokens import ByteBpe, merges_by_rank, token_bytes

BYTE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"
# Characters of documents aligned together; a longer document is a batch of its own.
TOGETHER = 500_000
# At most so many id pairs are broadcast: those in at least 1 / HOT_PAIRS of all (document, pair) rows.
HOT_PAIRS = 1 << 17
# An id pair as one number: A id * PAIR + B id.
PAIR = 1 << 24

_DIGEST = ("doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<long>")
_WHOLE = "a_ids array<long>, a_ends array<long>, b_ids array<long>, b_ends array<long>, a_linked array<long>, b_linked array<long>"


def piece_bytes(model) -> list[bytes]:
    """The bytes of each id of a piece model: byte pieces as the byte, U+2581 as a space."""
    out = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode("utf-8"))
    return out


class Encoders:
    """Token ids and byte lengths of both sides for one text."""

    def __init__(self, byte_path: str, ranked: bool, piece_path: str):
        import sentencepiece

        self.a = ByteBpe(byte_path, ranked, added=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        known = token_bytes(byte_path)
        self.bytes_a = [known.get(i, b"") for i in range(max(known) + 1)]
        self.bytes_b = piece_bytes(self.b)
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)

    def ids(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Both sides' ids; none if a side's bytes are not those of space + text."""
        nothing = np.empty(0, dtype=np.int64)
        if not text:
            return nothing, nothing
        whole = b" " + text.encode("utf-8")
        a = np.frombuffer(self.a.encode(" " + text), dtype="<u4").astype(np.int64)
        b = self.b.encode(text)
        # Ids by rank spell the text's bytes by construction; other files may normalize.
        exact = self.a.fast is not None or b"".join(map(self.bytes_a.__getitem__, a.tolist())) == whole
        if not exact or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return nothing, nothing
        return a, np.array(b, dtype=np.int64)


class Side:
    """Tokens of a batch's documents on one side; offsets run on from document to document."""

    def __init__(self, ids: list[np.ndarray], lengths: np.ndarray):
        self.n = np.array([len(x) for x in ids], dtype=np.int64)
        self.ids = np.concatenate(ids)
        self.doc = np.repeat(np.arange(len(ids)), self.n)
        self.ends = np.cumsum(lengths[self.ids])
        self.starts = self.ends - lengths[self.ids]
        self.first = np.concatenate([[0], np.cumsum(self.n)])     # of each document

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"doc": self.doc, "start": self.starts, name: np.arange(len(self.ids))})


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (a, b) of all tokens that share a byte, in no order."""
    left, right = a.frame("a"), b.frame("b")
    onto_b = pd.merge_asof(left, right, on="start", by="doc")
    # An equal start was found from the other side already.
    onto_a = pd.merge_asof(right, left, on="start", by="doc", allow_exact_matches=False)
    i = np.concatenate([onto_b["a"].to_numpy(), onto_a["a"].to_numpy()])
    j = np.concatenate([onto_b["b"].to_numpy(), onto_a["b"].to_numpy()])
    found = ~(np.isnan(i) | np.isnan(j))
    i, j = i[found].astype(np.int64), j[found].astype(np.int64)
    # The last token that starts before need not reach so far.
    covers = (a.starts[i] < b.ends[j]) & (b.starts[j] < a.ends[i])
    return i[covers], j[covers]


def group_texts(a: Side, b: Side, cuts: np.ndarray, names: np.ndarray) -> list[str]:
    """Each document's groups as ``a1,a2|b1;a3|b2,b3``.

    ``names[k, id]`` is the id in decimal with the k-th of the separators , | ; behind it.
    """
    group_a, group_b = np.searchsorted(cuts, a.ends), np.searchsorted(cuts, b.ends)
    tokens_a, tokens_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
    out = np.empty(len(a.ids) + len(b.ids), dtype=object)
    out[np.arange(len(a.ids)) + (np.cumsum(tokens_b) - tokens_b)[group_a]] = names[
        np.where(np.isin(a.ends, cuts, assume_unique=True), 1, 0), a.ids]
    out[np.arange(len(b.ids)) + np.cumsum(tokens_a)[group_b]] = names[
        np.where(np.isin(b.ends, cuts, assume_unique=True), 2, 0), b.ids]
    first = a.first + b.first
    return ["".join(out[s:e].tolist())[:-1] for s, e in zip(first[:-1], first[1:])]


def _lists(values: np.ndarray, doc: np.ndarray, n_docs: int) -> pa.Array:
    """``values``, in order of ``doc``, as one list a document."""
    first = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n_docs))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(first), pa.array(values.astype(np.int64)))


def align_batch(encoders: Encoders, names: np.ndarray, texts: list[str | None], whole: bool) -> dict[str, pa.Array]:
    ids = [encoders.ids(t) for t in texts]
    a = Side([x for x, _ in ids], encoders.length_a)
    b = Side([y for _, y in ids], encoders.length_b)
    n = len(texts)
    i, j = overlaps(a, b)
    cuts = np.intersect1d(a.ends, b.ends, assume_unique=True)
    # Equal bytes end both sides together, so a cut belongs to the document of the token that ends there.
    n_groups = np.bincount(a.doc[np.searchsorted(a.ends, cuts)], minlength=n)
    pairs, which = np.unique(a.ids[i] * PAIR + b.ids[j], return_inverse=True)
    cells, times = np.unique(a.doc[i] * max(1, len(pairs)) + which, return_counts=True)
    cell_doc, cell_pair = cells // max(1, len(pairs)), pairs[cells % max(1, len(pairs))]
    out = {
        "n_a": pa.array(a.n), "n_b": pa.array(b.n), "n_groups": pa.array(n_groups),
        "n_links": pa.array(np.bincount(a.doc[i], minlength=n)),
        "groups_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() if t else ""
                                   for t in group_texts(a, b, cuts, names)], pa.string()),
        "pairs": _lists(cell_pair, cell_doc, n), "times": _lists(times, cell_doc, n),
    }
    if whole:
        order = np.lexsort((j, i))
        i, j = i[order], j[order]
        start = np.concatenate([[0], a.ends])[a.first[:-1]]
        out |= {"a_ids": _lists(a.ids, a.doc, n), "a_ends": _lists(a.ends - start[a.doc], a.doc, n),
                "b_ids": _lists(b.ids, b.doc, n), "b_ends": _lists(b.ends - start[b.doc], b.doc, n),
                "a_linked": _lists(i - a.first[a.doc[i]], a.doc[i], n),
                "b_linked": _lists(j - b.first[a.doc[i]], a.doc[i], n)}
    return out


def _align(byte_path: str, ranked: bool, piece_path: str, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoders = Encoders(byte_path, ranked, piece_path)
        most = max(len(encoders.bytes_a), len(encoders.bytes_b))
        names = np.array([[f"{i}{s}" for i in range(most)] for s in ",|;"], dtype=object)
        row = TaskContext.get().partitionId() << 33

        def aligned(ids, texts, row):
            cols = align_batch(encoders, names, texts, whole)
            cols = {"doc_id": pa.array(ids, pa.int64()), "row": pa.array(np.arange(row, row + len(ids)))} | cols
            return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

        for batch in batches:
            ids, texts, size = [], [], 0
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids.append(doc)
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= TOGETHER:
                    yield aligned(ids, texts, row)
                    row += len(ids)
                    ids, texts, size = [], [], 0
            if ids:
                yield aligned(ids, texts, row)
                row += len(ids)

    return run


def pair_counts(cells: DataFrame) -> DataFrame:
    """(pair, docs, best) from a row per document and linked pair.

    ``docs``: documents that hold the pair linked; ``best``: no other pair of
    its A id is in more.  A frequent pair is summed up in each task before
    the shuffle; an A id has at most as many pairs as there are B ids.
    """
    docs = cells.groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    a = F.floor(F.col("pair") / F.lit(PAIR)).cast("int")
    counts = materialize(docs, "align_pairs")
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, whole: bool = True,
                    hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Alignment of each document's two tokenizations; one row per input row.

    ``docs`` has doc_id and text; other columns are not read.  A side's
    tokens: space + text by the byte-level file, text by the piece model,
    which adds that space.  Special tokens written in a text are plain text.

    Returns doc_id, n_a, n_b (tokens), n_groups, n_links, n_best, count_sum,
    groups_sha256 and, with ``whole``, the alignment itself: a_ids, b_ids,
    a_ends, b_ends (byte offset in space + text behind each token; an end
    common to both sides ends a group) and a_linked, b_linked (token indexes
    of each link).

    A NULL or empty text, and one that a side cannot give back byte by byte
    (as with U+2581 in the text), has no tokens: zeros, an empty string and
    empty arrays.  Repeated rows and shared or NULL doc_ids are rows of their
    own, and count as documents each.  Equal counts are all the best.  An
    empty table gives no rows.  A task holds ``TOGETHER`` characters of
    documents, or one longer text, with its tokens.
    """
    schema = _DIGEST + (", " + _WHOLE if whole else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stored = materialize(rows.mapInArrow(_align(byte_path, merges_by_rank(byte_path), piece_path, whole), schema), "align")
    cells = stored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("c")).select(
        "row", F.col("c.pairs").alias("pair"), F.col("c.times").alias("times"))
    counts = materialize(pair_counts(cells.select("pair")), "align_counts")
    n_cells = stored.agg(F.sum(F.size("pairs")).cast("long")).first()[0] or 0
    # The documents of all pairs add up to n_cells, so at most hot_pairs reach this.
    hot = counts.filter(F.col("docs") * F.lit(hot_pairs) >= F.lit(n_cells)).select(
        "pair", F.col("docs").alias("hot_docs"), F.col("best").alias("hot_best"))
    looked = cells.join(F.broadcast(hot), "pair", "left")
    frequent = looked.filter("hot_docs is not null").select(
        "row", "times", F.col("hot_docs").alias("docs"), F.col("hot_best").alias("best"))
    rare = (looked.filter("hot_docs is null").select("row", "times", "pair")
            .join(counts.filter(F.col("docs") * F.lit(hot_pairs) < F.lit(n_cells)), "pair").select("row", "times", "docs", "best"))
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
            F.sum(F.col("times") * F.col("docs")).alias("count_sum")]
    both = frequent.groupBy("row").agg(*sums).unionByName(rare.groupBy("row").agg(*sums))
    per_row = both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    kept = [c.split()[0] for c in _WHOLE.split(", ")] if whole else []
    return stored.drop("pairs", "times").join(per_row, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups_sha256", *kept)
