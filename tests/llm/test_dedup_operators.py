"""Near duplicates, repeated passages and near vectors against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm_support import SF001, docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from farelens.llm import bwt_dedup, hnsw, minmax, mixing
from farelens.llm.common import ROWS_PER_FILE, few_files, materialize, read_table
from farelens.llm.components import connected_components

WORD = re.compile("[^\x20\x09-\x0d]+")


class Sets:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, a):
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute_components(texts):
    sets, holders, common = [(i, shingles(t)) for i, t in texts], defaultdict(list), Counter()
    for n, (_, s) in enumerate(sets):
        for g in s:
            holders[g].append(n)
    for who in holders.values():
        for i, a in enumerate(who):
            common.update((a, b) for b in who[i + 1:])
    groups = Sets([i for i, _ in sets if i is not None])
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n) and None not in (sets[a][0], sets[b][0]):
            groups.join(sets[a][0], sets[b][0])
    return {i: groups.find(i) for i in groups.parent}, sets


def check_near_duplicates(rows, texts):
    want, sets = brute_components(texts)
    assert sorted((r.doc_id, r.n_shingles) for r in rows if r.doc_id is not None) == \
        sorted((i, len(s)) for i, s in sets if i is not None)
    for r in rows:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        assert r.kept == (r.doc_id is None or r.component_id == r.doc_id)
    assert len(rows) == len(texts)


def test_near_duplicates_equal_brute_force(spark):
    docs = read_table(spark, SF001, "documents")
    check_near_duplicates(minmax.near_duplicates(docs).collect(),
                          [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def varied(n, seed):
    """Copies of one text with a few words changed: similarities around the limit."""
    rng = np.random.default_rng(seed)
    base = [f"w{rng.integers(1, 4000)}" for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 5), replace=False):
            words[at] = f"x{rng.integers(1, 10**6)}"
        out.append(" ".join(words))
    return out


def test_near_copies_around_the_limit(spark, monkeypatch):
    """Blocks of large buckets and groups give the same components."""
    texts = list(enumerate([t for seed in range(6) for t in varied(25, seed)]))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    check_near_duplicates(minmax.near_duplicates(df).collect(), texts)
    monkeypatch.setattr(minmax, "BLOCK", 8)
    monkeypatch.setattr(minmax, "GROUP_BLOCK", 5)
    check_near_duplicates(minmax.near_duplicates(df).collect(), texts)


def test_min_max_estimates_are_unbiased():
    a, b = minmax.coefficients()
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 700, dtype=np.uint64)
        one, two = x[:500], x[200:]
        same = (minmax.signature(one, a, b) == minmax.signature(two, a, b)).mean()
        errors.append(same - 300 / 700)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    k = np.arange(minmax.BANDS)[:, None]
    i = np.arange(minmax.BAND)[None, :]
    used = ((k % 16) + 16 * i) + 64 * ((i + k // 16) % 2)
    assert len(np.unique(used)) == 2 * minmax.PERMUTATIONS      # every value in one band


def test_cells_emit_links_of_a_forest():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 256, 128, dtype=np.uint8)
    cell, links = minmax.Members(), []
    for doc in range(40):
        close = base.copy()
        close[rng.choice(128, 20, replace=False)] += 1
        at = cell.append(doc, 100, close)
        links += [cell.join(i, at) for i in cell.near(at) if cell.clusters[i] != cell.clusters[at]]
    assert len(links) == 39
    assert len(cell.near(cell.append(50, 300, base))) == 0        # three times the size
    assert len(cell.near(cell.append(51, 100, base + 1))) == 0    # nothing in common


def test_similarity_on_full_sets():
    rng = np.random.default_rng(3)
    mine = np.unique(rng.integers(0, 10**6, 400, dtype=np.uint64))
    others = [mine, mine[:len(mine) * 3 // 4], mine[:len(mine) * 3 // 4 - 2],
              np.unique(np.append(mine, np.uint64(10**7))), np.array([5 * 10**6], dtype=np.uint64)]
    want = [100 * len(np.intersect1d(mine, o)) >= 75 * len(np.union1d(mine, o)) for o in others]
    assert minmax.similar(mine, others).tolist() == want


def test_near_duplicates_of_awkward_rows(docs, no_docs):  # noqa: F811
    check_near_duplicates(minmax.near_duplicates(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert minmax.near_duplicates(no_docs).count() == 0
    kept = minmax.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect())
    # One of 0, 1, 2 and one of 11, 12, 12: ids are shared here, so any of the rows.
    assert len(ids) == 13 and len({0, 1, 2} & set(ids)) == len({11, 12} & set(ids)) == 1
    assert set(ids) - {0, 1, 2, 11, 12} == {-1, 3, 4, 5, 6, 7, 8, 9, 10, 13, 14}
    sound = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    assert sorted(r.doc_id for r in minmax.keep_one_of_each(sound).collect()) == [0, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14]


def test_different_texts_stay_whatever_their_ids(spark):
    words = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(6)]
    rows = [(1, words[0]), (1, words[1]), (1, words[1]), (None, words[2]), (None, words[3]), (2, words[3] + " more"),
            (2, words[4]), (3, words[0]), (None, None), (None, None), (4, words[5])]
    kept = minmax.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    texts = [r.text for r in kept]
    assert sorted(t.split()[0] for t in texts if t) == sorted(w.split()[0] for w in words) and texts.count(None) == 2


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(5, 5), (61, 60)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 7 for i in range(7, 60))
    assert got[61] == got[60] == 60 and 5 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture
def many_partitions(spark):
    """Shuffles of 64 partitions that are not put together, as a job with large texts has them."""
    names = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def test_few_rows_go_to_few_files(spark, many_partitions, monkeypatch):
    files = {}

    def counted(df, name):
        files[name] = (out := materialize(df, name)).inputFiles()
        return out

    monkeypatch.setattr(minmax, "materialize", counted)
    monkeypatch.setattr(mixing, "materialize", counted)
    words = [" ".join(f"w{i // 2}x{k}" for k in range(30 + i % 2)) for i in range(60)]
    table = spark.createDataFrame([(i, t, "s") for i, t in enumerate(words)], "doc_id long, text string, source string")
    kept = minmax.keep_one_of_each(table.repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 60, 2))
    taken = mixing.taken_words(mixing.mix_sources(table)).agg(F.sum("taken"), F.count("doc_id")).first()
    assert tuple(taken) == (30 * 61 * 3 // 2, 60)
    assert len(files) == 9 and all(len(f) <= 3 for f in files.values()), {n: len(f) for n, f in files.items()}


def test_rounds_over_few_edges_write_few_files(spark, many_partitions):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    found = connected_components(edges)
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(41)}
    assert found.rdd.getNumPartitions() <= 2


def test_many_rows_keep_their_partitions(spark, many_partitions):
    table = spark.range(1000).repartition(64, "id")
    assert few_files(table, 64 * ROWS_PER_FILE) is table
    some = few_files(table, 10 * ROWS_PER_FILE + 1)
    assert some.rdd.getNumPartitions() == 11 and some.distinct().count() == 1000


def brute_repeats(texts, n=200):
    data = [(i, (t or "").encode()) for i, t in texts]
    counts = Counter(b[s:s + n] for _, b in data for s in range(len(b) - n + 1))
    out = []
    for i, b in data:
        cover = np.zeros(len(b), dtype=bool)
        for s in range(len(b) - n + 1):
            if counts[b[s:s + n]] > 1:
                cover[s:s + n] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], cover.astype(int)])) == 1))
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~cover])
        out.append((i if i is not None else -1, len(b), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def repeats(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in bwt_dedup.remove_repeats(df, keep_text=False).collect())


def test_repeated_passages_equal_brute_force(spark):
    docs = read_table(spark, SF001, "documents")
    assert repeats(docs) == brute_repeats([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("hot", [4096, 1])
def test_repeated_passages_of_awkward_rows(docs, no_docs, spark, monkeypatch, hot):
    """With HOT = 1 every contested anchor is counted window by window instead of built."""
    monkeypatch.setattr(bwt_dedup, "HOT", hot)
    few = docs.filter("doc_id is null or doc_id <> 7")
    assert repeats(few) == brute_repeats([(r.doc_id, r.text) for r in few.collect()])
    assert repeats(no_docs) == []
    rng = np.random.default_rng(4)
    passage = bytes(rng.integers(97, 123, 260)).decode()
    noise = [bytes(rng.integers(97, 123, 300)).decode() for _ in range(30)]
    texts = [(i, t[:i * 7] + passage[i % 3:] + t[i * 7:]) for i, t in enumerate(noise)]
    assert repeats(spark.createDataFrame(texts, "doc_id long, text string")) == brute_repeats(texts)


def test_column_wise_construction_equals_counting():
    rng = np.random.default_rng(3)
    base = [bytes(rng.integers(97, 101, 420)) for _ in range(3)]
    pieces = [base[i % 3][i:i + 201 + 3 * i] for i in range(30)] + [b"xy" * 150, b"short", b""]
    counts = Counter(p[s:s + 200] for p in pieces for s in range(len(p) - 199))
    for p, flags in zip(pieces, bwt_dedup.repeated_windows(pieces)):
        want = [s + 200 <= len(p) and counts[p[s:s + 200]] > 1 for s in range(len(p))]
        assert flags.tolist() == want


def test_segments_depend_on_content_only(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 123, 3000).astype(np.uint8)

    def windows(part):
        out = {}
        for start, n, offset, anchor, _ in bwt_dedup.segments(part, bwt_dedup.Hasher()):
            for s, k, o, a in zip(start, n, offset, anchor):
                for w in range(k):
                    out[int(s) + w] = (int(o) - w, int(a))
        return out

    whole, shifted = windows(data), windows(data[137:])
    assert sorted(whole) == list(range(3000 - 199))
    assert all(whole[s + 137] == v for s, v in shifted.items())
    monkeypatch.setattr(bwt_dedup, "CHUNK", 700)
    assert windows(data) == whole


def record(columns, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def rows_in(batches):
    return sorted((tuple(r.values()) for b in batches for r in b.to_pylist()), key=repr)


def test_short_texts_are_cut_together(monkeypatch):
    """Equal to each text cut alone, with a few calls for many texts; no window crosses two texts."""
    rng = np.random.default_rng(6)
    texts = [bytes(rng.integers(97, 123, n).astype(np.uint8)).decode() for n in rng.integers(0, 900, 400)]
    texts[3:6], texts[9] = [None, "", "é" * 150], texts[8]
    texts.append("long text " * 20_000)                                             # longer than a pack
    schema = pa.schema([("uid", pa.int64()), ("uid2", pa.int64()), ("text", pa.string())])
    calls, grams = [], bwt_dedup.Hasher.grams
    monkeypatch.setattr(bwt_dedup.Hasher, "grams", lambda self, data: calls.append(len(data)) or grams(self, data))
    together = pa.Table.from_batches(bwt_dedup._cut(
        [record(([-1], [-1], ["not in the slice"]), schema), record((range(401), [7] * 401, texts), schema).slice(0, 300),
         record((range(401), [7] * 401, texts), schema).slice(300)])).drop_columns(["n"])
    assert len(calls) < 20
    alone = [(int(a), int(k), i, 7, int(s), int(w), int(o)) for i, t in enumerate(texts)
             for cut in bwt_dedup.segments(np.frombuffer((t or "").encode(), dtype=np.uint8), bwt_dedup.Hasher())
             for s, w, o, a, k in zip(*cut)]
    assert rows_in([together]) == sorted(alone, key=repr)


@pytest.mark.parametrize("most", [4096, 2])
def test_pieces_meet_alike_in_any_batches(monkeypatch, most):
    """Anchors within a batch are settled at once, as those cut by its edges are row by row."""
    monkeypatch.setattr(bwt_dedup, "HOT", most)
    rng = np.random.default_rng(7)
    rows = sorted((int(a), int(k), int(n)) for a, k, n in zip(rng.integers(0, 60, 400), rng.integers(0, 5, 400),
                                                              rng.choice([1, 1, 1, 2, 5], 400)))
    rows += [(100, k, 1) for k in range(6)] + [(101, 1, 1)] + [(102, 1, 1)] * 2 + [(103, 1, 3), (104, 1, 1), (104, 2, 1)]
    schema = pa.schema([(c, bwt_dedup._SEGMENT_ARROW.field(c).type)
                        for c in ("anchor", "key", "n", "uid", "uid2", "start", "windows", "offset")])
    anchor, key, n = zip(*rows)
    i = range(len(rows))
    whole = record((anchor, key, n, i, [0] * len(rows), i, [3] * len(rows), [1] * len(rows)), schema)

    def met(size):
        parts = [whole.slice(at, size) for at in range(0, len(rows), size)]
        out = rows_in(bwt_dedup._meet(bwt_dedup.COUNTED)(parts))
        # A repeated piece's number is not read later on.
        return [r if r[7] != bwt_dedup.REPEATED else (*r[:6], None, r[7]) for r in out]

    classes, members = Counter(a for a, _ in {(a, k) for a, k, _ in rows}), Counter()
    for a, k, c in rows:
        members[a, k] += c
    single = {a for (a, _), c in members.items() if c == 1}
    contested = {a for a, c in classes.items() if c > most or (c > 1 and a in single)}
    for size in (1, 7, 64, len(rows)):
        got = Counter((r[0], r[7]) for r in met(size))
        assert sorted(met(size), key=repr) == sorted(met(1), key=repr)
        for a in classes:
            kind = bwt_dedup.COUNTED if classes[a] > most else bwt_dedup.CONTESTED
            assert got[a, kind] == (classes[a] if a in contested else 0)
            assert got[a, bwt_dedup.REPEATED] == sum(1 for x, k, _ in rows if x == a and members[x, k] > 1)


def test_core_of_a_block_is_one_symbol(monkeypatch):
    """Rounds are as many as the symbols of a piece: 85 with the core as one, 242 byte by byte."""
    rng = np.random.default_rng(8)

    def some(low, high, n):
        return bytes(rng.integers(low, high, n).astype(np.uint8))

    cores = [some(0, 256, bwt_dedup.CORE) for _ in range(4)] + [b"a" * bwt_dedup.CORE]
    sides = [(some(97, 99, 42), some(97, 99, 42)) for _ in range(3)]
    sides.append((sides[0][0], sides[1][1]))
    pieces, at = [], []
    for core in cores:
        for _ in range(12):
            (left, _), (_, right) = sides[rng.integers(4)], sides[rng.integers(4)]
            most = int(rng.integers(0, 43))                                         # bytes before the core
            least = int(rng.integers(0, most + 1))
            pieces.append(left[42 - most:] + core + right[:42 - least])
            at.append(most)
    lengths, construct = [], bwt_dedup.construct
    monkeypatch.setattr(bwt_dedup, "construct",
                        lambda flat, length, window: lengths.extend(length) or construct(flat, length, window))
    # Equal windows of a block hold its core at the same offset.
    places = [(i, s, (at[i] - s, p[s:s + 200])) for i, p in enumerate(pieces) for s in range(len(p) - 199)]
    counts = Counter(w for _, _, w in places)
    want = {(i, s) for i, s, w in places if counts[w] > 1}
    found = bwt_dedup.repeated_around(pieces, at)
    assert {(i, s + k) for i, s, n in found for k in range(n)} == want and want
    assert max(lengths) <= 2 * (bwt_dedup.BLOCK - 1) + 1
    schema = pa.schema([(c, bwt_dedup._BYTES_ARROW.field(c).type) for c in ("anchor", "uid", "uid2", "start", "core", "bytes")])
    lengths.clear()
    batch = record((range(len(pieces)), range(len(pieces)), [0] * len(pieces), [1000] * len(pieces), at, pieces), schema)
    spans = rows_in(bwt_dedup._build([batch]))
    assert spans == sorted(((i, 0, 1000 + s, n) for i, s, n in found), key=repr)
    assert lengths and max(lengths) <= 85


def test_spans_that_touch_or_overlap_are_one_in_each_text():
    texts = ["a" * 300 + "b" * 300, "c" * 250, None, "é" * 200, "d" * 700]
    spans = [[(300, 101), (0, 101)], [(0, 51)], None, [], [(0, 1), (100, 5), (400, 3), (410, 1)]]
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("windows", pa.int32())])))])
    batch = record((range(5), texts, [s and [{"start": a, "windows": w} for a, w in s] for s in spans]), schema)
    for part in (batch, batch.slice(1), batch.slice(0, 0)):
        out = [r for b in bwt_dedup._remove(True)([part]) for r in b.to_pylist()]
        for r in out:
            data, cover = (texts[r["doc_id"]] or "").encode(), set()
            for a, w in spans[r["doc_id"]] or []:
                cover.update(range(a, a + w + 199))
            kept = bytes(c for i, c in enumerate(data) if i not in cover)
            assert (r["n_bytes"], r["n_removed"], r["kept"]) == (len(data), len(cover), kept)
            assert r["n_spans"] == sum(1 for i in cover if i - 1 not in cover)
            assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        assert len(out) == part.num_rows


def brute_vectors(rows, threshold=0.9):
    good = [(i, np.array(v, dtype=float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, groups = Counter(), Sets([i for i, _ in rows if i is not None])
    for n, (i, a) in enumerate(good):
        for j, b in good[n + 1:]:
            if i != j and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    return links, groups


def check_vectors(got, rows):
    links, groups = brute_vectors(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id) == (links[r.vec_id], groups.find(r.vec_id))
            assert r.kept == (r.vec_id == r.component_id)


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(900):
        v = rng.standard_normal(16)
        for _ in range(1 + 3 * (i % 40 == 0) + 60 * (i == 5)):
            rows.append((len(rows), [float(x) for x in v + 0.08 * rng.standard_normal(16)]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check_vectors(hnsw.near_vectors(df, min_shards=2).collect(), rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, []), (8, [1e-200, 0.0]), (9, [1e200, 0.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]),
            (11, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_vectors(df).collect()}
    assert [got[i] for i in (0, 1, 8, 9)] == [(3, 0)] * 4
    assert all(got[i] == (0, i) for i in (2, 3, 4, 5, 6, 7, 10, 11)) and got[None] == (0, None)
    assert hnsw.near_vectors(df.limit(0)).count() == 0


def test_graph_finds_what_brute_force_finds():
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((40, 32))
    x = np.concatenate([centres[rng.integers(0, 40, 1500)] + 0.05 * rng.standard_normal((1500, 32)),
                        rng.standard_normal((500, 32))])
    ids = np.arange(len(x))
    shard = hnsw.Shard(ids, x, 0.9)
    assert shard.graph is not None
    counts, links = shard.answer(ids, x)
    sims = hnsw.unit(x) @ hnsw.unit(x).T
    np.fill_diagonal(sims, 0)
    want = (sims >= 0.9).sum(axis=1)
    assert counts.sum() >= 0.99 * want.sum() and (counts <= want).all()
    assert len(links) < 2 * len(x)


def families(rng, groups, d=16):
    rows = []
    for i in range(groups):
        v = rng.standard_normal(d)
        for _ in range(1 + 3 * (i % 40 == 0) + 60 * (i == 5)):
            rows.append((len(rows), [float(x) for x in v + 0.08 * rng.standard_normal(d)]))
    return rows


def test_vectors_are_not_sent_to_every_shard(spark, monkeypatch):
    rows = families(np.random.default_rng(8), 400)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    dealt, kind = [], type(df)

    def counted(self, *args, send=kind.mapInArrow, **kw):
        dealt.append(self.count())
        return send(self, *args, **kw)

    monkeypatch.setattr(kind, "mapInArrow", counted)
    check_vectors(hnsw.near_vectors(df, min_shards=60).collect(), rows)
    assert max(dealt) <= 30 * len(rows)


def test_vectors_in_rounds_and_large_cells_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "HOT_ROWS", 40)
    monkeypatch.setattr(hnsw, "ROUND_BYTES", 1)
    monkeypatch.setattr(hnsw, "ROUND_COPIES", 12)
    rows = families(np.random.default_rng(9), 200)
    rows += [(3, rows[0][1]), (3, rows[3][1]), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check_vectors(hnsw.near_vectors(df, min_shards=3).collect(), rows)


def test_a_dimension_that_the_sample_lacks(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "_graphs", lambda *_: {})
    rows = families(np.random.default_rng(10), 100)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check_vectors(hnsw.near_vectors(df, min_shards=3).collect(), rows)


def test_a_dense_group_counts_each_pair_once():
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.standard_normal(24) + 0.12 * rng.standard_normal((1200, 24)), rng.standard_normal((2000, 24))])
    shard = hnsw.Shard(np.arange(len(x)), x, 0.9)
    members, counts = shard.members, np.zeros(len(x), dtype=int)
    for cell, rows in shard.cells.items():
        counts[rows] += hnsw.meet(cell, members.at(rows), None, 0.9)[0]
    sims = hnsw.unit(x) @ hnsw.unit(x).T
    np.fill_diagonal(sims, 0)
    assert (counts == (sims >= 0.9).sum(axis=1)).all()
    assert (shard.answer(members.ids, x)[0] == counts).all()


def test_equal_vectors_count_each_other(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "HOT_ROWS", 150)
    some = families(np.random.default_rng(13), 60)
    rows = [(len(some) * k + i, v) for k in range(5) for i, v in some]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check_vectors(hnsw.near_vectors(df, min_shards=3).collect(), rows)
