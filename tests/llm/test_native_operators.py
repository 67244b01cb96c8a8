"""Mixing, sharding and pseudonyms: invariants, edge rows, bijections."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_support import SF001, docs, no_docs  # noqa: F401
from farelens.llm import mixing, pii, sharding
from farelens.llm.common import read_table
from farelens.llm.feistel import permute

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 1000])
def test_permutation_is_a_bijection(spark, n):
    for secure in (False, True):
        got = [r.y for r in spark.range(n).select(permute(F.col("id"), F.lit(n), "k", secure=secure).alias("y")).collect()]
        assert sorted(got) == list(range(n))


def test_shards_are_even_gapless_and_reproducible(spark):
    docs = read_table(spark, SF001, "documents")
    rows = sharding.shard_documents(docs, 24).collect()
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(rows) == len(texts)
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    import zlib
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    again = sharding.shard_documents(docs.repartition(7), 24).collect()
    place = {(r.doc_id, r.shard, r.slot) for r in rows}
    assert place == {(r.doc_id, r.shard, r.slot) for r in again}
    # Shard and slot follow from the row number alone.
    number = spark.range(len(rows)).select(
        "id", *[c.alias(a) for c, a in zip(sharding.place(F.col("id"), F.lit(len(rows)), 24, "shuffle-1"), "st")])
    assert {(r.row_number, r.shard, r.slot) for r in rows} == {(r.id, r.s, r.t) for r in number.collect()}


def test_shards_of_awkward_rows(docs, no_docs):  # noqa: F811
    rows = sharding.shard_documents(docs, 24).collect()
    assert len(rows) == 17
    assert next(r for r in rows if r.doc_id == 3)[1:3] == (8, 0)
    assert sum(r.doc_id == 12 for r in rows) == 2
    assert sharding.shard_documents(no_docs, 24).count() == 0


def reference_targets(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        level = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in capped else level * w[s] for s in names}
        capped |= over


def check_mix(rows, texts):
    sizes = Counter()
    for i, source, size in texts:
        sizes[source] += size
    want, got = reference_targets(dict(sizes)), Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        got[r.source] += r.taken
    for s, target in want.items():
        assert target - 1 <= got[s] <= target + 1e-6


def test_mix_meets_targets(spark):
    docs = read_table(spark, SF001, "documents")
    mix = mixing.mix_sources(docs)
    rows = mixing.taken_words(mix).collect()
    check_mix(rows, [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()])
    again = mixing.taken_words(mixing.mix_sources(docs.repartition(5))).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}
    # Shards hold equal numbers of blocks, and no block of a pass twice.
    draws = mix.draws.collect()
    per_shard = Counter(r.shard for r in draws)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    assert len({(r.doc_id, r.rep, r.block, r.copy) for r in draws}) == len(draws)


def test_mixed_documents_hold_the_words_taken(docs, no_docs):  # noqa: F811
    mix = mixing.mix_sources(docs, block_words=8)
    taken = {(r.doc_id, r.rep): r.taken for r in mixing.taken_words(mix).collect()}
    check_mix(mixing.taken_words(mix).collect(),
              [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()])
    out = mixing.mixed_documents(docs, block_words=8)
    assert out.columns == docs.columns
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    want = Counter()
    for (i, _), n in taken.items():
        want[i] += n
    assert +got == +want
    assert mixing.mixed_documents(no_docs).count() == 0


def test_mixture_lies_by_shard_and_keyed_hash(spark, docs):  # noqa: F811
    docs = docs.filter("text is not null")
    mix = mixing.mix_sources(docs, block_words=8, n_shards=4)
    draws = sorted(mix.draws.collect(), key=lambda r: (r.shard, r.draw_key))
    out = mixing.mixed_documents(docs, block_words=8, n_shards=4)
    rows = [r.doc_id for part in out.select("doc_id").rdd.glom().collect() for r in part]
    assert rows == [r.doc_id for r in draws]
    # Copies of a document drawn twice are dealt apart: they are not all neighbours.
    twice = {(r.doc_id, r.rep, r.block) for r in draws if r.copy == 1}
    at = {(r.doc_id, r.rep, r.block, r.copy): i for i, r in enumerate(draws)}
    gaps = [abs(at[(*k, 0)] - at[(*k, 1)]) for k in twice]
    assert gaps and np.mean([g > 1 for g in gaps]) > 0.9
    per_doc = Counter((r.doc_id, r.rep, r.shard) for r in draws)
    for r in mixing.taken_words(mix).collect():
        assert r.shard_blocks == [per_doc[r.doc_id, r.rep, i] for i in range(4)] and r.blocks == sum(r.shard_blocks)


def test_many_equal_rows_without_an_id(spark, monkeypatch):
    # A third of all rows is one row without an id; twins differ in a column that is not drawn by.
    monkeypatch.setattr(mixing, "SAME_ROWS", 512)
    hot = spark.range(20_000).selectExpr("cast(null as long) doc_id", "'one two three' text", "'s' source", "1 mark")
    rest = spark.range(300).selectExpr("id doc_id", "repeat('w ', cast(id % 40 as int)) text", "null source", "2 mark")
    twins = spark.range(2).selectExpr("7L doc_id", "'same words here' text", "'t' source", "cast(id as int) + 3 mark")
    docs = hot.unionByName(rest).unionByName(twins)
    mix = mixing.mix_sources(docs, block_words=8)
    rows = mixing.taken_words(mix)
    assert rows.count() == 20_302
    check_mix(rows.filter("source is distinct from 's'").unionByName(
        rows.filter("source = 's'").groupBy("source", "source_size", "target").agg(
            F.sum("size").alias("size"), F.sum("taken").alias("taken")), allowMissingColumns=True).collect(),
        [(r.doc_id, r.source, len(WORD.findall(r.text))) for r in docs.collect()])
    # Every drawn block is written once, the hot row's beyond the others' path, too.
    drawn = Counter((r.doc_id, r.words) for r in mix.draws.collect())
    out = mixing.mixed_documents(docs, block_words=8).collect()
    assert drawn == Counter((r.doc_id, len(WORD.findall(r.text))) for r in out)
    marks = {r.mark for r in out if r.source == "t"}
    assert marks == {3, 4}


def test_row_identity_tells_places_of_nulls(spark):
    rows = spark.createDataFrame([(None, "a", None, [None, "x"]), (None, None, "a", [None, "x"]),
                                  (None, "a", None, ["x", None]), (None, "a", None, [None, "x"])],
                                 "doc_id long, text string, source string, more array<string>")
    uid, tag = mixing.row_identity(rows)
    assert rows.select(uid, tag).distinct().count() == 3


def test_inversion_is_the_hypergeometric_distribution():
    from math import comb

    good, bad, n = 23, 31, 17
    share = [comb(good, k) * comb(bad, n - k) / comb(good + bad, n) for k in range(n + 1)]
    ends = np.cumsum(share)
    for k in range(n + 1):
        if share[k] > 1e-9:
            assert mixing.invert_hypergeometric(ends[k] - share[k] / 2, good, bad, n) == k
    assert mixing.invert_hypergeometric(0.0, good, bad, n) == 0


def test_splitting_tree_is_exact():
    quotas = [1000, 3, 0, 517, 40_000]
    out = mixing.split_quotas(quotas, 7, seed=1)
    assert out.sum(axis=0).tolist() == quotas and out.min() >= 0
    assert np.ptp(out.sum(axis=1)) <= 1
    rng = np.random.default_rng(0)
    big = mixing.hypergeometric(rng, 7 * 10**11, 3 * 10**11, 10**6)
    assert abs(big - 700_000) < 5_000


def masked(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.pseudonymize(df).orderBy("doc_id").collect()]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def test_pseudonyms_keep_their_format(spark):
    texts = ["a bob.smith42@mail.example.com z", "ip 192.168.0.1.", "on 1984-02-29!", "31.12.1999 and 12/25/2001",
             "ssn 123-45-6789", "+1 (212) 555-0147 ###", "4539 1488 0343 6467", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"',
             "no data, 2024 or 4.0. or 1,000", None, ""]
    out = masked(spark, texts)
    shapes = [r"a [a-z]{3}\.[a-z]{5}[0-9]{2}@mail\.example\.com z", r"ip (\d{1,3}\.){3}\d{1,3}\.", r"on \d{4}-\d\d-\d\d!",
              r"\d\d\.\d\d\.\d{4} and \d\d/\d\d/\d{4}", r"ssn \d{3}-\d\d-\d{4}", r"\+1 \(\d{3}\) \d{3}-\d{4} ###",
              r"\d{4} \d{4} \d{4} \d{4}", r'token = "[0-9a-f]{40}"']
    for text, new, shape in zip(texts, out, shapes):
        assert new != text and re.fullmatch(shape, new), (text, new)
    assert luhn(out[6].replace(" ", ""))
    assert max(map(int, re.findall(r"\d+", out[1]))) <= 255
    assert out[8:] == texts[8:]


def test_equal_values_stay_linked_and_unequal_apart(spark):
    ips = [f"10.0.{i // 200}.{i % 200}" for i in range(400)]
    out = masked(spark, [f"from {ip} to {ip}" for ip in ips])
    pairs = [re.findall(r"[\d.]+", t) for t in out]
    assert all(a == b for a, b in pairs) and len({a for a, _ in pairs}) == 400


def test_what_does_not_validate_stays(spark):
    texts = ["4539 1488 0343 6468", "999.1.1.1", "2023-02-30", "666-12-3456 900-11-1111", "id 123456789012345678901234567890"]
    assert masked(spark, texts) == texts


def test_cards_beside_other_numbers(spark):
    card = "4111 1111 1111 1111"
    texts = ["4111111111111111 123", card + " 2 items", "12 " + card, "pay 5 4111111111111111.", "1234 " + card + " 99",
             "378282246310005 1234", "7 3782 822463 10005", "0412 " + card, "12 41111111 11111111",
             "4111 1111 1111 1111 4539 1488 0343 6467", card + " 2024-01-02", card + " 123-45-6789", "030 12345678 " + card,
             "743-555-3824 " + card, card + " 5 a@b.org", "4111 0111 1111 1111 0 10.0.0.1", "1 " * 2_000 + "2"]
    for text, new in zip(texts[:-1], masked(spark, texts)):
        assert re.sub("[0-9a-z]", "0", text) == re.sub("[0-9a-z]", "0", new) or "10.0.0.1" in text
        for value in ("4111 1111 1111 1111", "4111111111111111", "378282246310005", "3782 822463 10005", "41111111 11111111",
                      "4539 1488 0343 6467", "2024-01-02", "123-45-6789", "030 12345678", "743-555-3824", "a@b", "10.0.0.1"):
            assert value not in new, (text, new)
    # The same card has the same pseudonym, whatever stands beside it.
    out = masked(spark, [card, card + " 2 items", "12 " + card, "1234 " + card])
    assert out[1:] == [out[0] + " 2 items", "12 " + out[0], "1234 " + out[0]] and luhn(out[0].replace(" ", ""))
    df = spark.createDataFrame([(0, f"{card} {card} 7"), (1, "1234 5678 9012 3456")], "doc_id long, text string")
    assert [(r.pii_found, r.pii_masked) for r in pii.pseudonymize(df).orderBy("doc_id").collect()] == [(2, 2), (1, 0)]


def test_phones_without_country_code(spark):
    texts = ["743 555 3824", "1-743-555-3824", "030 12345678", "020 7946 0958", "07911 123456", "01 23 45 67 89", "call 743 555 3824 2x"]
    for text, new in zip(texts, masked(spark, texts)):
        assert new != text and re.sub("[0-9]", "0", text) == re.sub("[0-9]", "0", new), (text, new)
    texts = ["in 2024 or 100 200 3000", "0.123 456", "012 345"]
    assert masked(spark, texts) == texts


def test_pseudonyms_of_awkward_rows(docs, no_docs):  # noqa: F811
    out = {r.doc_id: r for r in pii.pseudonymize(docs).collect()}
    assert out[3].text is None and out[3].pii_found == 0 and out[4].text == ""
    assert out[9].pii_masked == 3 and out[13].pii_masked == 3 and out[7].pii_masked == 0
    assert pii.pseudonymize(docs, counts=False).columns == docs.columns
    assert pii.pseudonymize(no_docs).count() == 0


def test_native_plans_have_no_python(spark):
    docs = read_table(spark, SF001, "documents")
    for df in (pii.pseudonymize(docs), sharding.shard_documents(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
