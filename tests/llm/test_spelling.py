"""Spelling variants against brute force over all pairs of a small vocabulary."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from llm_support import SF001, docs, no_docs  # noqa: F401
from farelens.llm import queries, spelling
from farelens.llm.common import read_table


def near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def brute(n_of, ratio=spelling.RATIO):
    out, forms = {}, {}
    for word, n in n_of.items():
        others = sorted((-n_of[o], o) for o in n_of if near(word, o))
        wins = bool(others) and -others[0][0] >= ratio * n
        forms[word] = others[0][1] if wins else None
        out[word] = [forms[word], None, n, len(others), -others[0][0] if wins else None]
    for word in out:
        root = word
        while forms[root] is not None:
            root = forms[root]
        out[word][1] = root
    return {w: tuple(v) for w, v in out.items()}


def result(df):
    rows = df.collect()
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


def words(spark, n_of):
    return spark.createDataFrame(list(n_of.items()), "word string, n long").repartition(3)


def test_near_words_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    n_of = {}
    for _ in range(700):                # few letters: long runs of equal ones, many ties
        word = "".join(rng.choice([*"aabé"], rng.integers(1, 8)))
        n_of[word] = int(rng.choice([1, 1, 2, 5, 5, 30, 200]))
    assert result(spelling.spelling_variants(words(spark, n_of))) == brute(n_of)


def test_chains_ties_and_supplementary_characters(spark):
    n_of = {"aaaaaa": 3125, "aaaaab": 625, "aaaabb": 125, "aaabbb": 25, "aabbbb": 5, "aabbbbb": 1,     # a chain of five
            "zzzzzy": 10, "zzzzzx": 50, "zzzzzw": 50, "\U00010400bcdef": 7, "bcdef": 35, "￿bcdef": 35, "lonely": 9}
    got = result(spelling.spelling_variants(words(spark, n_of)))
    assert got == brute(n_of)
    assert got["aabbbbb"][1] == "aaaaaa" and got["zzzzzy"][0] == "zzzzzw" and got["lonely"] == (None, "lonely", 9, 0, None)


def counted(rows, every):
    n_of = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n_of[run] += 1
    return {w: n for w, n in n_of.items() if len(w) >= 6 and n >= 5}


def test_words_are_counted_over_whole_texts(spark, docs, no_docs):  # noqa: F811
    table = read_table(spark, SF001, "documents")
    extra = spark.createDataFrame([(1, "ÉCOLES École écoles straße" * 3), (None, "ÀÉÎÕÜ×÷ÿ " * 6), (2, None), (2, "")],
                                  "doc_id long, text string")
    for df in (table.select("doc_id", "text").unionByName(extra), docs):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        for every in (spelling.EDIT_EVERY, 3, None):
            got = {r.word: r.n for r in spelling.count_words(df, edit_every=every).collect()}
            assert got == counted(rows, every)
    assert spelling.group_spellings(no_docs).count() == 0
    clashing = docs.selectExpr("*", "1 as n", "'x' as word", "'y' as prefix", "'z' as whole")
    assert result(spelling.group_spellings(clashing)) == brute(counted([(r.doc_id, r.text) for r in docs.collect()], 199))


def test_query_equals_its_sql_and_brute_force(spark):
    got = result(queries.QUERIES["op12_spelling_variants"](spark, SF001))
    duckdb.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    sql = duckdb.execute(queries.ORACLE_SQL["op12_spelling_variants"]).fetchall()
    assert {w: (f, r, n, k, m) for w, f, r, n, k, m in sql} == got
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF001, "documents").select("doc_id", "text").collect()]
    assert got == brute(counted(rows, spelling.EDIT_EVERY))
    assert any(v[0] for v in got.values())
