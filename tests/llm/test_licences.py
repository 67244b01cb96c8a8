"""Licence scan against plain searches."""

import re
import time

import numpy as np

from llm_support import LONG, SF001, docs, no_docs  # noqa: F401
from farelens.llm import licences, queries
from farelens.llm.common import read_table

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_base(text, base=licences.BASE):
    seq, places, labels = words(text), [], set()
    for phrase, label in base:
        want = words(phrase)
        at = [i for i in range(len(seq) - len(want) + 1) if seq[i:i + len(want)] == want]
        places += at
        labels |= {label} if at else set()
    return len(seq), len(places), min(places, default=None), max(places, default=None), sorted(labels)


def base_of(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], list(r["base_labels"])


TRICKY = [None, "", "CC BY", "cc-by-nc 4.0 CC BY", "ccby", "General  Public\nLICENSE general public license", "ALL RIGHTS RESERVED.",
          "all rightsKeserved all rights reserved", "cc é by", "ccé by cc byé", "İcc by", "all all rights reserved reserved cc cc by by",
          "GNU Lesser General Public License", "a" * 5000, "0 9 az \u0080 ߿"]


def test_words_and_base_places_equal_a_plain_search(spark):
    scanner = licences.Scanner(licences.BASE, licences.TEMPLATES)
    rng = np.random.default_rng(3)
    bits = ["cc", "by", "CC BY", "general", "public", "license", "all", "rights", "reserved", "Reserved.", "x", "é", "-", "the mit"]
    texts = TRICKY + [" ".join(rng.choice(bits, rng.integers(1, 30))) for _ in range(1500)]
    for text in texts:
        assert base_of(scanner.scan((text or "").encode())) == brute_base(text), text
    other = (("b", "one"), ("a b a", "two"), ("b a", "three"), ("a b", "four"))      # phrases in each other, one word long
    scanner = licences.Scanner(other, (("t", "a b a b c"),))
    for _ in range(500):
        text = " ".join(rng.choice([*"abcx"], rng.integers(0, 12)))
        assert base_of(scanner.scan(text.encode())) == brute_base(text, other), text


def test_matching_statistics_equal_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        sequences = [rng.integers(0, 3, rng.integers(1, 9)).tolist() for _ in range(4)]
        automaton, everywhere = licences.Automaton(sequences), None
        everywhere = automaton.all_places()
        assert len(automaton.next) <= 2 * sum(map(len, sequences)) + 1
        text = rng.integers(0, 3, 30).tolist()
        state = size = 0
        for at, word in enumerate(text, 1):
            while state and word not in automaton.next[state]:
                state = automaton.link[state]
                size = automaton.length[state]
            if word in automaton.next[state]:
                state, size = automaton.next[state][word], size + 1
            ends = {m: {(k, e) for k, s in enumerate(sequences) for e in range(m, len(s) + 1) if s[e - m:e] == text[at - m:at]}
                    for m in range(1, at + 1)}
            longest = max((m for m, e in ends.items() if e), default=0)
            assert size == longest
            if size:
                assert sorted(set(everywhere[state])) == sorted(ends[size])
                assert len(everywhere[state]) == len(set(everywhere[state]))


def labels(text, **kw):
    return licences.Scanner(licences.BASE, licences.TEMPLATES, **kw).scan(text.encode())


def test_every_template_is_found_and_survives_small_edits():
    for number, (label, text) in enumerate(licences.TEMPLATES):
        whole = labels("Some words before. " + text + " And some behind.")
        spans = [s for s in whole["spans"] if s["template"] == number]
        n = len(words(text))
        assert [(s["first_word"], s["end_word"], s["coverage"]) for s in spans] == [(3, 3 + n, 1.0)], text
        assert label in whole["labels"] and whole["score"] == 1.0
        if n >= 20:
            seq = words(text)
            seq[n // 2:n // 2 + 1] = ["otherwise", "than"]         # a word replaced by two
            del seq[n // 3]
            assert label in labels(" ".join(seq))["labels"]
            assert label not in labels(" ".join(seq[:n // 3]))["labels"] or label in dict(licences.BASE).values()
    twice = labels((licences.TEMPLATES[3][1] + " ") * 2)["spans"]
    assert sum(s["template"] == 3 and s["coverage"] == 1.0 for s in twice) == 2


def test_plain_prose_has_no_label():
    for text in (LONG, "The license plate of the car was made available in the public domain of the city.",
                 "You may not use this file. Permission is granted to leave, subject to the rules, without any warranty.",
                 "He reserved all rights to speak in general; the public knew the licence under the terms of the club."):
        assert labels(text)["labels"] == [] and labels(text)["score"] == 0


def test_long_texts_of_licence_words_take_linear_time():
    scanner = licences.Scanner(licences.BASE, licences.TEMPLATES)
    taken = []
    for n in (200, 1600):
        text = (" ".join(t for _, t in licences.TEMPLATES) + " all rights reserved " * 50) * (n // 100)
        began = time.process_time()
        scanner.scan(text.encode())
        taken.append(time.process_time() - began)
    assert taken[1] < 8 * taken[0] * 3


def test_operator_on_tables(spark, docs, no_docs):  # noqa: F811
    table = read_table(spark, SF001, "documents")
    for df in (table, docs, docs.selectExpr("*", "1 as n_words", "'x' as labels", "'y' as spans")):
        want = sorted((str(r.doc_id), *brute_base(r.text)) for r in df.select("doc_id", "text").collect())
        got = licences.scan_licences(df).collect()
        assert sorted((str(r.doc_id), *base_of(r.asDict())) for r in got) == want
        assert all(set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1 for r in got)
    assert licences.scan_licences(no_docs).count() == 0
    out = queries.QUERIES["op13_license_scan"](spark, SF001)
    lines = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
             "GNU General Public License, version 3.": "gpl-3.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc"}
    by_id = {r.doc_id: r for r in out.collect()}
    for r in table.select("doc_id", "text").collect():
        found = by_id[r.doc_id].labels.split(",") if by_id[r.doc_id].labels else []
        for line, label in lines.items():
            assert (line in (r.text or "")) <= (label in found)
        if not any(w in (r.text or "").lower() for w in ("licen", "rights reserved", "public domain", "cc by")):
            assert found == []
