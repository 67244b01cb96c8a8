"""Licence scan: matching statistics of a generalised suffix automaton, chained to template spans.

One automaton holds all factors of all templates, word by word.  Streaming a
text through it gives at each word the longest factor that ends there (the
matching statistics) and with it every base phrase that ends there.  Where a
factor of ``MIN_MATCH`` words or more cannot grow, its places in the templates
are noted; matches that lie in one order in text and template are chained,
and a chain that covers enough of its template is a span with its label.

Words outside the templates, and pairs of words that no template holds next
to each other, end every factor, so only the stretches between them are
streamed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases whose every place counts, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# (label, text) of notices; several may share a label.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "This project is distributed under the terms of the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                   "implied. See the License for the specific language governing permissions and limitations under the "
                   "License."),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("bsd", "Licensed under the BSD License"),
    ("bsd", "Licensed under the BSD 3 Clause License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met: Redistributions of source code must retain the above copyright notice, "
            "this list of conditions and the following disclaimer."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "Licensed under the Mozilla Public License, Version 2.0"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("epl", "made available under the terms of the Eclipse Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software"),
    ("cc0", "dedicated to the public domain under the CC0 1.0 Universal license"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "licensed under a Creative Commons Attribution NoDerivatives 4.0 International License"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
)
# Words of a match from which it counts towards a template.
MIN_MATCH = 3
# Words of the text that may lie between two matches of one span.
MAX_GAP = 32
# Part of a template's words that a span must cover.
COVER = 0.75
# The automaton is sent to every task: templates beyond this are an error.
MOST_WORDS = 200_000

_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_AS_WORDS = bytes(0x20 if b in set(_SEPARATORS) else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

_OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, score double, "
        "spans array<struct<label:string,template:int,first_word:long,end_word:long,coverage:double>>")


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of digits, letters a-z (A-Z lower-cased) and bytes of other characters."""
    return text.translate(_AS_WORDS).split()


class Automaton:
    """Generalised suffix automaton over word numbers."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[list[tuple[int, int]]] = [[]]      # (sequence, words read) at which the state ends
        for number, words in enumerate(sequences):
            last = 0
            for at, word in enumerate(words, 1):
                last = self._extend(last, word)
                self.places[last].append((number, at))

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.places.append([])
        return len(self.next) - 1

    def _split(self, p: int, word: int) -> int:
        """The state of exactly the strings of ``p`` followed by ``word``."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:                          # an earlier sequence begins or goes on like this one
            return self._split(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word)
        return new

    def all_places(self) -> list[list[tuple[int, int]]]:
        """Every place at which each state's strings end: its own and those of the states linked to it."""
        out = [list(p) for p in self.places]
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            out[self.link[state]].extend(out[state])
        return out

    def find(self, words: Sequence[int]) -> int:
        state = 0
        for word in words:
            state = self.next[state][word]
        return state


@dataclass
class Scanner:
    """The automaton with all that a scan of texts needs; bounded by the templates."""

    base: Sequence[tuple[str, str]]
    templates: Sequence[tuple[str, str]]
    min_match: int = MIN_MATCH
    max_gap: int = MAX_GAP
    cover: float = COVER
    vocabulary: dict[bytes, int] = field(init=False)

    def __post_init__(self):
        texts = [words_of(t.encode("utf-8")) for t in [*(t for _, t in self.templates), *(p for p, _ in self.base)]]
        if any(not t for t in texts):
            raise ValueError("a template or phrase without words")
        if sum(map(len, texts)) > MOST_WORDS:
            raise ValueError(f"templates of more than {MOST_WORDS} words")
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        numbered = [[self.vocabulary[w] for w in t] for t in texts]
        n = len(self.vocabulary)
        self.pairs = np.array(sorted({a * n + b for t in numbered for a, b in zip(t, t[1:])}), dtype=np.int64)
        self.single = {t[0]: k for k, t in enumerate(numbered[len(self.templates):]) if len(t) == 1}
        self.automaton = Automaton(numbered)
        self.sizes = [len(t) for t in numbered[:len(self.templates)]]
        places = self.automaton.all_places()
        # Places in templates, for factors long enough to count.
        self.places = [[(t, e) for t, e in p if t < len(self.sizes)] if self.automaton.length[s] >= self.min_match else []
                       for s, p in enumerate(places)]
        self.places[0] = []
        # Base phrases that end with a state's strings: (words, phrase).
        self.phrases: list[tuple[tuple[int, int], ...]] = [()] * len(places)
        own = defaultdict(list)
        for k, t in enumerate(numbered[len(self.templates):]):
            own[self.automaton.find(t)].append((len(t), k))
        for s in sorted(range(1, len(places)), key=lambda s: self.automaton.length[s]):
            self.phrases[s] = (*self.phrases[self.automaton.link[s]], *own[s])

    def stretches(self, words: list[bytes]) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Word numbers and the stretches of two or more words whose neighbours are neighbours in a template."""
        get, n = self.vocabulary.get, len(self.vocabulary)
        ids = np.array([get(w, -1) for w in words], dtype=np.int64)
        if len(ids) < 2 or not len(self.pairs):
            return ids, []
        code = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * n + ids[1:], -1)
        held = self.pairs[np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)] == code
        edges = np.flatnonzero(np.diff(np.concatenate([[False], held, [False]]).astype(np.int8)))
        return ids, [(int(s), int(e) + 1) for s, e in zip(edges[::2], edges[1::2])]

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        ids, stretches = self.stretches(words)
        following, link, length = self.automaton.next, self.automaton.link, self.automaton.length
        n_base, first, last, base = 0, None, None, set()
        matches: dict[int, list[tuple[int, int, int]]] = defaultdict(list)     # template: (text end, template end, words)
        for word, k in self.single.items():                                    # phrases of one word need no automaton
            at = np.flatnonzero(ids == word)
            if len(at):
                n_base += len(at)
                first = int(at[0]) if first is None else min(first, int(at[0]))
                last = int(at[-1]) if last is None else max(last, int(at[-1]))
                base.add(self.base[k][1])
        for start, end in stretches:
            state = size = 0
            seen = ids[start:end].tolist()
            for at, word in enumerate(seen, start + 1):
                while state and word not in following[state]:
                    state = link[state]
                    size = length[state]
                state, size = following[state][word], size + 1
                for m, k in self.phrases[state]:
                    if 1 < m <= size:
                        n_base += 1
                        first = at - m if first is None else min(first, at - m)
                        last = at - m if last is None else max(last, at - m)
                        base.add(self.base[k][1])
                if size >= self.min_match and (at == end or seen[at - start] not in following[state]):
                    for t, e in self.places[state]:
                        matches[t].append((at, e, size))
        spans = [s for t, found in matches.items() for s in self.chains(t, found)]
        spans.sort(key=lambda s: (s["first_word"], s["end_word"], s["template"]))
        labels = base | {s["label"] for s in spans}
        score = 1.0 if base else max((s["coverage"] for s in spans), default=0.0)
        return {"n_words": len(words), "n_base": n_base, "first_word": first, "last_word": last,
                "base_labels": sorted(base), "labels": sorted(labels), "score": score, "spans": spans}

    def chains(self, template: int, matches: list[tuple[int, int, int]]) -> list[dict]:
        """Spans of one template: chains of matches in one order, each match in one chain.

        A match follows one that ends before it in text and template, at most
        ``max_gap`` words away in the text, so only those are looked at.
        """
        matches = sorted(matches)
        covered, before, start = [], [], []
        begin = 0
        for i, (at, e, size) in enumerate(matches):
            best, parent = size, -1
            while matches[begin][0] < at - size - self.max_gap:
                begin += 1
            for j in range(begin, i):
                p_at, p_e, _ = matches[j]
                if p_at < at and p_e < e and at - size - p_at <= self.max_gap:
                    gained = covered[j] + min(size, at - p_at, e - p_e)
                    if gained > best:
                        best, parent = gained, j
            covered.append(best)
            before.append(parent)
            start.append(at - size if parent < 0 else start[parent])
        out, used = [], set()
        enough = self.cover * self.sizes[template]
        for i in sorted((i for i, c in enumerate(covered) if c >= enough), key=lambda i: (-covered[i], matches[i][0])):
            chain, j = [], i
            while j >= 0:
                chain.append(j)
                j = before[j]
            if used.isdisjoint(chain):
                used.update(chain)
                out.append({"label": self.templates[template][0], "template": template, "first_word": start[i],
                            "end_word": matches[i][0], "coverage": covered[i] / self.sizes[template]})
        return out


def _scan(scanner: Scanner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()),
                                   ("end_word", pa.int64()), ("coverage", pa.float64())]))
        for batch in batches:
            rows = [scanner.scan(text.as_py() or b"") for text in batch.column("text")]
            kinds = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
                     "base_labels": pa.list_(pa.string()), "labels": pa.list_(pa.string()), "score": pa.float64(), "spans": kind}
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([r[c] for r in rows], k) for c, k in kinds.items()]], names=["doc_id", *kinds])

    return run


def scan_licences(docs: DataFrame, base: Sequence[tuple[str, str]] = BASE, templates: Sequence[tuple[str, str]] = TEMPLATES,
                  min_match: int = MIN_MATCH, max_gap: int = MAX_GAP, cover: float = COVER) -> DataFrame:
    """Licence phrases and spans of every whole text; one row per input row.

    ``docs`` has doc_id and text; other columns are not read.  Returns doc_id,
    n_words, n_base (places of base phrases), first_word and last_word (the
    smallest and largest begin of such a place, words from 0; NULL if none),
    base_labels and labels (sorted, distinct; labels holds both kinds), score
    (1 with a base phrase, else the largest part of a template covered by a
    span) and spans (label, template number, words [first_word, end_word)).

    A NULL or empty text has no words and no labels.  Repeated rows and
    shared or NULL doc_ids are rows of their own.  Of equally good chains the
    earlier one in the text is taken.  An empty table gives no rows.  No
    shuffle; a task holds the words of one text.  Templates and phrases are
    sent to every task, ``MOST_WORDS`` words at most; one without words is an
    error.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(_scan(Scanner(tuple(base), tuple(templates), min_match, max_gap, cover)), _OUT)
