"""Cross-tokenizer alignment against byte-by-byte brute force."""

import bisect
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_support import LONG, SF001, docs, no_docs  # noqa: F401
from farelens.llm import alignment, queries
from farelens.llm.common import read_table
from farelens.llm.tokens import BYTE_CHARS

A_FILE, B_FILE = (public_tokenizers.path(f) for f in (alignment.BYTE_FILE, alignment.PIECE_FILE))
TRICKY = [None, "", " ", "a", " a", "a  b\n\n", "▁x", "x ▁", "é🙂 x<0x41>", "\0 x", "<|endoftext|>", "</s> <unk> <s>",
          "naïve ﬁ ① Ω 　  ", "the the the", "the the the", "퟿\U0010ffff", "tab\tand\r\nlines"]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    chars = {chr(c): b for b, c in BYTE_CHARS.items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)

    def tokens(text):
        if not text:
            return [], []
        enc = a.encode(" " + text, add_special_tokens=False)
        left = [(i, bytes(chars[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
            return [], []
        return left, right

    return tokens


def spans(tokens):
    ends = np.cumsum([len(x) for _, x in tokens]).tolist()
    return [(i, e - len(x), e) for (i, x), e in zip(tokens, ends)]


def brute(tokens_of, texts):
    per_doc, holds = [], Counter()
    for text in texts:
        a, b = (spans(side) for side in tokens_of(text))
        owner = {p: k for k, (_, s, e) in enumerate(b) for p in range(s, e)}
        links = [(k, o) for k, (_, s, e) in enumerate(a) for o in sorted({owner[p] for p in range(s, e)})]
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [([], []) for _ in cuts]
        for side, tokens in enumerate((a, b)):
            for i, _, e in tokens:
                groups[bisect.bisect_left(cuts, e)][side].append(str(i))
        shown = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        pairs = [(a[k][0], b[o][0]) for k, o in links]
        holds.update(set(pairs))
        per_doc.append((len(a), len(b), len(cuts), links, pairs, hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    most = defaultdict(int)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    return [(n_a, n_b, n_g, len(links), sum(holds[p] == most[p[0]] for p in pairs), sum(holds[p] for p in pairs), sha)
            for n_a, n_b, n_g, links, pairs, sha in per_doc]


DIGEST = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("hot_pairs", [alignment.HOT_PAIRS, 20])
def test_alignment_equals_brute_force(spark, plain, hot_pairs):
    texts = [r.text for r in read_table(spark, SF001, "documents").orderBy("doc_id").limit(60).collect()] + TRICKY
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in alignment.align_documents(df, A_FILE, B_FILE, hot_pairs=hot_pairs).collect()}
    for k, want in enumerate(brute(plain, texts)):
        assert tuple(got[k][c] for c in DIGEST) == want, texts[k]
    for k, text in enumerate(texts):            # the alignment itself
        r, (a, b) = got[k], map(spans, plain(text))
        assert r.a_ids == [i for i, *_ in a] and r.b_ids == [i for i, *_ in b]
        assert r.a_ends == [e for *_, e in a] and r.b_ends == [e for *_, e in b]
        assert len(r.a_linked) == len(r.b_linked) == r.n_links
        for x, y in zip(r.a_linked, r.b_linked):
            (_, s, e), (_, t, u) = a[x], b[y]
            assert s < u and t < e


def test_small_batches_give_the_same(spark, plain, monkeypatch):
    texts = [r.text for r in read_table(spark, SF001, "documents").orderBy("doc_id").limit(40).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    once = alignment.align_documents(df, A_FILE, B_FILE, whole=False).orderBy("doc_id").collect()
    monkeypatch.setattr(alignment, "TOGETHER", 1)
    assert alignment.align_documents(df, A_FILE, B_FILE, whole=False).orderBy("doc_id").collect() == once


def test_alignment_of_awkward_rows(docs, no_docs, plain):  # noqa: F811
    rows = docs.select("doc_id", "text").collect()
    got = alignment.align_documents(docs.withColumn("row", F.lit("x")).withColumn("pairs", F.lit(1)), A_FILE, B_FILE, whole=False)
    assert got.columns == ["doc_id", *DIGEST]
    want = brute(plain, [r.text for r in rows])
    assert sorted((str(r.doc_id), *[r[c] for c in DIGEST]) for r in got.collect()) == sorted(
        (str(r.doc_id), *w) for r, w in zip(rows, want))
    assert alignment.align_documents(no_docs, A_FILE, B_FILE).count() == 0
    assert max(len(r.text or "") for r in rows) == len(LONG)


def test_registered_query(spark):
    out = queries.QUERIES["op11_token_alignment"](spark, SF001)
    assert out.columns == ["doc_id", *DIGEST] and out.count() == read_table(spark, SF001, "documents").count()
