"""Small corpora with every awkward row, shared by the operator tests."""

import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF001 = "/root/testdata/sf0.001"

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        # Names that the operators use inside.
        "copy long, label string, node long, rep long, bucket long, score string, uid long, shard string, role int, "
        "size long, `key` string, host string, component string")
BASE = ("the quick brown fox jumps over the lazy dog and runs away from the old farm near a river "
        "where many fish swim under bridges built long ago by people who lived in small houses ")
LONG = " ".join(f"word{i % 977} line{i % 31}" for i in range(30_000))


def rows():
    texts = [
        (0, BASE * 3, "en", "s1"), (1, BASE * 3, "en", "s1"),                       # exact copies
        (2, BASE * 3 + "tail", "en", "s2"),                                         # near copy
        (3, None, "en", "s2"), (4, "", "fr", None), (5, " \n\t ", None, "s3"),       # nothing to read
        (6, "12345 !!! 678", None, "s3"),                                           # no letter
        (7, LONG, "en", "s1"), (8, "Un texte court.", "fr", "s4"),
        (9, "mail bob.smith@mail.example.com or 10.0.0.255, card 4539 1488 0343 6467", "en", "s4"),
        (10, "é" * 300, "fr", None), (11, "one two", "en", "s1"), (12, "one two", "en", "s1"),
        (12, "one two", "en", "s1"),                                                # a repeated row
        (None, "no id here", "en", "s5"), (13, "born 1984-02-29, ssn 123-45-6789, call +1 (212) 555-0147", "en", "s5"),
        (14, "xy" * 400, "fr", "s5"),                                               # repeats itself
    ]
    return [(i, t, lang, src, None if t is None else len(t), *[None] * 13) for i, t, lang, src in texts]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
