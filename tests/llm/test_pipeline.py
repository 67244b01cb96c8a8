"""The pipeline's stages, each judged on its own input."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from llm_support import SF001, docs, no_docs  # noqa: F401
from farelens.llm.common import materialize, read_table
from test_dedup_operators import brute_components
from test_native_operators import reference_targets
from test_text_operators import token_ids

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def stages(spark):
    tables = [read_table(spark, SF001, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SF001), f"test_{name}"))
    return tables


def test_columns_and_names(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "pii", "mix_sources", "pack"]
    for table in stages[1:-1]:
        assert table.dtypes == stages[0].dtypes


def test_language_stage_keeps_clean_documents(stages):
    assert stages[1].count() == stages[0].count()


def test_near_duplicate_stage_keeps_one_of_each(stages):
    want, _ = brute_components([(r.doc_id, r.text) for r in stages[1].collect()])
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(set(want.values()))


def test_pii_stage_changes_only_personal_data(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    for r in stages[3].collect():
        old = before[r.doc_id]
        assert r.n_chars == len(r.text)
        if not re.search(r"@|\d", old.text):
            assert r.text == old.text
        for value in re.findall(r"[\w.]+@[\w.]+\w|(?:\d{1,3}\.){3}\d{1,3}|\(\d{3}\) \d{3}-\d{4}", old.text):
            assert value not in r.text


def test_mix_stage_meets_targets(stages):
    sizes, got = Counter(), Counter()
    for r in stages[3].collect():
        sizes[r.source] += len(WORD.findall(r.text))
    for r in stages[4].collect():
        got[r.source] += len(WORD.findall(r.text))
    for source, target in reference_targets(dict(sizes)).items():
        assert target - 1 <= got[source] <= target + 1e-6


def test_pack_stage_covers_every_text(stages):
    # Passes of a document are packed one by one; ids are checked by copies.
    texts = [(r.doc_id, r.text) for r in stages[4].collect()]
    once = Counter(d for d, _ in texts)
    pieces = stages[5].collect()
    single = {d for d, n in once.items() if n == 1}
    assert {p.doc_id for p in pieces} == set(once)
    check = [p for p in pieces if p.doc_id in single]
    want = {d: len(token_ids(t)) for d, t in texts if d in single}
    got = Counter()
    for p in check:
        got[p.doc_id] += p.length
    assert got == want


def test_run_equals_the_stages(spark, stages):
    run = corpus_pipeline.run(spark, SF001)
    assert sorted((r.doc_id, r.doc_tokens) for r in run.filter("start = 0").collect()) == \
        sorted((r.doc_id, r.doc_tokens) for r in stages[5].filter("start = 0").collect())


def test_awkward_rows_pass_all_stages(spark, docs, no_docs):  # noqa: F811
    for table, some in ((docs, True), (no_docs, False)):
        for _, stage in corpus_pipeline.STAGES:
            table = materialize(stage(spark, table, ""), "test_awkward")
            assert bool(table.count()) == some
