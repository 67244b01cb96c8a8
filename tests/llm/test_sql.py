"""Corpus queries against their SQL, compared as the driver does it."""

import os
import sys

import numpy as np
import pytest

from llm_support import ROOT, SF001
from farelens.llm import hnsw, queries

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import compare, duck_connection  # noqa: E402


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_matches_duckdb(spark, key):
    result = compare(spark, duck_connection(SF001), SF001, key, queries.QUERIES[key], queries.ORACLE_SQL[key])
    assert result["status"] == "match", result


@pytest.mark.parametrize("n", [2, 3, 17, 84, 130])
def test_small_shards_answer_by_their_graph(n):
    rng = np.random.default_rng(n)
    base = rng.standard_normal((max(1, n // 4), 24))
    vectors = base[rng.integers(0, len(base), n)] + rng.standard_normal((n, 24)) * rng.choice([0, .05, .25, .4], (n, 1))
    shard, unit = hnsw.Shard(np.arange(n), vectors, 0.9), hnsw.unit(vectors)
    assert shard.graph is not None
    assert (shard.answer(np.arange(n), vectors)[0] == ((unit @ unit.T) >= 0.9).sum(1) - 1).all()
