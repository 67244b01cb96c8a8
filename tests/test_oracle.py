"""Every registered query against its DuckDB statement (sf0.001)."""

import os
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck_connection  # noqa: E402

# The corpus queries have tests of their own.
QUERIES = {k: q for k, q in entry.queries().items() if k not in entry.CORPUS_QUERIES}
ORACLE = {k: s for k, s in entry.oracle_sql().items() if k in QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF001)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_duckdb(spark, con, key):
    res = compare(spark, con, SF001, key, QUERIES[key], ORACLE[key])
    assert res["status"] == "match", res


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert [r.time_of_day for r in rows] == ["Morning", "Afternoon", "Evening", "Night"]
    assert sum(r.trip_count for r in rows) == 879
