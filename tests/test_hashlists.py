"""Primary key check by compressed hash lists, and keys above the broadcast threshold."""

import uuid

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelens.operators import checks, hashlists, keys


@given(st.integers(1, 5000), st.data())
@settings(max_examples=150, deadline=None)
def test_lists_round_trip(space, data):
    values = np.array(sorted(data.draw(st.sets(st.integers(0, space - 1), min_size=1, max_size=200))), dtype=np.int64)
    assert (hashlists.decode(hashlists.encode(values, space), len(values), space) == values).all()


def test_a_sound_row_costs_less_than_two_bytes():
    rng = np.random.default_rng(1)
    for tasks in (1, 8, 100):               # of a table of 2 million rows
        n = 2_000_000 // tasks
        space = 2_000_000 * hashlists.SPARSE
        values = np.unique(rng.integers(0, space, n))
        bits = hashlists.encode(values, space)
        assert len(bits) < 2 * n and (hashlists.decode(bits, len(values), space) == values).all()


def offenders(df, ks):
    return {tuple(r) for r in df.groupBy(*ks).count().collect() if r[-1] > 1 or any(v is None for v in r[:-1])}


@pytest.mark.parametrize("most", [checks.MOST_REPEATED, 0])
def test_check_equals_plain_grouping(spark, monkeypatch, most):
    monkeypatch.setattr(hashlists, "TOGETHER", 300)
    unique = spark.range(3000, numPartitions=7).select("id", F.lit(1.5).alias("x"))
    some = unique.unionByName(unique.filter("id % 100 = 7")).unionByName(unique.filter("id = 5").select("id", F.lit(None).alias("x")))
    hot = some.unionByName(spark.range(2000, numPartitions=3).select(F.lit(77).cast("long").alias("id"), F.lit(2.5).alias("x")))
    nulls = hot.unionByName(spark.range(9).select(F.lit(None).cast("long").alias("id"), F.lit(1.0).alias("x")))
    for df in (unique, some, hot, nulls, nulls.withColumn("hash", F.lit("x")), unique.limit(0)):
        for ks in (["id"], ["id", "x"]):
            assert {tuple(r) for r in checks.check_pk(df, ks, most_repeated=most).collect()} == offenders(df, ks)


def test_keys_of_any_name(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (4, 2)], "`hash` long, twice long")
    assert [tuple(r) for r in checks.check_pk(df, ["hash"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in checks.check_pk(df, ["twice"]).collect()] == [(2, 2)]
    assert checks.check_pk(df, ["hash", "twice"]).count() == 0


def test_a_wrong_row_count_only_costs_bytes(spark):
    df = spark.range(2000).unionByName(spark.range(5))
    for rows in (1, 10, 10**9):
        assert {r.id for r in checks.check_pk(df, ["id"], rows=rows).collect()} == set(range(5))


def test_only_rows_with_a_repeated_hash_are_grouped(spark, scratch_root):
    df = spark.range(20_000).unionByName(spark.range(3))
    plan = checks.check_pk(df, ["id"])
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    cuts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    space = hashlists.space_for(20_003, cuts)
    found = hashlists.repeated_hashes(df.select(hashlists.hash_of(["id"], cuts, space)), cuts, space).count()
    assert 3 <= found < 20_003 / hashlists.SPARSE * 1.5


def test_numbering_moves_no_row_above_the_broadcast_threshold(spark, scratch_root):
    path = f"{scratch_root}/keys/{uuid.uuid4().hex}"
    spark.range(50_000, numPartitions=6).select("id", F.lit("x" * 20).alias("trip")).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        got = keys.assign_dense_id(spark, path)
        text = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
        assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
        lines = text.splitlines()
        assert not any("trip" in lines[i + 1] for i, line in enumerate(lines) if line.startswith("(") and "Exchange" in line)
        assert sorted(r.trip_id for r in got.select("trip_id").collect()) == list(range(1, 50_001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
