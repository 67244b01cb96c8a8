"""Incremental load: new files only, exactly once, same rows as the batch."""

import uuid

from pyspark.sql import functions as F

from conftest import SF001
from farelens.plans.fact import build_fact
from farelens.schema import FACT_COLUMNS
from farelens.sources.fixtures import raw_trips
from farelens.streaming.incremental import run_incremental_load


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_incremental_load_exactly_once(spark, scratch_root):
    base = f"{scratch_root}/stream/{uuid.uuid4().hex}"
    raw_dir, fact_path, ckpt = f"{base}/raw", f"{base}/fact", f"{base}/ckpt"
    raw = raw_trips(spark, SF001).drop("trip_key")
    day = F.dayofmonth("lpep_pickup_datetime")
    first, second = raw.filter(day <= 15), raw.filter(day > 15)

    first.write.parquet(f"{raw_dir}/part=1")
    assert run_incremental_load(spark, raw_dir, fact_path, ckpt) == first.count()
    after_first = spark.read.parquet(fact_path).select(*FACT_COLUMNS)
    assert _rows(after_first) == _rows(build_fact(first))

    assert run_incremental_load(spark, raw_dir, fact_path, ckpt) == 0   # nothing new: no change
    assert spark.read.parquet(fact_path).count() == after_first.count()

    second.write.parquet(f"{raw_dir}/part=2")
    run_incremental_load(spark, raw_dir, fact_path, ckpt)
    total = spark.read.parquet(fact_path).select(*FACT_COLUMNS)
    assert _rows(total) == _rows(build_fact(raw))


def test_one_folder_two_facts_and_mixed_codes(spark, scratch_root):
    """Each fact has its own progress; files with bigint codes load like the batch does."""
    base = f"{scratch_root}/stream/{uuid.uuid4().hex}"
    raw = raw_trips(spark, SF001).drop("trip_key")
    half = F.second("lpep_pickup_datetime") % 2 == 0
    raw.filter(half).write.parquet(f"{base}/raw/a")
    raw.filter(~half).withColumn("payment_type", F.col("payment_type").cast("long")).write.parquet(f"{base}/raw/b")
    want = _rows(build_fact(raw))
    for fact in ("one", "two"):
        assert run_incremental_load(spark, f"{base}/raw", f"{base}/{fact}") == 1_000
        assert _rows(spark.read.parquet(f"{base}/{fact}").select(*FACT_COLUMNS)) == want


def test_a_repeated_batch_replaces_itself(spark, scratch_root):
    from farelens.sources import io
    from farelens.streaming.incremental import load_batch

    base = f"{scratch_root}/stream/{uuid.uuid4().hex}"
    raw = raw_trips(spark, SF001).drop("trip_key")
    raw.write.parquet(f"{base}/raw")
    files = io.data_files(spark, f"{base}/raw")
    for batch in (0, 0, 1, 1):
        load_batch(spark, files, batch, f"{base}/fact")
    assert io.read_fact_parquet(spark, f"{base}/fact").count() == 2 * build_fact(raw).count()
