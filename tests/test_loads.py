"""Ledger and quarantine, split load, rollups by batch, hourly windows."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from farelens.operators import dims, quality
from farelens.plans import rollup
from farelens.plans.etl import EtlConfig, run_etl, stored_rejects
from farelens.plans.fact import build_fact
from farelens.plans.views import build_views
from farelens.functions.features import add_features
from farelens.sources import io, ledger
from farelens.sources.fixtures import raw_trips
from farelens.streaming import incremental, windows


def fresh(scratch_root, name):
    return f"{scratch_root}/{name}/{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def raw(spark):
    return raw_trips(spark, SF001).coalesce(1)


def rows_of(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def deliver(spark, scratch_root, df, target):
    """``df`` as one parquet file that comes from elsewhere (no checksum file beside it)."""
    aside = fresh(scratch_root, "aside")
    df.coalesce(1).write.parquet(aside)
    with open(io.data_files(spark, aside)[0].removeprefix("file:"), "rb") as f:
        target.write_bytes(f.read())


def test_ledger_copies_each_file_once_and_names_bad_ones(spark, scratch_root, raw, tmp_path):
    src, lake = str(tmp_path), fresh(scratch_root, "lake")
    deliver(spark, scratch_root, raw, tmp_path / "2024-01.parquet")
    deliver(spark, scratch_root, raw.withColumn("payment_type", F.col("payment_type").cast("long")), tmp_path / "2024-02.parquet")
    deliver(spark, scratch_root, raw.limit(9), tmp_path / "nomonth.parquet")
    (tmp_path / "2024-03.parquet").write_bytes(b"broken")
    n = raw.count()
    first = ledger.land_new_files(spark, [src], lake)
    assert (first.files, first.landed, first.refused, first.rows) == (4, 2, 2, 2 * n)
    again = ledger.land_new_files(spark, [src], lake)
    assert (again.files, again.rows) == (0, 0)
    reasons = {r.path.rsplit("/", 1)[1]: r.reason for r in ledger.read_ledger(spark, lake).filter("status = 'refused'").collect()}
    assert reasons["nomonth.parquet"] == "no month in its name" and reasons["2024-03.parquet"].startswith("no parquet file")
    assert io.read_raw(spark, lake).count() == 2 * n
    # The broken file arrives again, sound; another month's file is delivered anew.
    deliver(spark, scratch_root, raw.limit(7), tmp_path / "2024-03.parquet")
    deliver(spark, scratch_root, raw.limit(5), tmp_path / "2024-02.parquet")
    third = ledger.land_new_files(spark, [src], lake)
    assert (third.files, third.landed, third.rows) == (2, 2, 12)
    assert io.read_raw(spark, lake).count() == n + 12
    months = spark.read.parquet(lake).groupBy(io.LOAD_MONTH).count().collect()
    assert sorted(r["count"] for r in months) == [5, 7, n]


def test_stream_goes_on_behind_a_bad_file(spark, scratch_root, raw, tmp_path):
    fact = fresh(scratch_root, "quarantine")
    raw.drop("trip_key").write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad.parquet").write_bytes(b"broken")
    raw.drop("total_amount").write.parquet(str(tmp_path / "poor"))
    assert incremental.run_incremental_load(spark, str(tmp_path), fact) == raw.count()
    raw.limit(10).drop("trip_key").write.parquet(str(tmp_path / "later"))
    assert incremental.run_incremental_load(spark, str(tmp_path), fact) == 10
    reasons = sorted(r.reason.split(":")[0] for r in incremental.quarantined(spark, fact).collect())
    assert reasons == ["lacks columns total_amount", "no parquet file"]
    assert io.read_fact_parquet(spark, fact).count() > 0


def test_split_load_stores_rejects_from_one_scan(spark, scratch_root, raw):
    base = fresh(scratch_root, "split")
    raw.drop("trip_key").withColumn("total_amount", F.expr("if(trip_distance between 3 and 4, 5e11, total_amount)")).write.parquet(f"{base}/raw")
    for _ in range(2):                      # a reload replaces both parts
        got = run_etl(spark, EtlConfig(raw_paths=[f"{base}/raw"], fact_path=f"{base}/split", keep_rejects=True))
    featured = add_features(io.read_raw(spark, f"{base}/raw"))
    assert got.raw_rows == raw.count() and got.clean_rows == quality.quality_filter(featured).count()
    rejects = stored_rejects(spark, f"{base}/split")
    assert rows_of(rejects) == rows_of(quality.quality_rejects(featured).select(*rejects.columns))
    assert rejects.filter("reject_reasons = 'values_castable' or reject_reasons like '%rates_in_range'").count() > 0
    clean = io.read_fact_parquet(spark, got.fact_path)
    assert clean.count() == got.clean_rows and clean.agg(F.max("total_amount")).first()[0] < 9e10
    assert got.views["v_kpi_summary"].first().total_trips == got.clean_rows


def test_views_of_batches_equal_direct_views(spark, scratch_root, raw):
    base = fresh(scratch_root, "batches")
    for i in range(3):
        raw.filter(F.col("trip_key") % 3 == i).drop("trip_key").write.parquet(f"{base}/raw/{i}")
    for i in (0, 1, 2, 1):
        incremental.load_batch(spark, io.data_files(spark, f"{base}/raw/{i}"), i, f"{base}/fact", f"{base}/rollup")
    pay, ven = dims.dim_payment_type(spark), dims.dim_vendor(spark)
    merged = rollup.merged_rollup(spark, f"{base}/rollup")
    fact = build_fact(raw).cache()
    assert rows_of(merged) == rows_of(rollup.build_rollup(fact).select(*merged.columns))
    direct = build_views(fact, {"dim_payment_type": pay, "dim_vendor": ven})
    batched = rollup.views_from_rollup(merged, pay, ven)
    assert set(batched) == set(direct) and len(direct) == 17
    for name, view in direct.items():
        assert rows_of(batched[name]) == rows_of(view), name          # one of them has no order
    fact.unpersist()


def test_windows_close_once_and_late_trips_are_too_late(spark, scratch_root, raw):
    base = fresh(scratch_root, "windows")
    trips = raw.drop("trip_key").orderBy("lpep_pickup_datetime")
    at = F.col("lpep_pickup_datetime")
    mid = raw.agg(F.expr("percentile_approx(lpep_pickup_datetime, 0.5)").alias("m")).first().m
    for i, part in enumerate((at < F.lit(mid), at >= F.lit(mid))):
        trips.filter(part).coalesce(1).write.parquet(f"{base}/raw/{i}")
        windows.start_hourly_windows(spark, f"{base}/raw", f"{base}/hours", files_per_batch=1).awaitTermination()
    so_far = {r.hour_start: r for r in windows.hours_so_far(spark, f"{base}/raw", f"{base}/hours").collect()}
    clean = windows.clean_trips(raw).groupBy(F.date_trunc("hour", "pickup").cast("timestamp_ntz").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("total_amount").cast("decimal(20,2)")), 2).cast("double").alias("s")).collect()
    assert {r.h: (r.n, r.s) for r in clean} == {h: (r.trip_count, r.total_revenue) for h, r in so_far.items()}
    states = [so_far[h].state for h in sorted(so_far)]
    assert states == sorted(states) and states.count("open") >= 2
    before = spark.read.parquet(f"{base}/hours").count()
    assert before == states.count("closed")
    # A copy of the oldest trips comes late: their hours are closed and stay as they are.
    trips.limit(20).coalesce(1).write.parquet(f"{base}/raw/2")
    windows.start_hourly_windows(spark, f"{base}/raw", f"{base}/hours").awaitTermination()
    assert spark.read.parquet(f"{base}/hours").count() == before
