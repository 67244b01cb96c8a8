"""Footers of many files: one job, Spark's own schemas, a table kept beside the lake."""

import datetime as dt
import uuid
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import SF001
from farelens.sources import footers, io
from farelens.sources.fixtures import raw_trips


def folder(scratch_root, name):
    return f"{scratch_root}/{name}/{uuid.uuid4().hex}"


def jobs_of(spark, fn):
    tag = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(tag, tag)
    out = fn()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, n


def test_forty_files_take_at_most_three_jobs(spark, scratch_root):
    base = folder(scratch_root, "forty")
    raw = raw_trips(spark, SF001)
    raw.repartition(38).write.parquet(f"{base}/2024-01")
    raw.limit(20).withColumn("VendorID", raw["VendorID"].cast("long")).repartition(2).write.parquet(f"{base}/2024-02")
    (scan, n), jobs = jobs_of(spark, lambda: io.scan_raw(spark, base))
    assert len(io.data_files(spark, base)) == 40 and jobs <= 3
    assert n == scan.count() == raw.count() + 20


def test_schemas_are_those_that_spark_reads(spark, scratch_root, tmp_path):
    when = dt.datetime(2024, 1, 2, 3, 4, 5)
    table = pa.table({
        "i8": pa.array([1], pa.int8()), "u8": pa.array([1], pa.uint8()), "u16": pa.array([1], pa.uint16()),
        "u32": pa.array([1], pa.uint32()), "u64": pa.array([1], pa.uint64()), "f": pa.array([1.5], pa.float32()),
        "local": pa.array([when], pa.timestamp("us")), "utc": pa.array([when], pa.timestamp("us", "UTC")),
        "ms": pa.array([when], pa.timestamp("ms")), "d": pa.array([when.date()], pa.date32()),
        "dec": pa.array([Decimal("1.20")], pa.decimal128(12, 2)), "s": ["x"], "b": [b"x"], "l": [[1, 2]],
        "st": [{"a": 1, "b": "x"}], "dict": pa.array(["k"]).dictionary_encode(), "large": pa.array(["y"], pa.large_string())})
    pq.write_table(table, tmp_path / "arrow.parquet")
    pq.write_table(table.select(["local", "s"]), tmp_path / "old.parquet", use_deprecated_int96_timestamps=True)
    spark.range(3).selectExpr("id", "cast(id as short) s", "map('k', id) m", "current_timestamp() t").write.parquet(
        str(tmp_path / "by_spark"))
    rows = footers.read_footers(spark, str(tmp_path)).collect()
    assert len(rows) >= 3
    for r in rows:
        assert r.error is None and r.schema == spark.read.parquet(r.path).schema.json(), r.path
        assert r.row_count == spark.read.parquet(r.path).count() and r.length > 0
    pq.write_table(pa.table({"n": np.array(["2024-01-01"], "datetime64[ns]")}), tmp_path / "nano.parquet", version="2.6")
    nano = footers.read_footers(spark, str(tmp_path / "nano.parquet")).first()
    assert nano.schema is None and nano.row_count == 1


def test_files_that_are_no_parquet_are_named(spark, scratch_root, tmp_path):
    raw_trips(spark, SF001).coalesce(1).write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad.parquet").write_bytes(b"not a parquet file")
    (tmp_path / "cut.parquet").write_bytes(b"PAR1 cut off")
    (tmp_path / "empty.parquet").write_bytes(b"")                    # passed over, as in Spark's own scans
    rows = {r.path.rsplit("/", 1)[1]: r for r in footers.read_footers(spark, str(tmp_path)).collect()}
    assert rows["bad.parquet"].error and rows["cut.parquet"].error
    assert sum(r.error is None for r in rows.values()) == 1
    with pytest.raises(io.SchemaMismatch, match="bad.parquet"):
        io.read_raw(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        io.schema_groups(spark, footers=spark.createDataFrame([], footers.FOOTERS))


def test_kept_footers_read_new_and_changed_files_only(spark, scratch_root, tmp_path):
    lake, raw = folder(scratch_root, "kept"), raw_trips(spark, SF001).coalesce(1)
    for month in ("2024-01", "2024-02"):
        raw.write.parquet(str(tmp_path / month))
    kept = f"{lake}/{footers.KEPT}"
    assert footers.keep_footers(spark, lake, str(tmp_path)).count() == 2
    assert footers.keep_footers(spark, lake, str(tmp_path)).count() == 2
    assert spark.read.parquet(kept).count() == 2                     # nothing was read again
    raw.limit(5).write.mode("overwrite").parquet(str(tmp_path / "2024-02"))
    raw.write.parquet(str(tmp_path / "2024-03"))
    now = footers.keep_footers(spark, lake, str(tmp_path))
    assert now.count() == 3 and spark.read.parquet(kept).count() == 4
    scan, n = io.scan_raw(spark, str(tmp_path), footers=now)
    assert n == scan.count() == 2 * raw.count() + 5


def test_other_stores_are_read_by_spark(spark, tmp_path, monkeypatch):
    raw_trips(spark, SF001).coalesce(1).write.parquet(str(tmp_path / "m"))
    (tmp_path / "bad.parquet").write_bytes(b"no")
    by_tasks = {r.path: (r.schema, r.row_count, r.error is None) for r in footers.read_footers(spark, str(tmp_path)).collect()}
    monkeypatch.setattr(footers, "SCHEMES", ())
    by_spark = {r.path: (r.schema, r.row_count, r.error is None) for r in footers.read_footers(spark, str(tmp_path)).collect()}
    assert by_tasks == by_spark
