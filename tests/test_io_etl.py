"""Sinks, reload idempotence, table reload, the batch job and its counts."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from farelens.plans.etl import EtlConfig, run_etl
from farelens.plans.fact import build_fact
from farelens.schema import FACT_COLUMNS, RAW_COLUMNS
from farelens.sources import io
from farelens.sources.fixtures import raw_trips


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_land_raw_roundtrip(spark, scratch_root):
    path = f"{scratch_root}/t/{uuid.uuid4().hex}/lake"
    raw = raw_trips(spark, SF001)
    io.land_raw(raw, path)
    back = spark.read.parquet(path)
    assert _rows(back) == _rows(raw)
    io.land_raw(raw, path)                 # full replace, not append
    assert spark.read.parquet(path).count() == 1_000


def test_read_raw_casts_and_checks(spark, scratch_root):
    path = f"{scratch_root}/t/{uuid.uuid4().hex}/raw"
    raw = (raw_trips(spark, SF001)
           .withColumn("payment_type", F.col("payment_type").cast("double"))
           .withColumn("tip_amount", F.when(F.col("trip_key") == 2, float("nan")).otherwise(F.col("tip_amount")))
           .withColumn("VendorID", F.when(F.col("trip_key") == 1, F.lit("bad")).otherwise(F.col("VendorID").cast("string"))))
    raw.write.parquet(path)
    got = io.read_raw(spark, path)
    assert got.columns == RAW_COLUMNS + ["uncastable"]
    assert dict(got.dtypes)["payment_type"] == "int"
    assert got.filter("uncastable = 'VendorID' and VendorID is null").count() == 1   # the bad value, not a failed job
    assert got.filter("uncastable = 'tip_amount'").count() == 1                      # NaN is no amount
    assert got.filter("uncastable <> ''").count() == 2


@pytest.mark.parametrize("column", ["total_amount", "tip_amount"])
@pytest.mark.parametrize("last", [True, False])
def test_a_month_without_a_column_is_an_error(spark, scratch_root, column, last):
    base = f"{scratch_root}/t/{uuid.uuid4().hex}"
    raw = raw_trips(spark, SF001).drop("trip_key")
    whole, poor = ("2024-01", "2024-02") if last else ("2024-02", "2024-01")
    raw.write.parquet(f"{base}/{whole}")
    raw.drop(column).write.parquet(f"{base}/{poor}")
    with pytest.raises(io.SchemaMismatch, match=column):
        io.read_raw(spark, f"{base}/{whole}", f"{base}/{poor}")
    with pytest.raises(io.SchemaMismatch):
        run_etl(spark, EtlConfig(raw_paths=[base], fact_path=f"{base}_fact"), build_views=False)


def test_months_with_different_code_types_line_up(spark, scratch_root):
    base = f"{scratch_root}/t/{uuid.uuid4().hex}"
    raw = raw_trips(spark, SF001).drop("trip_key")
    for month, kind in (("2024-01", "int"), ("2024-02", "bigint"), ("2024-03", "double")):
        raw.withColumn("payment_type", F.col("payment_type").cast(kind)).write.parquet(f"{base}/{month}")
    got = io.read_raw(spark, base).drop("uncastable")
    assert _rows(got) == _rows(raw.unionByName(raw).unionByName(raw))


def test_lake_keeps_months_and_columns(spark, scratch_root):
    from farelens.plans.etl import extract

    base = f"{scratch_root}/t/{uuid.uuid4().hex}"
    raw = raw_trips(spark, SF001)
    raw.withColumn("extra", F.lit("x")).write.parquet(f"{base}/in/trips_2024-01.parquet")
    raw.withColumn("VendorID", F.col("VendorID").cast("long")).write.parquet(f"{base}/in/trips_2024-02.parquet")
    assert extract(spark, [f"{base}/in/trips_2024-01.parquet"], f"{base}/lake").count() == 1_000
    assert extract(spark, [f"{base}/in/trips_2024-02.parquet"], f"{base}/lake").count() == 2_000
    assert extract(spark, [f"{base}/in/trips_2024-01.parquet"], f"{base}/lake").count() == 2_000
    months = {m: spark.read.parquet(f"{base}/lake/load_month={m}") for m in ("2024-01", "2024-02")}
    assert "extra" in months["2024-01"].columns and months["2024-01"].filter("extra = 'x'").count() == 1_000
    assert dict(months["2024-02"].dtypes)["VendorID"] == "bigint"
    raw.write.parquet(f"{base}/in/nameless")
    with pytest.raises(ValueError, match="month"):
        extract(spark, [f"{base}/in/nameless"], f"{base}/lake")
    assert extract(spark, [f"{base}/in/nameless"], f"{base}/lake", month="2024-03").count() == 3_000


def test_fact_parquet_rerun_is_identical(spark, scratch_root):
    path = f"{scratch_root}/t/{uuid.uuid4().hex}/fact"
    fact = build_fact(raw_trips(spark, SF001))
    io.write_fact_parquet(fact, path)
    first = _rows(io.read_fact_parquet(spark, path))
    io.write_fact_parquet(fact, path)
    second = io.read_fact_parquet(spark, path)
    assert second.columns == FACT_COLUMNS
    assert _rows(second) == first == _rows(fact)


def test_fact_partition_pruning(spark, scratch_root):
    path = f"{scratch_root}/t/{uuid.uuid4().hex}/fact"
    io.write_fact_parquet(build_fact(raw_trips(spark, SF001)), path, cluster=True)
    one_day = io.read_fact_parquet(spark, path, date_from="2024-01-05", date_to="2024-01-05")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "pickup_date" in plan
    dates = {r[0] for r in one_day.select(F.to_date("pickup_datetime")).distinct().collect()}
    assert {str(d) for d in dates} == {"2024-01-05"}


def test_dynamic_overwrite_replaces_only_loaded_dates(spark, scratch_root):
    path = f"{scratch_root}/t/{uuid.uuid4().hex}/fact"
    fact = build_fact(raw_trips(spark, SF001))
    io.write_fact_parquet(fact, path)
    total = fact.count()
    jan5 = fact.filter(F.to_date("pickup_datetime") == F.lit("2024-01-05").cast("date"))
    n5 = jan5.count()
    io.write_fact_parquet(jan5.limit(1), path, dynamic_overwrite=True)
    assert io.read_fact_parquet(spark, path).count() == total - n5 + 1


def test_table_reload_keeps_table(spark, scratch_root):
    table = f"fact_t_{uuid.uuid4().hex[:8]}"
    path = f"{scratch_root}/t/{uuid.uuid4().hex}/table"
    fact = build_fact(raw_trips(spark, SF001))
    io.write_fact_table(fact, table, path=path)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW v_dep AS SELECT COUNT(*) AS n FROM {table}")
    io.write_fact_table(fact, table, path=path)          # reload: truncate + insert
    assert spark.table(table).count() == fact.count()
    assert spark.sql("SELECT n FROM v_dep").first().n == fact.count()


def test_jdbc_options():
    opts = io.jdbc_options("jdbc:postgresql://host:5432/db", "fact_trips", "u", "p",
                           "org.postgresql.Driver", num_partitions=16)
    assert opts["truncate"] == "true" and opts["numPartitions"] == "16" and opts["dbtable"] == "fact_trips"
    assert io.jdbc_options("u", "t", "u", "p", "d")["numPartitions"] == str(io.JDBC_WRITERS)
    ranges = io.jdbc_read_options(opts, column="trip_id", bounds=(1, 10**9), partitions=64)
    assert (ranges["partitionColumn"], ranges["lowerBound"], ranges["upperBound"], ranges["numPartitions"]) == \
        ("trip_id", "1", "1000000000", "64") and ranges["dbtable"] == "fact_trips"
    with pytest.raises(ValueError):
        io.jdbc_read_options(opts)
    read = io.jdbc_read_options(opts, query="SELECT * FROM v_kpi_summary")
    assert "dbtable" not in read and "truncate" not in read and "batchsize" not in read
    assert read["query"] == "SELECT * FROM v_kpi_summary" and read["url"] == opts["url"]


def test_run_etl_counts_and_views(spark, scratch_root):
    base = f"{scratch_root}/t/{uuid.uuid4().hex}"
    src = f"{base}/src/2024-01"
    raw_trips(spark, SF01).drop("trip_key").write.parquet(src)
    cfg = EtlConfig(raw_paths=[src], fact_path=f"{base}/fact", lake_path=f"{base}/lake",
                    fact_table=f"fact_{uuid.uuid4().hex[:8]}")
    res = run_etl(spark, cfg)
    assert (res.raw_rows, res.clean_rows, res.removed_rows, res.removed_pct) == (10_000, 8_822, 1_178, 11.78)
    assert spark.read.parquet(f"{base}/lake").count() == 10_000
    assert spark.table(cfg.fact_table).count() == 8_822
    assert len(res.views) == 17
    kpi = spark.sql("SELECT * FROM v_kpi_summary").first()
    assert kpi.total_trips == 8_822 and kpi.total_revenue == 437117.83
    tiles = spark.sql("SELECT payment_type_name, avg_tip_pct, total_tips FROM v_tip_by_payment "
                      "WHERE payment_type_name != 'Unknown'").count()
    assert tiles == 5


def test_catalog_helpers(spark, scratch_root):
    from farelens.sources import catalog

    db = f"trips_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, db, location=f"{scratch_root}/t/{db}")
    catalog.ensure_database(spark, db)                      # idempotent
    current = spark.catalog.currentDatabase()
    catalog.use_database(spark, db)
    try:
        df = build_fact(raw_trips(spark, SF001))
        # Qualified: an unqualified name would also match temp views.
        assert catalog.create_table_if_absent(df, f"{db}.fact_trips") is True
        assert catalog.create_table_if_absent(df, f"{db}.fact_trips") is False
        assert spark.table(f"{db}.fact_trips").count() == df.count()
        catalog.drop_table(spark, f"{db}.fact_trips")
        assert not spark.catalog.tableExists(f"{db}.fact_trips")
    finally:
        catalog.use_database(spark, current)


def test_object_store_conf():
    from farelens.session import object_store_conf

    conf = object_store_conf("http://store:9000", "ak", "sk")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"


@pytest.mark.parametrize("cluster", [True, False, None])
def test_run_etl_counts_with_and_without_rebalance(spark, scratch_root, cluster):
    base = f"{scratch_root}/t/{uuid.uuid4().hex}"
    cfg = EtlConfig(raw_paths=[], fact_path=f"{base}/fact", cluster_fact=cluster)
    res = run_etl(spark, cfg, build_views=False, raw=raw_trips(spark, SF01).drop("trip_key"))
    assert (res.raw_rows, res.clean_rows) == (10_000, 8_822)
    back = io.read_fact_parquet(spark, cfg.fact_path)
    assert back.columns == FACT_COLUMNS
    assert _rows(back) == _rows(build_fact(raw_trips(spark, SF01)))


def test_gate_runs_before_the_rebalance(spark, scratch_root):
    from farelens.plans.etl import transform

    path = f"{scratch_root}/t/{uuid.uuid4().hex}/raw"
    raw_trips(spark, SF001).drop("trip_key").write.parquet(path)
    fact, _ = transform(io.read_raw(spark, path), cluster=True)
    plan = spark._jvm.PythonSQLUtils.explainString(fact._jdf.queryExecution(), "formatted")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "hashpartitioning(pickup_date" in plan
    assert "rangepartitioning" not in plan
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for test in ("GreaterThan(total_amount,0.0)", "GreaterThanOrEqual(trip_distance,0.0)", "LessThan(trip_distance,100.0)"):
        assert test in pushed
    # The tree is printed from the top: the gate stands below the exchange.
    tree = plan[:plan.index("\n\n")]
    assert tree.index("Exchange") < tree.index("Filter")
    lines = plan.splitlines()
    crossing = next(lines[i + 1] for i, line in enumerate(lines) if line.startswith("(") and "Exchange" in line)
    assert crossing.count("#") <= 8 and "pickup_date" in crossing


def test_date_order_is_recognised(spark):
    from farelens.plans.etl import in_date_order

    raw = raw_trips(spark, SF01)
    assert in_date_order(raw.sort("lpep_pickup_datetime"))
    assert not in_date_order(raw.repartition(16))


def test_command_line_jobs(spark, scratch_root):
    from farelens.__main__ import main

    base = f"{scratch_root}/t/{uuid.uuid4().hex}"
    raw_trips(spark, SF01).drop("trip_key").write.parquet(f"{base}/src")
    ex = main(["extract", "--src", f"{base}/src", "--lake", f"{base}/lake", "--month", "2024-01"])
    assert ex["rows"] == 10_000
    database = f"trips_{uuid.uuid4().hex[:8]}"
    ld = main(["load", "--raw", f"{base}/lake", "--fact", f"{base}/fact", "--database", database])
    assert spark.newSession().sql(f"SELECT total_trips FROM {database}.v_kpi_summary").first().total_trips == 8_822
    assert (ld["raw_rows"], ld["clean_rows"], ld["removed_rows"], ld["removed_pct"]) == (10_000, 8_822, 1_178, 11.78)
    assert io.read_fact_parquet(spark, f"{base}/fact").count() == 8_822


def test_stored_rollup_serves_views_in_a_later_read(spark, scratch_root):
    from farelens.operators.dims import dim_payment_type, dim_vendor
    from farelens.plans.rollup import read_rollup, views_from_rollup

    base = f"{scratch_root}/t/{uuid.uuid4().hex}"
    cfg = EtlConfig(raw_paths=[], fact_path=f"{base}/fact", rollup_path=f"{base}/rollup")
    res = run_etl(spark, cfg, raw=raw_trips(spark, SF01).drop("trip_key"))
    stored = read_rollup(spark, cfg.rollup_path)
    views = views_from_rollup(stored, dim_payment_type(spark), dim_vendor(spark))
    kpi = views["v_kpi_summary"].first()
    assert kpi.total_trips == 8_822 and kpi.total_revenue == 437117.83
    assert _rows(views["v_hourly_revenue"]) == _rows(res.views["v_hourly_revenue"])
