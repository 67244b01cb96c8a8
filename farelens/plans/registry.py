"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query starts from the whole ``events`` table through the trip fixture,
so its work grows with the data.  Queries that exercise sinks write under
the shared storage root (``spark.checkpoint.dir`` or
``spark.farelens.storage.root``) and return what they read back.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelens.functions.features import FEATURE_GROUPS, add_features
from farelens.operators import checks, dims, keys, quality
from farelens.plans import reports, rollup, tiles, views
from farelens.plans.etl import EtlConfig, extract, run_etl, stored_rejects
from farelens.plans.fact import build_fact
from farelens.plans.view_specs import SPECS
from farelens.schema import FACT_COLUMNS
from farelens.session import pin_session, storage_root
from farelens.sources import catalog, io, ledger, versions
from farelens.sources.fixtures import raw_trips
from farelens.streaming.incremental import load_batch, run_incremental_load
from farelens.streaming.windows import hours_so_far, start_hourly_windows

Query = Callable[[SparkSession, str], DataFrame]

# Views of three grouping sets of the rollup, for loads in batches (tests compare all 17).
BATCHED_VIEWS = ("v_kpi_summary", "v_avg_duration_by_hour", "v_payment_distribution")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    return raw_trips(spark, sf_dir)


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_features(_raw(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact(_raw(spark, sf_dir))


def _dims(spark: SparkSession) -> dict[str, DataFrame]:
    return {"dim_payment_type": dims.dim_payment_type(spark), "dim_vendor": dims.dim_vendor(spark)}


def _scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder under the shared root: results are read lazily, so no call may write into another's."""
    return f"{storage_root(spark)}/{what}/{uuid.uuid4().hex}"


# -- sources and sinks -------------------------------------------------------
def q_scan_raw_trips(spark, sf_dir):
    return _raw(spark, sf_dir)


def q_land_raw_roundtrip(spark, sf_dir):
    path = _scratch(spark, "lake")
    io.land_raw(_raw(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_fact_trips(spark, sf_dir):
    return _fact(spark, sf_dir)


def q_fact_reload_rerun(spark, sf_dir):
    """Full reload twice into the same place; the second run replaces the first."""
    path = _scratch(spark, "fact_parquet")
    for _ in range(2):
        io.write_fact_parquet(_fact(spark, sf_dir), path)
    return io.read_fact_parquet(spark, path)


def q_fact_table_roundtrip(spark, sf_dir):
    """Create-or-reload a catalog table at a shared location, read it back."""
    path = _scratch(spark, "fact_table")
    table = f"fact_trips_{os.path.basename(path)}"
    for _ in range(2):
        io.write_fact_table(_fact(spark, sf_dir), table, path=path)
    return spark.table(table).select(*FACT_COLUMNS)


def _absurd_amounts(spark, sf_dir) -> str:
    """Raw files in which one trip in 97 has an amount that no exact sum holds; returns their folder."""
    base, key = _scratch(spark, "absurd_amounts"), F.col("trip_key")
    absurd = (key % 97 == 5) & (key % 149 != 0) & (key % 151 != 0)
    amount = F.when(absurd, F.lit(1e11)).otherwise(F.col("total_amount"))
    io.land_raw(_raw(spark, sf_dir).withColumn("total_amount", amount).drop("trip_key"), f"{base}/raw")
    return base


def q_etl_split_rejects(spark, sf_dir):
    """One scan stores clean and rejected rows; the stored rejects by reason, beside the load's counts."""
    base = _absurd_amounts(spark, sf_dir)
    result = run_etl(spark, EtlConfig(raw_paths=[f"{base}/raw"], fact_path=f"{base}/split", keep_rejects=True), build_views=False)
    return (stored_rejects(spark, f"{base}/split").groupBy("reject_reasons", "n_failed_rules")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumns({"raw_rows": F.lit(result.raw_rows).cast("long"), "clean_rows": F.lit(result.clean_rows).cast("long")}))


def q_etl_split_kpi(spark, sf_dir):
    """Sums over the clean rows of the same load."""
    base = _absurd_amounts(spark, sf_dir)
    result = run_etl(spark, EtlConfig(raw_paths=[f"{base}/raw"], fact_path=f"{base}/split", keep_rejects=True))
    return result.views["v_kpi_summary"]


def q_land_ledger(spark, sf_dir):
    """Three files landed, one of them bad, twice: the second run copies and refuses none."""
    base, raw = _scratch(spark, "ledger"), _raw(spark, sf_dir)
    even = F.col("trip_key") % 2 == 0
    io.land_raw(raw.filter(even).drop("trip_key"), f"{base}/in/2024-01")
    io.land_raw(raw.filter(~even).withColumn("VendorID", F.col("VendorID").cast("long")), f"{base}/in/2024-02")
    io.land_raw(raw.drop("total_amount"), f"{base}/in/2024-03")
    runs = [ledger.land_new_files(spark, [f"{base}/in"], f"{base}/lake") for _ in range(2)]
    lake_rows = io.read_raw(spark, f"{base}/lake").count()
    refused = [r.reason for r in ledger.read_ledger(spark, f"{base}/lake").filter("status = 'refused'").select("reason").distinct().collect()]
    rows = [(i, run.rows, run.refused > 0, ",".join(refused), lake_rows) for i, run in enumerate(runs, 1)]
    return spark.createDataFrame(rows, "run int, rows_copied long, refused boolean, reasons string, lake_rows long")


def _three_batches(spark, sf_dir) -> dict[str, DataFrame]:
    """Three load batches, the second one twice, and the views from their stored rollups."""
    base, raw = _scratch(spark, "batches"), _raw(spark, sf_dir)
    for i in range(3):
        io.land_raw(raw.filter(F.col("trip_key") % 3 == i).drop("trip_key"), f"{base}/raw/{i}")
    for i in (0, 1, 2, 1):
        load_batch(spark, io.data_files(spark, f"{base}/raw/{i}"), i, f"{base}/fact", f"{base}/rollup")
    return rollup.views_from_rollup(rollup.merged_rollup(spark, f"{base}/rollup"), dims.dim_payment_type(spark), dims.dim_vendor(spark))


def _batched_view_query(name: str) -> Query:
    def run(spark, sf_dir):
        return _three_batches(spark, sf_dir)[name]

    run.__name__ = f"q_batched_{name}"
    return run


def q_hourly_windows(spark, sf_dir):
    """Trips per hour over the stream of raw files: closed windows as written, open ones named."""
    base, raw = _scratch(spark, "hours"), _raw(spark, sf_dir)
    first = raw.agg(F.expr("percentile_approx(lpep_pickup_datetime, 0.5)").alias("mid")).first().mid
    at = F.col("lpep_pickup_datetime")
    for i, part in enumerate((at < F.lit(first), at >= F.lit(first))):      # two deliveries, in order of time
        io.land_raw(raw.filter(part).drop("trip_key"), f"{base}/raw/{i}")
        start_hourly_windows(spark, f"{base}/raw", f"{base}/hours").awaitTermination()
    return hours_so_far(spark, f"{base}/raw", f"{base}/hours")


def q_fact_swap_reload(spark, sf_dir):
    """A fact table loaded with half the trips, then with all by a switch of versions."""
    root = _scratch(spark, "fact_versions")
    table = f"fact_versions_{os.path.basename(root)}"
    fact = build_fact(_raw(spark, sf_dir), keep=["trip_key"]).withColumn(io.PARTITION_COL, F.to_date("pickup_datetime"))
    for rows in (fact.filter("trip_key % 2 = 0"), fact):
        versions.publish(rows.drop("trip_key"), table, root, partition_by=[io.PARTITION_COL])
    return spark.table(table).select(*FACT_COLUMNS)


def q_search_path_kpi(spark, sf_dir):
    """Unqualified names resolved in the load's own database."""
    database, before = _stored_views(spark, sf_dir), spark.catalog.currentDatabase()
    catalog.use_database(spark, database)
    try:
        # Read inside the database; temp views of these names would come first.
        spark.sql("CREATE VIEW own_kpi AS SELECT * FROM " + f"{database}.v_kpi_summary")
        return spark.table("own_kpi")
    finally:
        catalog.use_database(spark, before)


def q_etl_run_kpi(spark, sf_dir):
    """The whole job: raw scan -> fact parquet (counts observed) -> rollup -> KPI view."""
    run_dir = _scratch(spark, "etl_runs")
    raw_path = f"{run_dir}/raw"
    io.land_raw(_raw(spark, sf_dir).drop("trip_key"), raw_path)
    result = run_etl(spark, EtlConfig(raw_paths=[raw_path], fact_path=f"{run_dir}/fact"))
    return result.views["v_kpi_summary"]


def q_stream_fact_load(spark, sf_dir):
    """Incremental load of landed raw files through the exactly-once file sink."""
    run_dir = _scratch(spark, "stream_runs")
    io.land_raw(_raw(spark, sf_dir).drop("trip_key"), f"{run_dir}/raw")
    run_incremental_load(spark, f"{run_dir}/raw", f"{run_dir}/fact")
    return spark.read.parquet(f"{run_dir}/fact").select(*FACT_COLUMNS)


def q_scan_raw_mixed_months(spark, sf_dir):
    """Three raw months storing codes as int, bigint and text or double; some values fit no type."""
    base = _scratch(spark, "mixed_months")
    raw = _raw(spark, sf_dir)
    key = F.col("trip_key")
    io.land_raw(raw.filter(key % 3 == 0).drop("trip_key"), f"{base}/2024-01")
    wide = raw.filter(key % 3 == 1).withColumns({
        "VendorID": F.col("VendorID").cast("long"),
        "payment_type": F.when(key % 70 == 1, F.lit(3_000_000_000)).otherwise(F.col("payment_type").cast("long"))})
    io.land_raw(wide.drop("trip_key"), f"{base}/2024-02")
    loose = raw.filter(key % 3 == 2).withColumns({
        "VendorID": F.when(key % 90 == 2, F.lit("n/a")).otherwise(F.col("VendorID").cast("string")),
        "payment_type": F.col("payment_type").cast("double")})
    io.land_raw(loose.drop("trip_key"), f"{base}/2024-03")
    return io.read_raw(spark, f"{base}/2024-01", f"{base}/2024-02", f"{base}/2024-03")


def _two_months(spark, sf_dir) -> tuple[str, str]:
    """Raw files of two months, one with a column more, as they arrive from outside."""
    base = _scratch(spark, "two_months")
    raw = _raw(spark, sf_dir)
    even = F.col("trip_key") % 2 == 0
    io.land_raw(raw.filter(even).withColumn("congestion_fee", F.col("trip_key").cast("double") / 4), f"{base}/in/2024-01")
    io.land_raw(raw.filter(~even), f"{base}/in/2024-02")
    return f"{base}/in", f"{base}/lake"


def q_land_raw_extra_column(spark, sf_dir):
    """Landing keeps a column that only one month has."""
    src, lake = _two_months(spark, sf_dir)
    extract(spark, [src], lake)
    return spark.read.option("mergeSchema", "true").parquet(lake).drop(io.LOAD_MONTH)


def q_land_raw_two_months(spark, sf_dir):
    """Landing month two, and month one again, keeps both months once."""
    src, lake = _two_months(spark, sf_dir)
    for month in ("2024-01", "2024-02", "2024-01"):
        extract(spark, [f"{src}/{month}"], lake)
    return (spark.read.parquet(lake).groupBy(F.date_format(F.col(io.LOAD_MONTH).cast("date"), "yyyy-MM").alias("load_month"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min("trip_key").alias("first_key"),
                 F.max("trip_key").alias("last_key")))


def q_fact_date_range(spark, sf_dir):
    """Days 4 to 10 of the stored fact, by partition pruning."""
    path = _scratch(spark, "fact_range")
    fact = _fact(spark, sf_dir)
    io.write_fact_parquet(fact, path)
    first = fact.agg(F.min(F.to_date("pickup_datetime")).alias("d")).first().d
    return io.read_fact_parquet(spark, path, str(first + dt.timedelta(days=3)), str(first + dt.timedelta(days=9)))


# -- quality gate ------------------------------------------------------------
def q_dq_rule_counts(spark, sf_dir):
    return quality.rule_failure_counts(_featured(spark, sf_dir))


def q_quality_filter(spark, sf_dir):
    return quality.quality_filter(_featured(spark, sf_dir)).select("trip_key", *FACT_COLUMNS)


def q_quality_rejects(spark, sf_dir):
    return (quality.quality_rejects(_featured(spark, sf_dir))
            .select("trip_key", *FACT_COLUMNS, "reject_reasons", "n_failed_rules"))


def q_etl_counts(spark, sf_dir):
    return quality.split_counts(_featured(spark, sf_dir))


# -- keys and integrity checks -------------------------------------------------
def q_assign_trip_id(spark, sf_dir):
    """Numbers the stored fact twice: dense, unique, and the same both times."""
    path = _scratch(spark, "trip_ids")
    build_fact(_raw(spark, sf_dir), keep=["trip_key"]).write.parquet(path)
    once = keys.assign_dense_id(spark, path).select("trip_key", "trip_id")
    again = keys.assign_dense_id(spark, path).select("trip_key", F.col("trip_id").alias("again"))
    moved = F.count_if(F.col("trip_id") != F.col("again"))
    return once.join(again, "trip_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("trip_id").alias("n_ids"),
        F.min("trip_id").alias("min_id"), F.max("trip_id").alias("max_id"), moved.alias("n_moved"))


def q_check_pk(spark, sf_dir):
    """Trips of one vendor that begin in the same second."""
    return checks.check_pk(_fact(spark, sf_dir), ["VendorID", "pickup_datetime"])


def q_check_pk_raw_key(spark, sf_dir):
    """A key that is far from unique and holds NULLs."""
    return checks.check_pk(_raw(spark, sf_dir), ["trip_distance", "payment_type"])


def q_check_fk_payment(spark, sf_dir):
    """Orphan codes against a dimension that lacks 5 and 6."""
    known = dims.dim_payment_type(spark).filter("payment_type < 5")
    return checks.check_fk(_fact(spark, sf_dir), "payment_type", known, "payment_type")


def q_check_fk_vendor(spark, sf_dir):
    return checks.check_fk(_fact(spark, sf_dir), "VendorID", dims.dim_vendor(spark), "vendor_id",
                           out_name="vendor_id")


def q_check_not_null(spark, sf_dir):
    return checks.null_counts(_fact(spark, sf_dir))


def q_dim_vendor_upsert(spark, sf_dir):
    offered = _fact(spark, sf_dir).select(F.col("VendorID").alias("vendor_id"), "vendor_name")
    return dims.insert_if_absent(dims.dim_vendor(spark), offered, "vendor_id")


def q_dim_payment_upsert(spark, sf_dir):
    offered = _fact(spark, sf_dir).select("payment_type", F.col("payment_type_name").alias("payment_desc"))
    # The stored dimension holds the codes below 4 so far; loaded twice, the second time in vain.
    path = _scratch(spark, "dimension")
    table = f"dim_payment_{os.path.basename(path)}"
    catalog.create_table_if_absent(dims.dim_payment_type(spark).filter("payment_type < 4"), table, path)
    for _ in range(2):
        catalog.load_dimension(offered, table, "payment_type")
    return spark.table(table)


def _feature_query(group: str) -> Query:
    cols = FEATURE_GROUPS[group]

    def run(spark, sf_dir):
        return _featured(spark, sf_dir).select("trip_key", *cols)

    run.__name__ = f"q_feat_{group}"
    return run


def _view_query(name: str) -> Query:
    def run(spark, sf_dir):
        fact = _fact(spark, sf_dir)
        if name in views.FACT_VIEWS:
            return views.FACT_VIEWS[name](fact)
        fn, dim_name = views.DIM_VIEWS[name]
        return fn(fact, _dims(spark)[dim_name])

    run.__name__ = f"q_{name}"
    return run


def _rollup_view_query(name: str) -> Query:
    def run(spark, sf_dir):
        r = rollup.build_rollup(_fact(spark, sf_dir), [rollup.SET_OF_VIEW[name]])
        return rollup.views_from_rollup(r, dims.dim_payment_type(spark), dims.dim_vendor(spark))[name]

    run.__name__ = f"q_rollup_{name}"
    return run


def _tile_query(name: str) -> Query:
    view_name, project = tiles.TILES[name]
    view_q = _view_query(view_name)

    def run(spark, sf_dir):
        return project(view_q(spark, sf_dir))

    run.__name__ = f"q_{name}"
    return run


def _stored_views(spark: SparkSession, sf_dir: str) -> str:
    """The load with stored views; returns the database that holds them."""
    run_dir = _scratch(spark, "stored_views")
    database = f"trips_{os.path.basename(run_dir)}"
    catalog.ensure_database(spark, database, f"{run_dir}/db")
    run_etl(spark, EtlConfig(raw_paths=[], fact_path=f"{run_dir}/fact", database=database),
            raw=_raw(spark, sf_dir).drop("trip_key"))
    return database


def _sql_tile_query(name: str) -> Query:
    def run(spark, sf_dir):
        return spark.sql(tiles.TILE_SQL[name].format(db=_stored_views(spark, sf_dir)))

    run.__name__ = f"q_sql_{name}"
    return run


def _sorted_view_query(name: str) -> Query:
    """A view with each row's position, so that its order is part of the result."""
    view = _view_query(name)

    def run(spark, sf_dir):
        # Rows of a sorted result count upwards through its partitions.
        placed = view(spark, sf_dir).withColumn("_at", F.monotonically_increasing_id())
        return placed.withColumn("position", F.row_number().over(Window.orderBy("_at")).cast("long")).drop("_at")

    run.__name__ = f"q_sorted_{name}"
    return run


def _report_query(name: str) -> Query:
    fn = reports.REPORTS[name]

    def run(spark, sf_dir):
        return fn(_fact(spark, sf_dir))

    run.__name__ = f"q_{name}"
    return run


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "scan_raw_trips": q_scan_raw_trips,
        "land_raw_roundtrip": q_land_raw_roundtrip,
        "scan_raw_mixed_months": q_scan_raw_mixed_months,
        "land_raw_extra_column": q_land_raw_extra_column,
        "land_raw_two_months": q_land_raw_two_months,
        "fact_date_range": q_fact_date_range,
    }
    for group in FEATURE_GROUPS:
        out[f"feat_{group}"] = _feature_query(group)
    out.update({
        "dq_rule_counts": q_dq_rule_counts,
        "quality_filter": q_quality_filter,
        "quality_rejects": q_quality_rejects,
        "etl_counts": q_etl_counts,
        "fact_trips": q_fact_trips,
        "fact_reload_rerun": q_fact_reload_rerun,
        "fact_table_roundtrip": q_fact_table_roundtrip,
        "fact_swap_reload": q_fact_swap_reload,
        "search_path_kpi": q_search_path_kpi,
        "etl_split_rejects": q_etl_split_rejects,
        "etl_split_kpi": q_etl_split_kpi,
        "land_ledger": q_land_ledger,
        "hourly_windows": q_hourly_windows,
        "etl_run_kpi": q_etl_run_kpi,
        "stream_fact_load": q_stream_fact_load,
    })
    for name in views.VIEW_NAMES:
        out[name] = _view_query(name)
    for name in views.VIEW_NAMES:
        out[f"rollup_{name}"] = _rollup_view_query(name)
    for name in BATCHED_VIEWS:
        out[f"batched_{name}"] = _batched_view_query(name)
    for name in tiles.TILES:
        out[name] = _tile_query(name)
    for name in tiles.TILES:
        out[f"sql_{name}"] = _sql_tile_query(name)
    for name, spec in SPECS.items():
        if spec.order:
            out[f"sorted_{name}"] = _sorted_view_query(name)
    for name in reports.REPORTS:
        out[name] = _report_query(name)
    out.update({
        "assign_trip_id": q_assign_trip_id,
        "check_pk": q_check_pk,
        "check_pk_raw_key": q_check_pk_raw_key,
        "check_fk_payment": q_check_fk_payment,
        "check_fk_vendor": q_check_fk_vendor,
        "check_not_null": q_check_not_null,
        "dim_vendor_upsert": q_dim_vendor_upsert,
        "dim_payment_upsert": q_dim_payment_upsert,
    })
    return out
