"""Views: invariants, intended ordering, rollup = direct, SQL registration."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from farelens import schema as S
from farelens.operators.dims import dim_payment_type, dim_vendor
from farelens.plans import views as V
from farelens.plans.fact import build_fact
from farelens.plans.rollup import build_rollup, views_from_rollup
from farelens.sources.fixtures import raw_trips


@pytest.fixture(scope="module")
def fact(spark):
    return build_fact(raw_trips(spark, SF01)).cache()


@pytest.fixture(scope="module")
def dims(spark):
    return {"dim_payment_type": dim_payment_type(spark), "dim_vendor": dim_vendor(spark)}


@pytest.fixture(scope="module")
def all_views(fact, dims):
    return {k: v.collect() for k, v in V.build_views(fact, dims).items()}


def test_fact_schema(fact):
    assert fact.columns == S.FACT_COLUMNS
    assert [f.dataType for f in fact.schema.fields] == [f.dataType for f in S.FACT_SCHEMA.fields]
    assert fact.count() == 8_822


def test_group_counts_sum_to_fact(all_views):
    for name, col in [("v_trips_by_time_of_day", "trip_count"), ("v_weekend_weekday_comparison", "trip_count"),
                      ("v_distance_category_dist", "trip_count"), ("v_fare_category_breakdown", "trip_count"),
                      ("v_tip_by_payment", "trip_count"), ("v_vendor_performance", "total_trips"),
                      ("v_hourly_revenue", "trip_count"), ("v_daily_summary", "total_trips"),
                      ("v_trips_by_hour", "total_trips"), ("v_trips_by_weekday", "total_trips"),
                      ("v_payment_distribution", "total_trips"), ("v_daily_summary_by_date", "total_trips"),
                      ("v_vendor_performance_by_id", "total_trips")]:
        assert sum(r[col] for r in all_views[name]) == 8_822, name


def test_shares_sum_to_100(all_views):
    for name in ["v_distance_category_dist", "v_fare_category_breakdown", "v_payment_distribution"]:
        rows = all_views[name]
        assert abs(sum(r.percentage for r in rows) - 100) <= 0.01 * len(rows), name


def test_kpi_row(all_views):
    kpi = all_views["v_kpi_summary"][0].asDict()
    assert kpi == {"total_trips": 8822, "total_revenue": 437117.83, "avg_fare": 49.55,
                   "avg_distance_miles": 7.29, "avg_duration_minutes": 31.99, "avg_speed_mph": 19.53,
                   "avg_tip_percentage": 5.74, "total_tips": 21831.62}


def test_intended_category_order(all_views):
    assert [r.time_of_day for r in all_views["v_trips_by_time_of_day"]] == S.TIME_OF_DAY_LABELS
    assert [r.distance_category for r in all_views["v_distance_category_dist"]] == S.DISTANCE_ORDER
    assert [r.fare_category for r in all_views["v_fare_category_breakdown"]] == S.FARE_ORDER


def test_payment_distribution_keeps_null_and_unknown_apart(all_views):
    rows = all_views["v_payment_distribution"]
    unknown = [r for r in rows if r.payment_desc == "Unknown"]
    assert sorted((r.payment_type is None) for r in unknown) == [False, True]
    assert [r.total_trips for r in rows] == sorted((r.total_trips for r in rows), reverse=True)


def test_vendor_by_id_orphan(all_views):
    rows = {r.vendor_id: r for r in all_views["v_vendor_performance_by_id"]}
    assert rows[6].vendor_name == "Unknown" and rows[6].total_trips == 921


def test_tip_by_payment_desc_nulls_last(all_views):
    pct = [r.avg_tip_pct for r in all_views["v_tip_by_payment"]]
    non_null = [p for p in pct if p is not None]
    assert non_null == sorted(non_null, reverse=True)
    assert pct[len(non_null):] == [None] * (len(pct) - len(non_null))


def test_hour_views_sorted_nulls_last(all_views):
    for name in ["v_avg_speed_by_hour", "v_hourly_revenue", "v_trips_by_hour", "v_avg_duration_by_hour"]:
        hours = [r.trip_hour for r in all_views[name]]
        assert hours == sorted(hours), name


def test_rollup_equals_direct(fact, dims, all_views):
    r = build_rollup(fact).cache()
    from_rollup = views_from_rollup(r, dims["dim_payment_type"], dims["dim_vendor"])
    assert set(from_rollup) == set(all_views)
    for name, df in from_rollup.items():
        got = df.collect()
        assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, all_views[name]), key=repr), name
        assert df.columns == list(all_views[name][0].asDict()) if all_views[name] else True


def test_kpi_over_empty_fact_is_one_row(fact, dims):
    empty = fact.filter(F.lit(False))
    rows = V.v_kpi_summary(empty).collect()
    assert len(rows) == 1 and rows[0].total_trips == 0 and rows[0].avg_fare is None
    r = build_rollup(empty)
    rows = views_from_rollup(r, dims["dim_payment_type"], dims["dim_vendor"])["v_kpi_summary"].collect()
    assert len(rows) == 1 and rows[0].total_trips == 0


def test_stored_views_reach_another_session(spark, fact, dims, all_views, tmp_path_factory):
    """Views of the catalog outlive the load and equal the direct ones."""
    import uuid

    from farelens.plans.etl import EtlConfig, run_etl
    from farelens.session import storage_root

    base = f"{storage_root(spark)}/t/{uuid.uuid4().hex}"
    database = f"trips_{uuid.uuid4().hex[:8]}"
    cfg = EtlConfig(raw_paths=[], fact_path=f"{base}/fact", database=database)
    for _ in range(2):                                   # a second load replaces, nothing doubles
        run_etl(spark, cfg, raw=raw_trips(spark, SF01).drop("trip_key"))
    other = spark.newSession()
    for name, want in all_views.items():
        got = other.sql(f"SELECT * FROM {database}.{name}")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want), key=repr), name
    ordered = [r.trip_hour for r in other.table(f"{database}.v_hourly_revenue").collect()]
    assert ordered == sorted(ordered)
    tips = other.sql(f"SELECT payment_type_name FROM {database}.v_tip_by_payment WHERE payment_type_name != 'Unknown'")
    assert tips.count() == 5
