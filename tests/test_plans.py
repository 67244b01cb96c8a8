"""Physical plans: pushdown, pruning, partial aggregation, no Python in the hot path."""

import uuid

import pytest

from conftest import SF001
from farelens.functions.features import add_features
from farelens.operators import dims, quality
from farelens.plans import views as V
from farelens.plans.fact import build_fact
from farelens.plans.registry import all_queries
from farelens.sources import io
from farelens.sources.fixtures import raw_trips


WRITING = ("land_raw_roundtrip", "scan_raw_mixed_months", "land_raw_extra_column", "land_raw_two_months",
           "fact_date_range", "fact_reload_rerun", "fact_table_roundtrip", "assign_trip_id", "etl_run_kpi",
           "stream_fact_load", "dim_payment_upsert")


def plan_of(df) -> str:
    """Formatted explain text (full metadata, unlike the plan's toString)."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def raw_path(spark, scratch_root):
    path = f"{scratch_root}/plans/{uuid.uuid4().hex}/raw"
    raw_trips(spark, SF001).drop("trip_key").write.parquet(path)
    return path


@pytest.fixture(scope="module")
def fact_path(spark, scratch_root):
    path = f"{scratch_root}/plans/{uuid.uuid4().hex}/fact"
    io.write_fact_parquet(build_fact(raw_trips(spark, SF001)), path)
    return path


def test_quality_rules_reach_the_parquet_scan(spark, raw_path):
    clean = quality.quality_filter(add_features(io.read_raw(spark, raw_path)))
    plan = plan_of(clean)
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "GreaterThan(total_amount,0.0)" in pushed
    assert "GreaterThanOrEqual(trip_distance,0.0)" in pushed
    assert "LessThan(trip_distance,100.0)" in pushed
    assert "codegen id" in plan
    # The rounded speed is computed once in the filter, not once per test.
    condition = plan[plan.index("Condition"):].split("\n")[0]
    assert condition.count("round(") == 1


def test_view_reads_only_needed_columns(spark, fact_path):
    fact = io.read_fact_parquet(spark, fact_path)
    plan = plan_of(V.v_trips_by_time_of_day(fact))
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    for col in ["time_of_day", "total_amount", "trip_distance", "trip_duration_min"]:
        assert col in schema
    for col in ["payment_type", "vendor_name", "pickup_datetime", "tip_amount"]:
        assert col not in schema


def test_partial_aggregation_before_shuffle(spark, fact_path):
    """Every view aggregates map-side and never sort-merges or sort-aggregates trips."""
    fact = io.read_fact_parquet(spark, fact_path)
    dims_ = {"dim_payment_type": dims.dim_payment_type(spark), "dim_vendor": dims.dim_vendor(spark)}
    for name, df in V.build_views(fact, dims_).items():
        plan = plan_of(df)
        assert "partial_count" in plan or "partial_sum" in plan, name
        assert "SortMergeJoin" not in plan and "SortAggregate" not in plan, name


def test_dimension_join_is_broadcast_after_aggregation(spark, fact_path):
    fact = io.read_fact_parquet(spark, fact_path)
    df = V.v_payment_distribution(fact, dims.dim_payment_type(spark))
    plan = plan_of(df)
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_no_python_udf_in_any_registered_query(spark):
    for name, q in all_queries().items():
        if name in WRITING or name.startswith("sql_"):
            continue  # these write before returning; covered by their own tests
        plan = q(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas"):
            assert node not in plan, (name, node)


def test_rollup_is_one_expand_and_hash_aggregate(spark, fact_path):
    from farelens.plans.rollup import build_rollup

    plan = plan_of(build_rollup(io.read_fact_parquet(spark, fact_path)))
    assert "Expand" in plan and "HashAggregate" in plan and "SortAggregate" not in plan
    scans = [line for line in plan.splitlines() if line.startswith("(") and ") Scan parquet" in line]
    assert len(scans) == 1                                      # one pass over the fact
    assert "partial_sum" in plan                                # map-side before the shuffle


def test_a_rollup_view_builds_its_own_set_only(spark):
    plan = plan_of(all_queries()["rollup_v_kpi_summary"](spark, SF001))
    expand = next(line for i, line in enumerate(plan.splitlines())
                  if plan.splitlines()[i - 2].startswith("(") and "Expand" in plan.splitlines()[i - 2])
    assert expand.count("[") <= 3
