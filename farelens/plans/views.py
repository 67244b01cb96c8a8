"""The 17 reporting views, each a function ``fact -> DataFrame``.

Every view is one scan of the fact with partial (map-side) aggregation; the
shuffle after it carries one row per group per task, and the groups are
bounded by label vocabularies (4 day parts, 24 hours, 31 days, ...).  Sorts
and share-of-total windows run on the aggregated rows only.

Joined views aggregate first and join the dimension afterwards: the
dimension key is unique, so grouping by (code, description) equals grouping
by code, and the join then touches a handful of rows instead of every trip.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens import schema as S
from farelens.functions.numeric import agg2, avg2 as _avg, share_pct, sum2 as _sum


def _count() -> Column:
    return F.count(F.lit(1))


def rank_of(col: str, labels_in_order: list[str]) -> Column:
    """Sort rank of a label column; unknown labels (and NULL) sort last."""
    c = F.col(col)
    expr = None
    for i, label in enumerate(labels_in_order, start=1):
        expr = F.when(c == label, i) if expr is None else expr.when(c == label, i)
    return expr


def with_share(df: DataFrame, count_col: str, out: str = "percentage") -> DataFrame:
    """Add count / total of counts * 100 over all rows of an aggregate.

    The window has no partition key, so Spark gathers its input in one task:
    it is only ever applied to aggregated rows (one per group).
    """
    total = F.sum(F.col(count_col)).over(Window.partitionBy())
    return df.withColumn(out, share_pct(F.col(count_col), total))


# V1 -------------------------------------------------------------------------
def v_trips_by_time_of_day(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("time_of_day")
            .agg(_count().alias("trip_count"),
                 _avg("total_amount").alias("avg_fare"),
                 _avg("trip_distance").alias("avg_distance"),
                 _avg("trip_duration_min").alias("avg_duration_min"),
                 _sum("total_amount").alias("total_revenue"))
            .orderBy(rank_of("time_of_day", S.TIME_OF_DAY_LABELS).asc_nulls_last()))


# V2 -------------------------------------------------------------------------
def v_weekend_weekday_comparison(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("day_type")
            .agg(_count().alias("trip_count"),
                 _avg("total_amount").alias("avg_fare"),
                 _avg("trip_distance").alias("avg_distance"),
                 _avg("tip_percentage").alias("avg_tip_pct"),
                 _sum("total_amount").alias("total_revenue")))


# V3 -------------------------------------------------------------------------
def v_distance_category_dist(fact: DataFrame) -> DataFrame:
    agg = (fact.groupBy("distance_category")
           .agg(_count().alias("trip_count"),
                _avg("total_amount").alias("avg_fare"),
                _avg("trip_duration_min").alias("avg_duration")))
    return (with_share(agg, "trip_count")
            .select("distance_category", "trip_count", "percentage", "avg_fare", "avg_duration")
            .orderBy(rank_of("distance_category", S.DISTANCE_ORDER).asc_nulls_last()))


# V4 -------------------------------------------------------------------------
def v_fare_category_breakdown(fact: DataFrame) -> DataFrame:
    agg = (fact.groupBy("fare_category")
           .agg(_count().alias("trip_count"),
                _avg("trip_distance").alias("avg_distance"),
                _avg("tip_percentage").alias("avg_tip_pct")))
    return (with_share(agg, "trip_count")
            .select("fare_category", "trip_count", "percentage", "avg_distance", "avg_tip_pct")
            .orderBy(rank_of("fare_category", S.FARE_ORDER).asc_nulls_last()))


# V5 -------------------------------------------------------------------------
def v_avg_speed_by_hour(fact: DataFrame) -> DataFrame:
    return (fact.filter(F.col("avg_speed_mph").isNotNull())
            .groupBy("trip_hour")
            .agg(_count().alias("trip_count"),
                 _avg("avg_speed_mph").alias("avg_speed_mph"),
                 _avg("trip_duration_min").alias("avg_duration_min"))
            .orderBy(F.col("trip_hour").asc_nulls_last()))


# V6 -------------------------------------------------------------------------
def v_tip_by_payment(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("payment_type_name")
            .agg(_count().alias("trip_count"),
                 _avg("tip_percentage").alias("avg_tip_pct"),
                 _avg("tip_amount").alias("avg_tip_amount"),
                 _sum("tip_amount").alias("total_tips"))
            .orderBy(F.col("avg_tip_pct").desc_nulls_last(), F.col("payment_type_name").asc_nulls_last()))


# V7 -------------------------------------------------------------------------
def v_vendor_performance(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("vendor_name")
            .agg(_count().alias("total_trips"),
                 _avg("total_amount").alias("avg_fare"),
                 _avg("trip_distance").alias("avg_distance"),
                 _avg("avg_speed_mph").alias("avg_speed_mph"),
                 _avg("tip_percentage").alias("avg_tip_pct"),
                 _sum("total_amount").alias("total_revenue")))


# V8 -------------------------------------------------------------------------
def v_fare_efficiency(fact: DataFrame) -> DataFrame:
    return (fact.filter(F.col("fare_per_mile").isNotNull() & F.col("fare_per_minute").isNotNull())
            .groupBy("time_of_day", "day_type")
            .agg(_avg("fare_per_mile").alias("avg_fare_per_mile"),
                 _avg("fare_per_minute").alias("avg_fare_per_minute"),
                 _count().alias("trip_count"))
            .orderBy(F.col("time_of_day").asc_nulls_last(), F.col("day_type").asc_nulls_last()))


# V9 -------------------------------------------------------------------------
def v_hourly_revenue(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("trip_hour")
            .agg(_count().alias("trip_count"),
                 _sum("total_amount").alias("total_revenue"),
                 _avg("total_amount").alias("avg_fare"),
                 _sum("tip_amount").alias("total_tips"))
            .orderBy(F.col("trip_hour").asc_nulls_last()))


# V10 ------------------------------------------------------------------------
def v_daily_summary(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("trip_day")
            .agg(_count().alias("total_trips"),
                 _sum("total_amount").alias("total_revenue"),
                 _avg("total_amount").alias("avg_fare"),
                 _avg("trip_distance").alias("avg_distance"),
                 _avg("trip_duration_min").alias("avg_duration_min"))
            .orderBy(F.col("trip_day").asc_nulls_last()))


# V11 ------------------------------------------------------------------------
def v_kpi_summary(fact: DataFrame) -> DataFrame:
    """Global aggregate: always exactly one row, even over an empty fact."""
    return fact.agg(
        _count().alias("total_trips"),
        _sum("total_amount").alias("total_revenue"),
        _avg("total_amount").alias("avg_fare"),
        _avg("trip_distance").alias("avg_distance_miles"),
        _avg("trip_duration_min").alias("avg_duration_minutes"),
        _avg("avg_speed_mph").alias("avg_speed_mph"),
        _avg("tip_percentage").alias("avg_tip_percentage"),
        _sum("tip_amount").alias("total_tips"),
    )


# V12 ------------------------------------------------------------------------
def v_trips_by_hour(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("trip_hour")
            .agg(_count().alias("total_trips"),
                 _avg("trip_distance").alias("avg_distance"),
                 _avg("total_amount").alias("avg_fare"))
            .orderBy(F.col("trip_hour").asc_nulls_last()))


# V13 ------------------------------------------------------------------------
def day_name(weekday: str = "trip_weekday") -> Column:
    """Weekday number -> name; no ELSE, so anything else is NULL."""
    c = F.col(weekday)
    expr = None
    for i, name in enumerate(S.WEEKDAY_NAMES, start=1):
        expr = F.when(c == i, name) if expr is None else expr.when(c == i, name)
    return expr


def v_trips_by_weekday(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("trip_weekday")
            .agg(_count().alias("total_trips"),
                 _avg("trip_distance").alias("avg_distance"),
                 _avg("total_amount").alias("avg_fare"))
            .select("trip_weekday", day_name().alias("day_name"),
                    "total_trips", "avg_distance", "avg_fare")
            .orderBy(F.col("trip_weekday").asc_nulls_last()))


# V14 ------------------------------------------------------------------------
def v_payment_distribution(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Trips and revenue per payment code with the dimension's description.

    Codes without a dimension row (and NULL) show as 'Unknown' but stay
    separate rows, one per code.
    """
    per_code = (fact.groupBy("payment_type")
                .agg(_count().alias("total_trips"),
                     _sum("total_amount").alias("total_revenue")))
    joined = per_code.join(dim_payment, on="payment_type", how="left")
    return (with_share(joined, "total_trips")
            .select("payment_type",
                    F.coalesce(F.col("payment_desc"), F.lit(S.DIM_MISSING_LABEL)).alias("payment_desc"),
                    "total_trips", "percentage", "total_revenue")
            .orderBy(F.col("total_trips").desc_nulls_last(), F.col("payment_type").asc_nulls_last()))


# V15 ------------------------------------------------------------------------
def v_avg_duration_by_hour(fact: DataFrame) -> DataFrame:
    d = F.col("trip_duration_min")
    return (fact.filter((d > 0) & (d < S.DURATION_VIEW_MAX_MIN))
            .groupBy("trip_hour")
            .agg(_count().alias("total_trips"),
                 _avg("trip_duration_min").alias("avg_duration_min"),
                 agg2(F.min(d)).alias("min_duration_min"),
                 agg2(F.max(d)).alias("max_duration_min"))
            .orderBy(F.col("trip_hour").asc_nulls_last()))


# V16 ------------------------------------------------------------------------
def v_daily_summary_by_date(fact: DataFrame) -> DataFrame:
    return (fact.groupBy(F.to_date(F.col("pickup_datetime")).alias("trip_date"))
            .agg(_count().alias("total_trips"),
                 _sum("total_amount").alias("total_revenue"),
                 _avg("trip_distance").alias("avg_distance"),
                 _avg("trip_duration_min").alias("avg_duration_min"))
            .orderBy(F.col("trip_date").asc_nulls_last()))


# V17 ------------------------------------------------------------------------
def v_vendor_performance_by_id(fact: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    per_code = (fact.groupBy("VendorID")
                .agg(_count().alias("total_trips"),
                     _avg("trip_distance").alias("avg_distance"),
                     _avg("total_amount").alias("avg_fare"),
                     _avg("trip_duration_min").alias("avg_duration_min")))
    dim = dim_vendor.select(F.col("vendor_id").alias("VendorID"), "vendor_name")
    joined = per_code.join(dim, on="VendorID", how="left")
    return (joined
            .select(F.col("VendorID").alias("vendor_id"),
                    F.coalesce(F.col("vendor_name"), F.lit(S.DIM_MISSING_LABEL)).alias("vendor_name"),
                    "total_trips", "avg_distance", "avg_fare", "avg_duration_min")
            .orderBy(F.col("total_trips").desc_nulls_last(), F.col("vendor_id").asc_nulls_last()))


# Views over the fact alone: name -> function.
FACT_VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "v_trips_by_time_of_day": v_trips_by_time_of_day,
    "v_weekend_weekday_comparison": v_weekend_weekday_comparison,
    "v_distance_category_dist": v_distance_category_dist,
    "v_fare_category_breakdown": v_fare_category_breakdown,
    "v_avg_speed_by_hour": v_avg_speed_by_hour,
    "v_tip_by_payment": v_tip_by_payment,
    "v_vendor_performance": v_vendor_performance,
    "v_fare_efficiency": v_fare_efficiency,
    "v_hourly_revenue": v_hourly_revenue,
    "v_daily_summary": v_daily_summary,
    "v_kpi_summary": v_kpi_summary,
    "v_trips_by_hour": v_trips_by_hour,
    "v_trips_by_weekday": v_trips_by_weekday,
    "v_avg_duration_by_hour": v_avg_duration_by_hour,
    "v_daily_summary_by_date": v_daily_summary_by_date,
}

# Views that join a dimension: name -> (function, dimension name).
DIM_VIEWS = {
    "v_payment_distribution": (v_payment_distribution, "dim_payment_type"),
    "v_vendor_performance_by_id": (v_vendor_performance_by_id, "dim_vendor"),
}

VIEW_NAMES = list(FACT_VIEWS) + list(DIM_VIEWS)


def build_views(fact: DataFrame, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All 17 views over one fact DataFrame."""
    out = {name: fn(fact) for name, fn in FACT_VIEWS.items()}
    for name, (fn, dim_name) in DIM_VIEWS.items():
        out[name] = fn(fact, dims[dim_name])
    return out
