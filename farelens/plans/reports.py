"""Report analyses stated in prose (R1-R8), as queries over the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens import schema as S
from farelens.functions.numeric import agg2, avg_of, exact_sum
from farelens.functions.numeric import avg2 as _avg
from farelens.functions.numeric import sum2 as _sum
from farelens.plans.views import rank_of, v_avg_speed_by_hour, with_share


def r_time_of_day_share(fact: DataFrame) -> DataFrame:
    """R1: share of trips and average fare per day part."""
    agg = fact.groupBy("time_of_day").agg(F.count(F.lit(1)).alias("trip_count"),
                                         _avg("total_amount").alias("avg_fare"))
    return (with_share(agg, "trip_count")
            .select("time_of_day", "trip_count", "percentage", "avg_fare")
            .orderBy(rank_of("time_of_day", S.TIME_OF_DAY_LABELS).asc_nulls_last()))


def r_day_type_diff(fact: DataFrame) -> DataFrame:
    """R2: weekend relative to weekday, in percent, per metric (one row).

    One pass with conditional aggregates; (weekend / weekday - 1) * 100.
    """
    we = F.col("day_type") == S.DAY_TYPE_WEEKEND
    wd = F.col("day_type") == S.DAY_TYPE_WEEKDAY

    def diff(a: Column, b: Column) -> Column:
        return agg2((F.try_divide(a.cast("double"), b.cast("double")) - 1) * 100)

    def avg_if(cond: Column, c: str) -> Column:
        return avg_of(F.when(cond, F.col(c)))

    def sum_if(cond: Column, c: str) -> Column:
        return exact_sum(F.when(cond, F.col(c)))

    return fact.agg(
        diff(F.count_if(we), F.count_if(wd)).alias("trip_count_diff_pct"),
        diff(avg_if(we, "total_amount"), avg_if(wd, "total_amount")).alias("avg_fare_diff_pct"),
        diff(avg_if(we, "trip_distance"), avg_if(wd, "trip_distance")).alias("avg_distance_diff_pct"),
        diff(sum_if(we, "total_amount"), sum_if(wd, "total_amount")).alias("total_revenue_diff_pct"),
    )


def traffic_level(speed: Column, levels: list[tuple[float, str]] | None = None,
                  default: str = S.TRAFFIC_LEVEL_DEFAULT) -> Column:
    """Heavy below the first cut, Moderate below the second, else Light."""
    expr = None
    for cut, label in (levels or S.TRAFFIC_LEVELS):
        expr = F.when(speed < cut, label) if expr is None else expr.when(speed < cut, label)
    return expr.otherwise(default)


def r_traffic_level(fact: DataFrame) -> DataFrame:
    """R3: hourly average speed with a traffic level."""
    v = v_avg_speed_by_hour(fact)
    return v.select("trip_hour", "avg_speed_mph", traffic_level(F.col("avg_speed_mph")).alias("traffic_level"))


def r_payment_share(fact: DataFrame) -> DataFrame:
    """R4: share of trips, average tip % and total tips per payment name."""
    agg = fact.groupBy("payment_type_name").agg(F.count(F.lit(1)).alias("trip_count"),
                                               _avg("tip_percentage").alias("avg_tip_pct"),
                                               _sum("tip_amount").alias("total_tips"))
    return (with_share(agg, "trip_count")
            .select("payment_type_name", "trip_count", "percentage", "avg_tip_pct", "total_tips")
            .orderBy(F.col("trip_count").desc_nulls_last(), "payment_type_name"))


def r_vendor_share(fact: DataFrame) -> DataFrame:
    """R6: vendor market share, average fare and speed."""
    agg = fact.groupBy("vendor_name").agg(F.count(F.lit(1)).alias("trip_count"),
                                         _avg("total_amount").alias("avg_fare"),
                                         _avg("avg_speed_mph").alias("avg_speed_mph"))
    return (with_share(agg, "trip_count", out="market_share")
            .select("vendor_name", "trip_count", "market_share", "avg_fare", "avg_speed_mph")
            .orderBy(F.col("trip_count").desc_nulls_last(), "vendor_name"))


def ranked(df: DataFrame, name: str, *order: Column, k: int | None = None) -> DataFrame:
    """Adds the position in ``order`` and sorts by it; ``k`` keeps the first k.

    ``df`` is aggregated: the window gathers a row per group in one task.
    """
    out = df.withColumn(name, F.row_number().over(Window.orderBy(*order)))
    return (out if k is None else out.filter(F.col(name) <= k)).orderBy(name)


def r_peak_hours(fact: DataFrame, k: int | None = None) -> DataFrame:
    """R7: pickup hours by trips, busiest first (ties by hour); all hours unless ``k`` is given."""
    hours = fact.groupBy("trip_hour").agg(F.count(F.lit(1)).alias("trip_count"),
                                          _sum("total_amount").alias("total_revenue"))
    return ranked(hours, "hour_rank", F.col("trip_count").desc(), F.col("trip_hour").asc_nulls_last(), k=k)


def r_top_segments(fact: DataFrame, k: int | None = None) -> DataFrame:
    """R8: (day part, day type) segments by fare per minute, ranked before rounding."""
    segments = (fact.filter(F.col("fare_per_mile").isNotNull() & F.col("fare_per_minute").isNotNull())
                .groupBy("time_of_day", "day_type")
                .agg(avg_of(F.col("fare_per_mile")).alias("per_mile"),
                     avg_of(F.col("fare_per_minute")).alias("per_minute"),
                     F.count(F.lit(1)).alias("trip_count")))
    order = (F.col("per_minute").desc_nulls_last(), F.col("time_of_day").asc_nulls_last(),
             F.col("day_type").asc_nulls_last())
    return ranked(segments, "segment_rank", *order, k=k).select(
        "segment_rank", "time_of_day", "day_type", agg2(F.col("per_mile")).alias("avg_fare_per_mile"),
        agg2(F.col("per_minute")).alias("avg_fare_per_minute"), "trip_count")


REPORTS = {
    "r_time_of_day_share": r_time_of_day_share,
    "r_day_type_diff": r_day_type_diff,
    "r_traffic_level": r_traffic_level,
    "r_payment_share": r_payment_share,
    "r_vendor_share": r_vendor_share,
    "r_peak_hours": r_peak_hours,
    "r_top_segments": r_top_segments,
}
