"""Unit tables for report levels and view ordering (FIXTURES §5)."""

import datetime as dt

from pyspark.sql import functions as F

from farelens import schema as S
from farelens.plans import views as V
from farelens.plans.reports import traffic_level


def test_traffic_levels(spark):
    speeds = [8.7, 9.4, 10.0, 10.1, 11.3, 14.0, 14.5, 18.2]
    df = spark.createDataFrame([(s,) for s in speeds], "s double")
    got = [r.t for r in df.select(traffic_level(F.col("s")).alias("t")).collect()]
    assert got == ["Heavy", "Heavy", "Moderate", "Moderate", "Moderate", "Light", "Light", "Light"]


def _fact_rows(spark, rows):
    """Minimal fact rows: (hour, distance label, fare label, total)."""
    base = dt.datetime(2024, 1, 10)
    data = [(h, dist, fare, total, base) for h, dist, fare, total in rows]
    df = spark.createDataFrame(
        data, "trip_hour int, distance_category string, fare_category string, total_amount double, "
              "pickup_datetime timestamp")
    return df.withColumns({
        "trip_distance": F.lit(1.0), "trip_duration_min": F.lit(10.0), "tip_percentage": F.lit(0.0),
        "tip_amount": F.lit(0.0), "avg_speed_mph": F.lit(6.0),
    })


def test_intended_label_order_and_nulls_last(spark):
    dist = list(reversed(S.DISTANCE_ORDER))
    fare = list(reversed(S.FARE_ORDER))
    rows = [(None, dist[i], fare[i], 10.0 + i) for i in range(4)] + [(h, dist[0], fare[0], 5.0) for h in (23, 0, 7)]
    fact = _fact_rows(spark, rows)
    assert [r.distance_category for r in V.v_distance_category_dist(fact).collect()] == S.DISTANCE_ORDER
    assert [r.fare_category for r in V.v_fare_category_breakdown(fact).collect()] == S.FARE_ORDER
    hours = [r.trip_hour for r in V.v_hourly_revenue(fact).collect()]
    assert hours == [0, 7, 23, None]                       # ascending, NULL last
    shares = [r.percentage for r in V.v_distance_category_dist(fact).collect()]
    assert abs(sum(shares) - 100) <= 0.04
