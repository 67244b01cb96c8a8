"""Unit tables for the derived columns: boundaries, NULLs, rounding."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.functions import features as FT
from farelens.functions.numeric import agg2, avg2, share_pct, sum2


def _one_col(spark, values, dtype):
    schema = T.StructType([T.StructField("x", dtype, True)])
    return spark.createDataFrame([(v,) for v in values], schema)


def test_time_of_day_edges(spark):
    df = _one_col(spark, list(range(24)) + [None], T.IntegerType()).withColumnRenamed("x", "trip_hour")
    got = {r.trip_hour: r.t for r in df.select("trip_hour", FT.feature("time_of_day").alias("t")).collect()}
    for h in range(24):
        want = "Morning" if 6 <= h < 12 else "Afternoon" if 12 <= h < 17 else "Evening" if 17 <= h < 21 else "Night"
        assert got[h] == want, h
    assert got[None] == "Night"


def test_weekday_numbering_and_weekend(spark):
    # 2024-01-07 is a Sunday.
    days = [dt.datetime(2024, 1, 7 + i, 12, 0) for i in range(7)] + [None]
    df = _one_col(spark, days, T.TimestampNTZType()).withColumnRenamed("x", "lpep_pickup_datetime")
    df = df.withColumn("trip_weekday", FT.feature("trip_weekday"))
    rows = df.select("lpep_pickup_datetime", "trip_weekday", FT.feature("is_weekend").alias("w"),
                     FT.feature("day_type").alias("d")).collect()
    by_day = {r.lpep_pickup_datetime: r for r in rows}
    assert [by_day[d].trip_weekday for d in days[:7]] == [1, 2, 3, 4, 5, 6, 7]
    assert [by_day[d].w for d in days[:7]] == [True, False, False, False, False, False, True]
    assert by_day[None].w is False and by_day[None].d == "Weekday"


@pytest.mark.parametrize("dist,label", [
    (0.0, "Short (<1 mi)"), (1.0, "Short (<1 mi)"), (1.01, "Medium (1-5 mi)"), (5.0, "Medium (1-5 mi)"),
    (5.01, "Long (5-10 mi)"), (10.0, "Long (5-10 mi)"), (10.01, "Very Long (>10 mi)"),
    (99.99, "Very Long (>10 mi)"), (-1.0, "Short (<1 mi)"), (None, "Very Long (>10 mi)"),
])
def test_distance_category(spark, dist, label):
    df = _one_col(spark, [dist], T.DoubleType()).withColumnRenamed("x", "trip_distance")
    assert df.select(FT.feature("distance_category")).first()[0] == label


@pytest.mark.parametrize("fare,label", [
    (0.0, "Budget (<$10)"), (0.01, "Budget (<$10)"), (10.0, "Budget (<$10)"), (10.01, "Standard ($10-25)"),
    (25.0, "Standard ($10-25)"), (25.01, "Premium ($25-50)"), (50.0, "Premium ($25-50)"),
    (50.01, "Luxury (>$50)"), (-5.0, "Budget (<$10)"), (None, "Luxury (>$50)"),
])
def test_fare_category(spark, fare, label):
    df = _one_col(spark, [fare], T.DoubleType()).withColumnRenamed("x", "total_amount")
    assert df.select(FT.feature("fare_category")).first()[0] == label


def test_tip_percentage_cases(spark):
    schema = "tip_amount double, total_amount double"
    rows = [(0.0, 10.0), (None, 10.0), (5.0, 5.0), (6.0, 5.0), (1.0, 0.0), (2.0, 12.0)]
    df = spark.createDataFrame(rows, schema).select("tip_amount", "total_amount",
                                                    FT.feature("tip_percentage").alias("p"))
    got = [r.p for r in df.collect()]
    # tip 0 -> 0; NULL tip -> 0; tip = total -> NULL (no ANSI error);
    # tip > total -> negative; total 0 -> 0; 2 / 10 * 100 = 20.
    assert got == [0.0, 0.0, None, -600.0, 0.0, 20.0]


def test_duration_speed_and_efficiency(spark):
    base = dt.datetime(2024, 1, 10, 8, 0, 0)
    rows = [
        (base, base + dt.timedelta(seconds=s), dist, total)
        for s, dist, total in [(0, 1.0, 10.0), (1, 1.0, 10.0), (14399, 2.0, 10.0), (14400, 2.0, 10.0),
                               (-30, 1.0, 10.0), (600, 0.0, 10.0)]
    ] + [(base, None, 1.0, 10.0)]
    schema = ("lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
              "trip_distance double, total_amount double")
    df = spark.createDataFrame(rows, schema)
    df = df.withColumns({"pickup_datetime": FT.feature("pickup_datetime"), "dropoff_datetime": FT.feature("dropoff_datetime")})
    df = df.withColumn("trip_duration_min", FT.feature("trip_duration_min"))
    out = df.select("trip_duration_min", FT.feature("avg_speed_mph").alias("s"), FT.feature("fare_per_mile").alias("fm"),
                    FT.feature("fare_per_minute").alias("fmin")).collect()
    durations = [r.trip_duration_min for r in out]
    assert durations[:6] == [0.0, 1 / 60, 14399 / 60, 240.0, -0.5, 10.0]
    assert durations[6] is None
    assert out[0].s is None and out[0].fmin is None          # zero duration
    assert out[1].s == 3600.0                                # 1 mile in 1 s
    assert out[5].s is None and out[5].fm is None            # zero distance
    assert out[5].fmin == 1.0


def test_rounding_half_up(spark):
    df = _one_col(spark, [1.005, 2.675, 0.125, 100 / 3, -2.675], T.DoubleType())
    got2 = [r[0] for r in df.select(agg2(F.col("x"))).collect()]
    assert got2 == [1.01, 2.68, 0.13, 33.33, -2.68]


def test_share_pct(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (0, 5)], "n long, t long")
    assert [r[0] for r in df.select(share_pct(F.col("n"), F.col("t"))).collect()] == [12.5, 33.33, 0.0]


def test_code_names(spark):
    df = _one_col(spark, [1, 2, 3, 4, 5, 6, None], T.IntegerType())
    pay = [r[0] for r in df.select(FT.feature("payment_type_name", code="x")).collect()]
    assert pay == ["Credit Card", "Cash", "No Charge", "Dispute", "Unknown", "Other", "Other"]
    ven = [r[0] for r in df.select(FT.feature("vendor_name", code="x")).collect()]
    assert ven == ["Creative Mobile Technologies", "VeriFone Inc."] + ["Unknown"] * 5


def test_aggregates_are_rounded_once(spark):
    df = _one_col(spark, [2.3449996, 0.0049999996, float("nan"), float("inf"), 1.005], T.DoubleType())
    assert [r[0] for r in df.select(agg2(F.col("x"))).collect()] == [2.34, 0.0, None, None, 1.01]
    # An average just under the middle, and one on it.
    for values, want in (([2.344, 2.34599999], 2.34), ([2.34, 2.35], 2.35), ([None, 0.005], 0.01), ([None], None)):
        assert _one_col(spark, values, T.DoubleType()).select(avg2("x")).first()[0] == want


def test_sums_do_not_depend_on_order(spark):
    amounts = [0.1, 1e14, 0.2, -1e14, 0.3] * 200
    sums = {spark.createDataFrame([(x,) for x in order], "x double").repartition(n).select(sum2("x")).first()[0]
            for n, order in ((1, amounts), (3, sorted(amounts)), (7, amounts[::-1]))}
    assert sums == {120.0}
