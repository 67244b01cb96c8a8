"""All 17 views from one pass over the fact.

Running the views one by one scans the fact 17 times.  Here one aggregate
with six grouping sets -- the only groupings the views need: pickup date
(with day, weekday, day type), hour (with day part and day type), distance
band, fare band, payment code and vendor code -- keeps, per group, row
counts, sums and non-NULL counts for every measure, including the filtered
subsets some views need.  Each view is then a small aggregate over the rows
of its grouping set.  Averages are rebuilt as sum / non-NULL count, never as
an average of averages; sums are exact decimals, so the results equal the
direct views.

Spark evaluates grouping sets by expanding each row once per set before the
map-side partial aggregation, so every task ships at most (its dates + 66)
rows whatever the trip volume or how thinly trips spread over the
categories; a single cross-product grain (date x hour x bands x codes) would
instead ship up to a few thousand cells per day per task.  The result is
one row per date plus a few dozen rows; it is checkpointed and reused by
every view of a dashboard refresh.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens import schema as S
from farelens.functions.numeric import agg2, exact_avg, exact_sum, units
from farelens.plans.views import day_name, rank_of, with_share
from farelens.session import ensure_checkpoint_dir

GRAIN = [
    "trip_date", "trip_hour", "trip_weekday", "trip_day", "time_of_day", "day_type",
    "distance_category", "fare_category", "payment_type", "payment_type_name",
    "VendorID", "vendor_name",
]

# Grouping sets: name -> columns (each view reads exactly one set).
SETS = {
    "date": ["trip_date", "trip_day", "trip_weekday", "day_type"],
    "hour": ["trip_hour", "time_of_day", "day_type"],
    "distance": ["distance_category"],
    "fare": ["fare_category"],
    "payment": ["payment_type", "payment_type_name"],
    "vendor": ["VendorID", "vendor_name"],
}


# The grouping set that each view reads.
SET_OF_VIEW = {
    "v_trips_by_time_of_day": "hour", "v_weekend_weekday_comparison": "date", "v_distance_category_dist": "distance",
    "v_fare_category_breakdown": "fare", "v_avg_speed_by_hour": "hour", "v_tip_by_payment": "payment",
    "v_vendor_performance": "vendor", "v_fare_efficiency": "hour", "v_hourly_revenue": "hour",
    "v_daily_summary": "date", "v_kpi_summary": "date", "v_trips_by_hour": "hour", "v_trips_by_weekday": "date",
    "v_payment_distribution": "payment", "v_avg_duration_by_hour": "hour", "v_daily_summary_by_date": "date",
    "v_vendor_performance_by_id": "vendor",
}


def _grouping_id(cols: list[str]) -> int:
    """Spark's grouping_id for a set: one bit per GRAIN column, 1 = not grouped."""
    n = len(GRAIN)
    return sum(1 << (n - 1 - i) for i, c in enumerate(GRAIN) if c not in cols)


def _set_name() -> Column:
    gid = F.grouping_id()
    expr = None
    for name, cols in SETS.items():
        cond = gid == _grouping_id(cols)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def _nn(c: str) -> Column:
    """Rows whose measure is in the sums."""
    return F.count(units(F.col(c)))


def _sum_if(cond: Column, c: str) -> Column:
    return exact_sum(F.when(cond, F.col(c)))


def build_rollup(fact: DataFrame, sets: list[str] | None = None) -> DataFrame:
    """One row per group of each grouping set, with every partial measure.

    ``grouping_set`` names the set a row belongs to (a NULL key is a real
    group, e.g. a NULL payment code, so the set is told by grouping_id).
    ``sets`` limits the work to the sets that the wanted views need.
    """
    speed_ok = F.col("avg_speed_mph").isNotNull()
    eff_ok = F.col("fare_per_mile").isNotNull() & F.col("fare_per_minute").isNotNull()
    d = F.col("trip_duration_min")
    dur_ok = (d > 0) & (d < S.DURATION_VIEW_MAX_MIN)
    return (fact
            .withColumn("trip_date", F.to_date(F.col("pickup_datetime")))
            .groupingSets([SETS[name] for name in sets or SETS], *GRAIN)
            .agg(_set_name().alias("grouping_set"),
                 F.count(F.lit(1)).alias("n"),
                 exact_sum(F.col("total_amount")).alias("s_total"), _nn("total_amount").alias("c_total"),
                 exact_sum(F.col("trip_distance")).alias("s_dist"), _nn("trip_distance").alias("c_dist"),
                 exact_sum(F.col("trip_duration_min")).alias("s_dur"), _nn("trip_duration_min").alias("c_dur"),
                 exact_sum(F.col("tip_amount")).alias("s_tip"), _nn("tip_amount").alias("c_tip"),
                 exact_sum(F.col("tip_percentage")).alias("s_tip_pct"), _nn("tip_percentage").alias("c_tip_pct"),
                 exact_sum(F.col("avg_speed_mph")).alias("s_speed"), _nn("avg_speed_mph").alias("c_speed"),
                 # V5: rows with a speed
                 _sum_if(speed_ok, "trip_duration_min").alias("s_dur_speed"),
                 F.count_if(speed_ok & units(d).isNotNull()).alias("c_dur_speed"),
                 # V8: rows with both efficiency measures
                 F.count_if(eff_ok).alias("n_eff"),
                 _sum_if(eff_ok, "fare_per_mile").alias("s_fpm_eff"),
                 _sum_if(eff_ok, "fare_per_minute").alias("s_fpmin_eff"),
                 # V15: durations inside the outlier window
                 F.count_if(dur_ok).alias("n_dur_ok"),
                 _sum_if(dur_ok, "trip_duration_min").alias("s_dur_ok"),
                 F.min(F.when(dur_ok, d)).alias("min_dur_ok"),
                 F.max(F.when(dur_ok, d)).alias("max_dur_ok")))


def _avg(s: str, c: str) -> Column:
    return agg2(exact_avg(F.sum(s), F.sum(c)))


def _total(s: str) -> Column:
    return agg2(F.sum(s))


def _n(alias: str) -> Column:
    return F.sum("n").cast("long").alias(alias)


def views_from_rollup(r: DataFrame, dim_payment: DataFrame, dim_vendor: DataFrame) -> dict[str, DataFrame]:
    g = {name: r.filter(F.col("grouping_set") == name) for name in SETS}
    out: dict[str, DataFrame] = {}
    out["v_trips_by_time_of_day"] = (
        g["hour"].groupBy("time_of_day")
        .agg(_n("trip_count"), _avg("s_total", "c_total").alias("avg_fare"),
             _avg("s_dist", "c_dist").alias("avg_distance"),
             _avg("s_dur", "c_dur").alias("avg_duration_min"), _total("s_total").alias("total_revenue"))
        .orderBy(rank_of("time_of_day", S.TIME_OF_DAY_LABELS).asc_nulls_last()))
    out["v_weekend_weekday_comparison"] = (
        g["date"].groupBy("day_type")
        .agg(_n("trip_count"), _avg("s_total", "c_total").alias("avg_fare"),
             _avg("s_dist", "c_dist").alias("avg_distance"),
             _avg("s_tip_pct", "c_tip_pct").alias("avg_tip_pct"), _total("s_total").alias("total_revenue")))
    dist = (g["distance"].groupBy("distance_category")
            .agg(_n("trip_count"), _avg("s_total", "c_total").alias("avg_fare"),
                 _avg("s_dur", "c_dur").alias("avg_duration")))
    out["v_distance_category_dist"] = (
        with_share(dist, "trip_count")
        .select("distance_category", "trip_count", "percentage", "avg_fare", "avg_duration")
        .orderBy(rank_of("distance_category", S.DISTANCE_ORDER).asc_nulls_last()))
    fare = (g["fare"].groupBy("fare_category")
            .agg(_n("trip_count"), _avg("s_dist", "c_dist").alias("avg_distance"),
                 _avg("s_tip_pct", "c_tip_pct").alias("avg_tip_pct")))
    out["v_fare_category_breakdown"] = (
        with_share(fare, "trip_count")
        .select("fare_category", "trip_count", "percentage", "avg_distance", "avg_tip_pct")
        .orderBy(rank_of("fare_category", S.FARE_ORDER).asc_nulls_last()))
    out["v_avg_speed_by_hour"] = (
        g["hour"].filter(F.col("c_speed") > 0)
        .groupBy("trip_hour")
        .agg(F.sum("c_speed").cast("long").alias("trip_count"),
             _avg("s_speed", "c_speed").alias("avg_speed_mph"),
             _avg("s_dur_speed", "c_dur_speed").alias("avg_duration_min"))
        .orderBy(F.col("trip_hour").asc_nulls_last()))
    out["v_tip_by_payment"] = (
        g["payment"].groupBy("payment_type_name")
        .agg(_n("trip_count"), _avg("s_tip_pct", "c_tip_pct").alias("avg_tip_pct"),
             _avg("s_tip", "c_tip").alias("avg_tip_amount"), _total("s_tip").alias("total_tips"))
        .orderBy(F.col("avg_tip_pct").desc_nulls_last(), F.col("payment_type_name").asc_nulls_last()))
    out["v_vendor_performance"] = (
        g["vendor"].groupBy("vendor_name")
        .agg(_n("total_trips"), _avg("s_total", "c_total").alias("avg_fare"),
             _avg("s_dist", "c_dist").alias("avg_distance"),
             _avg("s_speed", "c_speed").alias("avg_speed_mph"),
             _avg("s_tip_pct", "c_tip_pct").alias("avg_tip_pct"), _total("s_total").alias("total_revenue")))
    out["v_fare_efficiency"] = (
        g["hour"].filter(F.col("n_eff") > 0)
        .groupBy("time_of_day", "day_type")
        .agg(_avg("s_fpm_eff", "n_eff").alias("avg_fare_per_mile"),
             _avg("s_fpmin_eff", "n_eff").alias("avg_fare_per_minute"),
             F.sum("n_eff").cast("long").alias("trip_count"))
        .orderBy(F.col("time_of_day").asc_nulls_last(), F.col("day_type").asc_nulls_last()))
    out["v_hourly_revenue"] = (
        g["hour"].groupBy("trip_hour")
        .agg(_n("trip_count"), _total("s_total").alias("total_revenue"),
             _avg("s_total", "c_total").alias("avg_fare"), _total("s_tip").alias("total_tips"))
        .orderBy(F.col("trip_hour").asc_nulls_last()))
    out["v_daily_summary"] = (
        g["date"].groupBy("trip_day")
        .agg(_n("total_trips"), _total("s_total").alias("total_revenue"),
             _avg("s_total", "c_total").alias("avg_fare"), _avg("s_dist", "c_dist").alias("avg_distance"),
             _avg("s_dur", "c_dur").alias("avg_duration_min"))
        .orderBy(F.col("trip_day").asc_nulls_last()))
    out["v_kpi_summary"] = g["date"].agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_trips"),
        _total("s_total").alias("total_revenue"),
        _avg("s_total", "c_total").alias("avg_fare"),
        _avg("s_dist", "c_dist").alias("avg_distance_miles"),
        _avg("s_dur", "c_dur").alias("avg_duration_minutes"),
        _avg("s_speed", "c_speed").alias("avg_speed_mph"),
        _avg("s_tip_pct", "c_tip_pct").alias("avg_tip_percentage"),
        _total("s_tip").alias("total_tips"))
    out["v_trips_by_hour"] = (
        g["hour"].groupBy("trip_hour")
        .agg(_n("total_trips"), _avg("s_dist", "c_dist").alias("avg_distance"),
             _avg("s_total", "c_total").alias("avg_fare"))
        .orderBy(F.col("trip_hour").asc_nulls_last()))
    out["v_trips_by_weekday"] = (
        g["date"].groupBy("trip_weekday")
        .agg(_n("total_trips"), _avg("s_dist", "c_dist").alias("avg_distance"),
             _avg("s_total", "c_total").alias("avg_fare"))
        .select("trip_weekday", day_name().alias("day_name"), "total_trips", "avg_distance", "avg_fare")
        .orderBy(F.col("trip_weekday").asc_nulls_last()))
    out["v_avg_duration_by_hour"] = (
        g["hour"].filter(F.col("n_dur_ok") > 0)
        .groupBy("trip_hour")
        .agg(F.sum("n_dur_ok").cast("long").alias("total_trips"),
             _avg("s_dur_ok", "n_dur_ok").alias("avg_duration_min"),
             agg2(F.min("min_dur_ok")).alias("min_duration_min"),
             agg2(F.max("max_dur_ok")).alias("max_duration_min"))
        .orderBy(F.col("trip_hour").asc_nulls_last()))
    out["v_daily_summary_by_date"] = (
        g["date"].groupBy("trip_date")
        .agg(_n("total_trips"), _total("s_total").alias("total_revenue"),
             _avg("s_dist", "c_dist").alias("avg_distance"), _avg("s_dur", "c_dur").alias("avg_duration_min"))
        .orderBy(F.col("trip_date").asc_nulls_last()))
    pay = (g["payment"].groupBy("payment_type")
           .agg(_n("total_trips"), _total("s_total").alias("total_revenue"))
           .join(dim_payment, on="payment_type", how="left"))
    out["v_payment_distribution"] = (
        with_share(pay, "total_trips")
        .select("payment_type",
                F.coalesce(F.col("payment_desc"), F.lit(S.DIM_MISSING_LABEL)).alias("payment_desc"),
                "total_trips", "percentage", "total_revenue")
        .orderBy(F.col("total_trips").desc_nulls_last(), F.col("payment_type").asc_nulls_last()))
    ven = (g["vendor"].groupBy("VendorID")
           .agg(_n("total_trips"), _avg("s_dist", "c_dist").alias("avg_distance"),
                _avg("s_total", "c_total").alias("avg_fare"), _avg("s_dur", "c_dur").alias("avg_duration_min"))
           .join(dim_vendor.select(F.col("vendor_id").alias("VendorID"), "vendor_name"), on="VendorID", how="left"))
    out["v_vendor_performance_by_id"] = (
        ven.select(F.col("VendorID").alias("vendor_id"),
                   F.coalesce(F.col("vendor_name"), F.lit(S.DIM_MISSING_LABEL)).alias("vendor_name"),
                   "total_trips", "avg_distance", "avg_fare", "avg_duration_min")
        .orderBy(F.col("total_trips").desc_nulls_last(), F.col("vendor_id").asc_nulls_last()))
    return out


def materialize_rollup(fact: DataFrame) -> DataFrame:
    """Build the rollup once and cut its lineage with a reliable checkpoint.

    The checkpoint lands in the cluster's shared ``spark.checkpoint.dir``, so
    the 17 view actions that follow read a small table instead of re-scanning
    the fact, and a lost executor does not force a re-scan either.
    """
    ensure_checkpoint_dir(fact.sparkSession)
    return build_rollup(fact).checkpoint(eager=True)


def write_rollup(fact: DataFrame, path: str) -> DataFrame:
    """Store the rollup as a small parquet table and return it read back.

    Unlike a checkpoint, the table outlives the session: any later session
    (a dashboard refresh) rebuilds all 17 views from it with ``read_rollup``
    without touching the fact.
    """
    build_rollup(fact).write.mode("overwrite").parquet(path)
    return read_rollup(fact.sparkSession, path)


def read_rollup(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


LOAD_BATCH = "load_batch"


def write_rollup_batch(fact: DataFrame, path: str, batch: int) -> None:
    """Store the rollup of one load batch; a batch that is loaded again replaces its own rows.

    Only the batch's trips are read, whatever the fact holds already.
    """
    (build_rollup(fact).withColumn(LOAD_BATCH, F.lit(batch).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(LOAD_BATCH).parquet(path))


def merged_rollup(spark, path: str) -> DataFrame:
    """The batches' rollups as one: the rows that ``build_rollup`` of the whole fact gives.

    Sums and counts add up exactly (decimals and longs), extremes are taken
    of extremes; averages are made later, by the views.
    """
    stored = spark.read.parquet(path).drop(LOAD_BATCH)
    keys = [*GRAIN, "grouping_set"]
    merged = []
    for f in stored.schema:
        if f.name in keys:
            continue
        fold = F.min if f.name.startswith("min_") else F.max if f.name.startswith("max_") else F.sum
        merged.append(fold(f.name).cast(f.dataType).alias(f.name))
    return stored.groupBy(*keys).agg(*merged).select(*stored.columns)
