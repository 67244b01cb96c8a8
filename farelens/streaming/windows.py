"""Trips per hour over the stream of raw files: event-time windows with a watermark.

An hour is closed, and written once, when a trip has been seen that began
``DELAY`` after its end; trips of closed hours that arrive later are too late.
Open hours are state only.  The closed ones are a parquet table that grows by
whole hours; what is still open is worked out from the recent trips alone.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farelens.functions.features import add_features
from farelens.functions.numeric import SPLIT, UNITS, agg2, units
from farelens.operators.quality import quality_filter
from farelens.schema import RAW_SCHEMA

DELAY = "2 hours"
HOURS = "hour_start timestamp, trip_count long, high long, low long"


def clean_trips(raw: DataFrame) -> DataFrame:
    """(pickup, total_amount) of clean trips; the pickup as an instant, as watermarks need it."""
    return quality_filter(add_features(raw)).select(F.col("lpep_pickup_datetime").cast("timestamp").alias("pickup"), "total_amount")


def per_hour(trips: DataFrame) -> DataFrame:
    """(hour_start, trip_count, high, low): sums in whole units, which state stores without loss."""
    u = units(F.col("total_amount"))
    return (trips.groupBy(F.window("pickup", "1 hour").alias("hour"))
            .agg(F.count(F.lit(1)).alias("trip_count"),
                 F.sum(F.call_function("div", u, F.lit(SPLIT))).alias("high"), F.sum(u % F.lit(SPLIT)).alias("low"))
            .select(F.col("hour.start").alias("hour_start"), "trip_count", "high", "low"))


def start_hourly_windows(spark: SparkSession, raw_dir: str, out_path: str, delay: str = DELAY,
                         files_per_batch: int = 1_000, available_now: bool = True) -> StreamingQuery:
    """Stream the raw files under ``raw_dir`` (of RAW_SCHEMA) into the table of closed hours at ``out_path``."""
    stream = (spark.readStream.schema(RAW_SCHEMA).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", str(files_per_batch)).parquet(raw_dir))
    hours = per_hour(clean_trips(stream).withWatermark("pickup", delay))
    writer = (hours.writeStream.format("parquet").outputMode("append").option("path", out_path)
              .option("checkpointLocation", f"{out_path.rstrip('/')}/_hours_checkpoint"))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")).start()


def hours_so_far(spark: SparkSession, raw_dir: str, out_path: str) -> DataFrame:
    """(hour_start, trip_count, total_revenue, state): closed hours as written, open ones from the recent trips.

    Only trips behind the last closed hour are read from the raw files (the
    filter reaches the scan), so the work does not grow with the history.
    """
    closed = spark.read.schema(HOURS).parquet(out_path)
    last = closed.agg(F.max("hour_start").cast("string").alias("h")).first().h
    raw = spark.read.schema(RAW_SCHEMA).option("recursiveFileLookup", "true").parquet(raw_dir)
    if last is not None:
        raw = raw.filter(F.col("lpep_pickup_datetime") >= F.lit(last).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR"))
    open_hours = per_hour(clean_trips(raw))
    revenue = agg2((F.col("high").cast("decimal(20,0)") * F.lit(Decimal(SPLIT)) + F.col("low").cast("decimal(19,0)"))
                   * F.lit(Decimal(1) / UNITS))
    both = closed.withColumn("state", F.lit("closed")).unionByName(open_hours.withColumn("state", F.lit("open")))
    return both.select(F.col("hour_start").cast("timestamp_ntz").alias("hour_start"), "trip_count",
                       revenue.alias("total_revenue"), "state")
