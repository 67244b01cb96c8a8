"""Test input: a raw trip table derived from the driver's ``events`` table.

One event gives one trip.  The rules (see FIXTURES.md) deliberately reach
every label branch and every quality rule: NULL distances, tips and payment
codes, an orphan vendor code, negative and zero fares, negative and very long
durations, tips equal to the total.  Integer arithmetic is used wherever an
engine's rounding could differ, so the DuckDB oracle reproduces it exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from farelens.schema import RAW_COLUMNS

# The columns of the events table the fixture reads (declared, so a scan
# does not infer them from the file footer).
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])
EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

# Truncate the wall clock to whole seconds; date_trunc works on the
# session-zone TIMESTAMP, so cast back to a zone-free timestamp.
_PICKUP = "CAST(date_trunc('SECOND', ts) AS TIMESTAMP_NTZ)"
_BUYER = "event_type IN ('purchase', 'click')"
_HUNDRED = "CAST(100 AS DOUBLE)"

FIXTURE_SQL = [
    "event_id AS trip_key",
    "CAST(CASE WHEN user_id % 10 < 3 THEN 1 WHEN user_id % 10 < 9 THEN 2 ELSE 6 END AS INT) AS VendorID",
    f"{_PICKUP} AS lpep_pickup_datetime",
    "timestampadd(SECOND, CAST(CASE WHEN event_id % 97 = 0 THEN 15000 WHEN event_id % 101 = 0 THEN -30 "
    f"ELSE (event_id * 37) % 3600 END AS INT), {_PICKUP}) AS lpep_dropoff_datetime",
    "CASE WHEN event_id % 503 = 0 THEN CAST(NULL AS DOUBLE) WHEN event_id % 211 = 0 THEN CAST(150 AS DOUBLE) "
    "WHEN event_id % 223 = 0 THEN CAST(-1 AS DOUBLE) "
    f"ELSE CAST((event_id * 7919) % 1500 AS DOUBLE) / {_HUNDRED} END AS trip_distance",
    "CASE WHEN event_id % 149 = 0 THEN -value WHEN event_id % 151 = 0 THEN CAST(0 AS DOUBLE) "
    "ELSE value END AS total_amount",
    "CASE WHEN event_id % 509 = 0 THEN CAST(NULL AS DOUBLE) WHEN event_id % 499 = 0 THEN value "
    f"WHEN {_BUYER} THEN floor(CAST(round(value * 100) AS BIGINT) * (event_id % 25) / {_HUNDRED}) / {_HUNDRED} "
    "ELSE CAST(0 AS DOUBLE) END AS tip_amount",
    "CAST(CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 5 WHEN event_id % 19 = 0 THEN 6 "
    f"WHEN {_BUYER} THEN 1 WHEN event_type = 'view' THEN 2 WHEN event_type = 'signup' THEN 3 "
    "WHEN event_type = 'error' THEN 4 END AS INT) AS payment_type",
]


def raw_trips_from_events(events: DataFrame) -> DataFrame:
    """``trip_key`` plus the raw trip columns, one row per event."""
    return events.selectExpr(*FIXTURE_SQL)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trip_key`` plus the raw trip columns, one row per event."""
    events = spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return raw_trips_from_events(events).select("trip_key", *RAW_COLUMNS)
