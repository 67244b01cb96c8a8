"""Schemas and the fixed label values the results must reproduce.

The raw schema is what a monthly trip file carries (only the columns the
transform reads are required).  The fact schema is the 23-column contract, in
output order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw trip record: the columns read by the transform.
RAW_SCHEMA = T.StructType([
    T.StructField("VendorID", T.IntegerType(), True),
    T.StructField("lpep_pickup_datetime", T.TimestampNTZType(), True),
    T.StructField("lpep_dropoff_datetime", T.TimestampNTZType(), True),
    T.StructField("trip_distance", T.DoubleType(), True),
    T.StructField("total_amount", T.DoubleType(), True),
    T.StructField("tip_amount", T.DoubleType(), True),
    T.StructField("payment_type", T.IntegerType(), True),
])

RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Names of a raw row's columns whose stored value does not fit its type.
UNCASTABLE = "uncastable"

FACT_SCHEMA = T.StructType([
    T.StructField("VendorID", T.IntegerType(), True),
    T.StructField("vendor_name", T.StringType(), False),
    T.StructField("pickup_datetime", T.TimestampType(), True),
    T.StructField("dropoff_datetime", T.TimestampType(), True),
    T.StructField("trip_distance", T.DoubleType(), True),
    T.StructField("total_amount", T.DoubleType(), True),
    T.StructField("tip_amount", T.DoubleType(), True),
    T.StructField("payment_type", T.IntegerType(), True),
    T.StructField("payment_type_name", T.StringType(), False),
    T.StructField("trip_hour", T.IntegerType(), True),
    T.StructField("trip_weekday", T.IntegerType(), True),
    T.StructField("trip_month", T.IntegerType(), True),
    T.StructField("trip_day", T.IntegerType(), True),
    T.StructField("trip_duration_min", T.DoubleType(), True),
    T.StructField("time_of_day", T.StringType(), False),
    T.StructField("is_weekend", T.BooleanType(), False),
    T.StructField("day_type", T.StringType(), False),
    T.StructField("avg_speed_mph", T.DoubleType(), True),
    T.StructField("fare_per_mile", T.DoubleType(), True),
    T.StructField("fare_per_minute", T.DoubleType(), True),
    T.StructField("distance_category", T.StringType(), False),
    T.StructField("fare_category", T.StringType(), False),
    T.StructField("tip_percentage", T.DoubleType(), True),
])

FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields]

# ---------------------------------------------------------------------------
# Labels, codes and cut points that must equal the original
# job's output exactly.  Listed in natural order.
# ---------------------------------------------------------------------------

# Day parts by pickup hour: [6,12) Morning, [12,17) Afternoon, [17,21) Evening,
# everything else (including NULL) Night.
TIME_OF_DAY_LABELS = ["Morning", "Afternoon", "Evening", "Night"]
TIME_OF_DAY_HOURS = [(6, 12, "Morning"), (12, 17, "Afternoon"), (17, 21, "Evening")]
TIME_OF_DAY_DEFAULT = "Night"

# Weekday numbering: 1 = Sunday ... 7 = Saturday; 1 and 7 are the weekend.
WEEKEND_DAYS = [1, 7]
DAY_TYPE_WEEKEND = "Weekend"
DAY_TYPE_WEEKDAY = "Weekday"
WEEKDAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Distance categories: upper bounds are inclusive; anything else (incl. NULL)
# is the last label.
DISTANCE_CATEGORIES = [
    (1, "Short (<1 mi)"),
    (5, "Medium (1-5 mi)"),
    (10, "Long (5-10 mi)"),
]
DISTANCE_CATEGORY_DEFAULT = "Very Long (>10 mi)"

# Fare categories on total_amount, same convention.
FARE_CATEGORIES = [
    (10, "Budget (<$10)"),
    (25, "Standard ($10-25)"),
    (50, "Premium ($25-50)"),
]
FARE_CATEGORY_DEFAULT = "Luxury (>$50)"

# Payment names written into the fact (code -> name; anything else "Other").
PAYMENT_TYPE_NAMES = [
    (1, "Credit Card"),
    (2, "Cash"),
    (3, "No Charge"),
    (4, "Dispute"),
    (5, "Unknown"),
]
PAYMENT_TYPE_DEFAULT = "Other"

# Vendor names written into the fact (code -> name; anything else "Unknown").
VENDOR_NAMES = [
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc."),
]
VENDOR_DEFAULT = "Unknown"

# Warehouse dimension rows (a second vocabulary, used by the joined views).
DIM_PAYMENT_TYPE_ROWS = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
DIM_VENDOR_ROWS = [
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc."),
]
DIM_MISSING_LABEL = "Unknown"

# Quality gate thresholds.
MAX_DISTANCE_MILES = 100
MAX_DURATION_MIN = 240
MAX_SPEED_MPH = 100
# Outlier window of the duration-by-hour view.
DURATION_VIEW_MAX_MIN = 180

# Traffic levels on hourly average speed (cut points are our parameters; the
# report names Heavy, Moderate and Light without giving them).
TRAFFIC_LEVELS = [(10, "Heavy"), (14, "Moderate")]
TRAFFIC_LEVEL_DEFAULT = "Light"

DIM_PAYMENT_SCHEMA = T.StructType([
    T.StructField("payment_type", T.IntegerType(), False),
    T.StructField("payment_desc", T.StringType(), False),
])
DIM_VENDOR_SCHEMA = T.StructType([
    T.StructField("vendor_id", T.IntegerType(), False),
    T.StructField("vendor_name", T.StringType(), False),
])


DISTANCE_ORDER = [label for _, label in DISTANCE_CATEGORIES] + [DISTANCE_CATEGORY_DEFAULT]
FARE_ORDER = [label for _, label in FARE_CATEGORIES] + [FARE_CATEGORY_DEFAULT]
