"""The 18 derived trip columns, as built-in Spark SQL expressions.

Each feature is a Spark SQL expression over raw (or earlier derived)
columns; ``add_features`` applies one ``selectExpr`` per dependency level,
so the whole feature set compiles to one Project inside whole-stage codegen
and the plan is built with a handful of driver calls.  ``feature(name)``
gives one of them as a ``Column``.

NULL behaviour follows the original ``when``/``otherwise`` chains: a NULL
input falls through to the ``otherwise`` label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens import schema as S

PICKUP_RAW = "lpep_pickup_datetime"
DROPOFF_RAW = "lpep_dropoff_datetime"


class Raw(str):
    """An SQL fragment to splice in as-is (not quoted as a literal)."""


def lit_sql(value) -> str:
    """A Spark SQL literal for a label or number."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def case_sql(branches: list[tuple[str, object]], default: object | None = None) -> str:
    """Searched CASE; the first true condition wins, NULL conditions fall through."""
    body = " ".join(f"WHEN {cond} THEN {lit_sql(val) if not isinstance(val, Raw) else val}"
                    for cond, val in branches)
    tail = "" if default is None else f" ELSE {lit_sql(default) if not isinstance(default, Raw) else default}"
    return f"CASE {body}{tail} END"


def round2_sql(x: str) -> str:
    """Row-level 2-dp rounding (Spark ``round``: half-up on the shortest decimal)."""
    return f"round({x}, 2)"


# -- P1, P2: timestamps -------------------------------------------------------
def pickup_datetime_sql() -> str:
    return f"to_timestamp({PICKUP_RAW})"


def dropoff_datetime_sql() -> str:
    return f"to_timestamp({DROPOFF_RAW})"


# -- P3..P6: calendar parts, from the raw pickup column -----------------------
def trip_hour_sql() -> str:
    return f"hour({PICKUP_RAW})"


def trip_weekday_sql() -> str:
    """1 = Sunday ... 7 = Saturday."""
    return f"dayofweek({PICKUP_RAW})"


def trip_month_sql() -> str:
    return f"month({PICKUP_RAW})"


def trip_day_sql() -> str:
    return f"dayofmonth({PICKUP_RAW})"


# -- P7: duration in minutes (epoch seconds of each side, unrounded) ---------
def trip_duration_min_sql(pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> str:
    return f"(CAST({dropoff} AS BIGINT) - CAST({pickup} AS BIGINT)) / 60"


# -- P8: day part --------------------------------------------------------------
def time_of_day_sql(hour: str = "trip_hour") -> str:
    return case_sql([(f"{hour} >= {lo} AND {hour} < {hi}", label) for lo, hi, label in S.TIME_OF_DAY_HOURS],
                    S.TIME_OF_DAY_DEFAULT)


# -- P9, P10: weekend flag and label ------------------------------------------
def _weekend_test(weekday: str) -> str:
    return f"{weekday} IN ({', '.join(str(d) for d in S.WEEKEND_DAYS)})"


def is_weekend_sql(weekday: str = "trip_weekday") -> str:
    return case_sql([(_weekend_test(weekday), Raw("true"))], Raw("false"))


def day_type_sql(weekday: str = "trip_weekday") -> str:
    return case_sql([(_weekend_test(weekday), S.DAY_TYPE_WEEKEND)], S.DAY_TYPE_WEEKDAY)


# -- P11..P13: speed and fare efficiency, NULL when undefined -----------------
def avg_speed_mph_sql(distance: str = "trip_distance", minutes: str = "trip_duration_min") -> str:
    return case_sql([(f"{minutes} > 0 AND {distance} > 0", Raw(round2_sql(f"{distance} / ({minutes} / 60)")))])


def fare_per_mile_sql(total: str = "total_amount", distance: str = "trip_distance") -> str:
    return case_sql([(f"{distance} > 0", Raw(round2_sql(f"{total} / {distance}")))])


def fare_per_minute_sql(total: str = "total_amount", minutes: str = "trip_duration_min") -> str:
    return case_sql([(f"{minutes} > 0", Raw(round2_sql(f"{total} / {minutes}")))])


# -- P14, P15: banded categories (first matching upper bound wins) ----------
def distance_category_sql(distance: str = "trip_distance") -> str:
    return case_sql([(f"{distance} <= {upper}", label) for upper, label in S.DISTANCE_CATEGORIES],
                    S.DISTANCE_CATEGORY_DEFAULT)


def fare_category_sql(total: str = "total_amount") -> str:
    return case_sql([(f"{total} <= {upper}", label) for upper, label in S.FARE_CATEGORIES],
                    S.FARE_CATEGORY_DEFAULT)


# -- P16: tip as a percentage of the fare without the tip --------------------
def tip_percentage_sql(tip: str = "tip_amount", total: str = "total_amount") -> str:
    """tip / (total - tip) * 100, 2 dp; 0 unless total > 0 and tip > 0.

    The denominator is zero when the tip equals the total; that gives NULL
    (``try_divide``) instead of an ANSI division error.
    """
    pct = round2_sql(f"try_divide({tip}, {total} - {tip}) * 100")
    return case_sql([(f"{total} > 0 AND {tip} > 0", Raw(pct))], Raw("CAST(0 AS DOUBLE)"))


# -- P17, P18: code -> name ---------------------------------------------------
def payment_type_name_sql(code: str = "payment_type") -> str:
    return case_sql([(f"{code} = {k}", label) for k, label in S.PAYMENT_TYPE_NAMES], S.PAYMENT_TYPE_DEFAULT)


def vendor_name_sql(code: str = "VendorID") -> str:
    return case_sql([(f"{code} = {k}", label) for k, label in S.VENDOR_NAMES], S.VENDOR_DEFAULT)


# Dependency levels: each level only reads raw columns or earlier levels.
LEVELS: list[dict[str, callable]] = [
    {
        "pickup_datetime": pickup_datetime_sql,
        "dropoff_datetime": dropoff_datetime_sql,
        "trip_hour": trip_hour_sql,
        "trip_weekday": trip_weekday_sql,
        "trip_month": trip_month_sql,
        "trip_day": trip_day_sql,
    },
    {
        "trip_duration_min": trip_duration_min_sql,
        "time_of_day": time_of_day_sql,
        "is_weekend": is_weekend_sql,
        "day_type": day_type_sql,
        "fare_per_mile": fare_per_mile_sql,
        "distance_category": distance_category_sql,
        "fare_category": fare_category_sql,
        "tip_percentage": tip_percentage_sql,
        "payment_type_name": payment_type_name_sql,
        "vendor_name": vendor_name_sql,
    },
    {
        "avg_speed_mph": avg_speed_mph_sql,
        "fare_per_minute": fare_per_minute_sql,
    },
]

FEATURE_SQL = {name: fn for level in LEVELS for name, fn in level.items()}
DERIVED_COLUMNS = list(FEATURE_SQL)


def add_features(raw: DataFrame) -> DataFrame:
    """Raw columns plus all 18 derived columns, one select per dependency level."""
    df = raw
    for level in LEVELS:
        kept = [c for c in df.columns if c not in level]
        df = df.selectExpr(*[f"`{c}`" for c in kept], *[f"{fn()} AS {name}" for name, fn in level.items()])
    return df


def feature(name: str, **kwargs) -> Column:
    """One derived column as a ``Column`` (arguments rename its inputs)."""
    return F.expr(FEATURE_SQL[name](**kwargs))


# Feature groups, one per derived-column family; used by the per-feature
# checks.  Each maps to the derived columns it produces.
FEATURE_GROUPS = {
    "timestamps": ["pickup_datetime", "dropoff_datetime"],
    "time_parts": ["trip_hour", "trip_weekday", "trip_month", "trip_day"],
    "duration": ["trip_duration_min"],
    "time_of_day": ["time_of_day"],
    "day_type": ["is_weekend", "day_type"],
    "speed": ["avg_speed_mph"],
    "fare_efficiency": ["fare_per_mile", "fare_per_minute"],
    "distance_category": ["distance_category"],
    "fare_category": ["fare_category"],
    "tip_percentage": ["tip_percentage"],
    "payment_name": ["payment_type_name"],
    "vendor_name": ["vendor_name"],
}
