"""DuckDB statements that compute the same results as the Spark queries.

Used as the correctness oracle: each key of ``__spark_entry__.queries()``
has a statement here over the pre-registered parquet views (``events`` is
the only one read).  Every statement starts from the same CTE chain:
fixture -> features -> fact.

Engine differences handled here:
- DuckDB ``dayofweek`` is 0 = Sunday; add 1.
- Row-level rounding reproduces Spark's ``round`` on doubles: half-up on the
  shortest decimal form of the double (DuckDB prints that form too), so
  14.624999999999998 rounds to 14.62, not to 14.63 as a decimal cast would.
- Aggregates are worked out in whole units of 1e-8 (HUGEINT) and rounded
  once, half away from zero, by integer division.
- ``hour``/``month``/... are BIGINT in DuckDB and INT in Spark: cast.
"""

from __future__ import annotations

from farelens.plans.view_specs import SPECS, order_terms, render


def r2(x: str) -> str:
    """Row-level 2-dp rounding, half-up on the shortest decimal form."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def a2(x: str) -> str:
    """2-dp rounding of a double that is not a sum (minimum, ratio)."""
    return r2(x)


def cents(units: str, parts: str) -> str:
    """units * 1e-8 / parts, rounded once to 2 places; NULL for no parts."""
    return (f"CAST(CASE WHEN {units} < 0 THEN -((-2 * {units} + 1000000 * {parts}) // (2000000 * {parts})) "
            f"ELSE (2 * {units} + 1000000 * {parts}) // (2000000 * {parts}) END AS DOUBLE) / 100")


def units(x: str) -> str:
    """A measure's sum in whole units of 1e-8."""
    return f"SUM(CAST(ROUND({x} * 100000000) AS HUGEINT))"


def avg(x: str) -> str:
    return cents(units(x), f"CAST(COUNT({x}) AS HUGEINT)")


def total(x: str) -> str:
    return cents(units(x), "CAST(1 AS HUGEINT)")


def share(count: str, of: str) -> str:
    """100 * count / of, rounded once to 2 places."""
    n, t = f"CAST({count} AS HUGEINT)", f"CAST({of} AS HUGEINT)"
    return f"CAST((20000 * {n} + {t}) // (2 * {t}) AS DOUBLE) / 100"


RAW_TRIPS = """
raw_trips AS (
  SELECT
    event_id AS trip_key,
    CAST(CASE WHEN user_id % 10 < 3 THEN 1 WHEN user_id % 10 < 9 THEN 2 ELSE 6 END AS INTEGER) AS VendorID,
    date_trunc('second', ts) AS lpep_pickup_datetime,
    date_trunc('second', ts) + to_seconds(CAST(CASE WHEN event_id % 97 = 0 THEN 15000
                                                   WHEN event_id % 101 = 0 THEN -30
                                                   ELSE (event_id * 37) % 3600 END AS BIGINT)) AS lpep_dropoff_datetime,
    CASE WHEN event_id % 503 = 0 THEN CAST(NULL AS DOUBLE)
         WHEN event_id % 211 = 0 THEN CAST(150 AS DOUBLE)
         WHEN event_id % 223 = 0 THEN CAST(-1 AS DOUBLE)
         ELSE CAST((event_id * 7919) % 1500 AS DOUBLE) / CAST(100 AS DOUBLE) END AS trip_distance,
    CASE WHEN event_id % 149 = 0 THEN -value
         WHEN event_id % 151 = 0 THEN CAST(0 AS DOUBLE)
         ELSE value END AS total_amount,
    CASE WHEN event_id % 509 = 0 THEN CAST(NULL AS DOUBLE)
         WHEN event_id % 499 = 0 THEN value
         WHEN event_type IN ('purchase', 'click')
           THEN floor(CAST(round(value * 100) AS BIGINT) * (event_id % 25) / CAST(100 AS DOUBLE)) / CAST(100 AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS tip_amount,
    CAST(CASE WHEN event_id % 41 = 0 THEN NULL
              WHEN event_id % 17 = 0 THEN 5
              WHEN event_id % 19 = 0 THEN 6
              WHEN event_type IN ('purchase', 'click') THEN 1
              WHEN event_type = 'view' THEN 2
              WHEN event_type = 'signup' THEN 3
              WHEN event_type = 'error' THEN 4 END AS INTEGER) AS payment_type
  FROM events
)"""

PARTS = """
parts AS (
  SELECT r.*,
    CAST(lpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
    CAST(lpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
    CAST(hour(lpep_pickup_datetime) AS INTEGER) AS trip_hour,
    CAST(dayofweek(lpep_pickup_datetime) + 1 AS INTEGER) AS trip_weekday,
    CAST(month(lpep_pickup_datetime) AS INTEGER) AS trip_month,
    CAST(day(lpep_pickup_datetime) AS INTEGER) AS trip_day,
    CAST(CAST(floor(epoch(lpep_dropoff_datetime)) AS BIGINT)
         - CAST(floor(epoch(lpep_pickup_datetime)) AS BIGINT) AS DOUBLE) / 60 AS trip_duration_min
  FROM raw_trips r
)"""

FEATURED = f"""
featured AS (
  SELECT p.*,
    CASE WHEN trip_hour >= 6 AND trip_hour < 12 THEN 'Morning'
         WHEN trip_hour >= 12 AND trip_hour < 17 THEN 'Afternoon'
         WHEN trip_hour >= 17 AND trip_hour < 21 THEN 'Evening'
         ELSE 'Night' END AS time_of_day,
    CASE WHEN trip_weekday IN (1, 7) THEN TRUE ELSE FALSE END AS is_weekend,
    CASE WHEN trip_weekday IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
    CASE WHEN trip_duration_min > 0 AND trip_distance > 0
         THEN {r2("trip_distance / (trip_duration_min / 60)")} END AS avg_speed_mph,
    CASE WHEN trip_distance > 0 THEN {r2("total_amount / trip_distance")} END AS fare_per_mile,
    CASE WHEN trip_duration_min > 0 THEN {r2("total_amount / trip_duration_min")} END AS fare_per_minute,
    CASE WHEN trip_distance <= 1 THEN 'Short (<1 mi)'
         WHEN trip_distance <= 5 THEN 'Medium (1-5 mi)'
         WHEN trip_distance <= 10 THEN 'Long (5-10 mi)'
         ELSE 'Very Long (>10 mi)' END AS distance_category,
    CASE WHEN total_amount <= 10 THEN 'Budget (<$10)'
         WHEN total_amount <= 25 THEN 'Standard ($10-25)'
         WHEN total_amount <= 50 THEN 'Premium ($25-50)'
         ELSE 'Luxury (>$50)' END AS fare_category,
    CASE WHEN total_amount > 0 AND tip_amount > 0
         THEN (CASE WHEN total_amount - tip_amount = 0 THEN CAST(NULL AS DOUBLE)
                    ELSE {r2("tip_amount / (total_amount - tip_amount) * 100")} END)
         ELSE CAST(0 AS DOUBLE) END AS tip_percentage,
    CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
                      WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' ELSE 'Other' END AS payment_type_name,
    CASE VendorID WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc.'
                  ELSE 'Unknown' END AS vendor_name
  FROM parts p
)"""

BATCHED_VIEWS = ["v_kpi_summary", "v_avg_duration_by_hour", "v_payment_distribution"]

RULES = [
    ("total_amount_positive", "total_amount > 0"),
    ("distance_non_negative", "trip_distance >= 0"),
    ("distance_below_max", "trip_distance < 100"),
    ("duration_positive", "trip_duration_min > 0"),
    ("duration_below_max", "trip_duration_min < 240"),
    ("speed_plausible", "(avg_speed_mph IS NULL OR avg_speed_mph < 100)"),
]
CLEAN = " AND ".join(p for _, p in RULES)

FACT_COLUMNS = (
    "VendorID, vendor_name, pickup_datetime, dropoff_datetime, trip_distance, total_amount, "
    "tip_amount, payment_type, payment_type_name, trip_hour, trip_weekday, trip_month, trip_day, "
    "trip_duration_min, time_of_day, is_weekend, day_type, avg_speed_mph, fare_per_mile, "
    "fare_per_minute, distance_category, fare_category, tip_percentage"
)

FACT = f"""
fact AS (
  SELECT trip_key, {FACT_COLUMNS}
  FROM featured
  WHERE {CLEAN}
)"""

DIMS = """
dim_payment_type AS (
  SELECT CAST(payment_type AS INTEGER) AS payment_type, payment_desc FROM (VALUES
    (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided trip')
  ) t(payment_type, payment_desc)
),
dim_vendor AS (
  SELECT CAST(vendor_id AS INTEGER) AS vendor_id, vendor_name FROM (VALUES
    (1, 'Creative Mobile Technologies'), (2, 'VeriFone Inc.')
  ) t(vendor_id, vendor_name)
)"""

BASE = [RAW_TRIPS, PARTS, FEATURED, FACT, DIMS]


def with_base(body: str, *extra: str) -> str:
    ctes = ",".join(BASE + [e if e.startswith("\n") else "\n" + e for e in extra])
    return f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------------------
# Views
# ---------------------------------------------------------------------------
def measure(kind: str, column: str) -> str:
    return {"n": lambda: "COUNT(*)", "avg": lambda: avg(column), "sum": lambda: total(column),
            "min": lambda: a2(f"MIN({column})"), "max": lambda: a2(f"MAX({column})"),
            "share": lambda: share("COUNT(*)", "SUM(COUNT(*)) OVER ()")}[kind]()


VIEWS = {name: "\n" + render(spec, measure) for name, spec in SPECS.items()}
SORTED_VIEWS = {name: f"\nSELECT *, row_number() OVER (ORDER BY {', '.join(order_terms(spec))}) AS position\n"
                      f"FROM ({VIEWS[name]})" for name, spec in SPECS.items() if spec.order}


def view_cte(name: str) -> str:
    return f"\n{name} AS ({VIEWS[name]}\n)"


def over_view(name: str, select: str) -> str:
    return with_base(select, view_cte(name))


# ---------------------------------------------------------------------------
# Dashboard tiles (projections over views)
# ---------------------------------------------------------------------------
TILES = {
    "tile_time_of_day": ("v_trips_by_time_of_day", "SELECT time_of_day, trip_count FROM v_trips_by_time_of_day"),
    "tile_day_type": ("v_weekend_weekday_comparison",
                      "SELECT day_type, total_revenue, trip_count FROM v_weekend_weekday_comparison"),
    "tile_distance": ("v_distance_category_dist", "SELECT distance_category, percentage FROM v_distance_category_dist"),
    "tile_fare": ("v_fare_category_breakdown", "SELECT fare_category, percentage FROM v_fare_category_breakdown"),
    "tile_speed": ("v_avg_speed_by_hour", "SELECT trip_hour, avg_speed_mph FROM v_avg_speed_by_hour"),
    "tile_tips": ("v_tip_by_payment",
                  "SELECT payment_type_name, avg_tip_pct, total_tips FROM v_tip_by_payment "
                  "WHERE payment_type_name != 'Unknown'"),
    "tile_hourly": ("v_hourly_revenue", "SELECT trip_hour, total_revenue, trip_count FROM v_hourly_revenue"),
    "tile_vendor": ("v_vendor_performance", "SELECT * FROM v_vendor_performance"),
    "tile_kpi": ("v_kpi_summary", "SELECT * FROM v_kpi_summary"),
}


# ---------------------------------------------------------------------------
# Per-feature checks over all raw rows (including later-rejected rows)
# ---------------------------------------------------------------------------
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


def _fail(pred: str) -> str:
    return f"NOT COALESCE({pred}, FALSE)"


def statements() -> dict[str, str]:
    out: dict[str, str] = {}

    # Sources
    raw_cols = ("trip_key, VendorID, lpep_pickup_datetime, lpep_dropoff_datetime, trip_distance, "
                "total_amount, tip_amount, payment_type")
    out["scan_raw_trips"] = with_base(f"SELECT {raw_cols} FROM raw_trips")
    out["land_raw_roundtrip"] = out["scan_raw_trips"]

    # Features
    for group, cols in FEATURE_GROUPS.items():
        out[f"feat_{group}"] = with_base(f"SELECT trip_key, {', '.join(cols)} FROM featured")

    # Quality
    fails = ",\n  ".join(f"COUNT(*) FILTER (WHERE {_fail(p)}) AS fail_{n}" for n, p in RULES)
    out["dq_rule_counts"] = with_base(f"SELECT COUNT(*) AS raw_rows,\n  {fails}\nFROM featured")
    out["quality_filter"] = with_base(f"SELECT trip_key, {FACT_COLUMNS} FROM fact")
    reasons = ", ".join(f"CASE WHEN {_fail(p)} THEN '{n}' END" for n, p in RULES)
    n_failed = " + ".join(f"CASE WHEN {_fail(p)} THEN 1 ELSE 0 END" for _, p in RULES)
    out["quality_rejects"] = with_base(
        f"SELECT trip_key, {FACT_COLUMNS}, concat_ws(',', {reasons}) AS reject_reasons, "
        f"CAST({n_failed} AS INTEGER) AS n_failed_rules\n"
        f"FROM featured WHERE {_fail(CLEAN)}")
    removed_pct = share(f"(COUNT(*) - COUNT(*) FILTER (WHERE COALESCE({CLEAN}, FALSE)))", "COUNT(*)")
    out["etl_counts"] = with_base(
        f"SELECT COUNT(*) AS raw_rows,\n"
        f"  COUNT(*) FILTER (WHERE COALESCE({CLEAN}, FALSE)) AS clean_rows,\n"
        f"  COUNT(*) - COUNT(*) FILTER (WHERE COALESCE({CLEAN}, FALSE)) AS removed_rows,\n"
        f"  {removed_pct} AS removed_pct\nFROM featured")

    # Fact
    out["fact_trips"] = with_base(f"SELECT {FACT_COLUMNS} FROM fact")
    out["fact_reload_rerun"] = out["fact_trips"]
    out["fact_table_roundtrip"] = out["fact_trips"]
    out["stream_fact_load"] = out["fact_trips"]
    out["fact_swap_reload"] = out["fact_trips"]

    # Views and tiles
    for name, body in VIEWS.items():
        out[name] = with_base(body)
    out["etl_run_kpi"] = out["v_kpi_summary"]
    out["search_path_kpi"] = out["v_kpi_summary"]
    for name in BATCHED_VIEWS:
        out[f"batched_{name}"] = out[name]

    # Amounts that no exact sum holds: rejected, and so in no sum.
    def absurd(stmt: str, amount: str) -> str:
        return stmt.replace("ELSE value END AS total_amount", f"WHEN event_id % 97 = 5 THEN {amount} ELSE value END AS total_amount")

    out["etl_split_kpi"] = absurd(out["v_kpi_summary"], "CAST(NULL AS DOUBLE)")
    file_rules = [("values_castable", "COALESCE(total_amount < 9e10, TRUE)"),
                  ("rates_in_range", " AND ".join(f"COALESCE(abs({c}) < 9e10, TRUE)"
                                                  for c in ("fare_per_mile", "fare_per_minute", "tip_percentage")))]
    told = ", ".join(f"CASE WHEN {_fail('(' + p + ')')} THEN '{n}' END" for n, p in [*RULES, *file_rules])
    counted = " + ".join(f"CASE WHEN {_fail('(' + p + ')')} THEN 1 ELSE 0 END" for _, p in [*RULES, *file_rules])
    out["etl_split_rejects"] = absurd(with_base(f"""
SELECT reject_reasons, n_failed_rules, COUNT(*) AS n_rows, ANY_VALUE(raw_rows) AS raw_rows,
  ANY_VALUE(raw_rows - all_rejected) AS clean_rows
FROM (SELECT *, COUNT(*) OVER () AS raw_rows, COUNT(*) FILTER (WHERE n_failed_rules > 0) OVER () AS all_rejected
      FROM (SELECT concat_ws(',', {told}) AS reject_reasons, CAST({counted} AS INTEGER) AS n_failed_rules FROM featured))
WHERE n_failed_rules > 0 GROUP BY reject_reasons, n_failed_rules"""), "CAST(1e11 AS DOUBLE)")
    out["land_ledger"] = with_base("""
SELECT CAST(run AS INTEGER) AS run, CASE WHEN run = 1 THEN n ELSE 0 END AS rows_copied, run = 1 AS refused,
  'lacks columns total_amount' AS reasons, n AS lake_rows
FROM (SELECT COUNT(*) AS n FROM raw_trips), (VALUES (1), (2)) runs(run)""")
    out["hourly_windows"] = with_base(f"""
SELECT hour_start, COUNT(*) AS trip_count, {total("total_amount")} AS total_revenue,
  CASE WHEN hour_start + INTERVAL 1 HOUR <= newest - INTERVAL 2 HOUR THEN 'closed' ELSE 'open' END AS state
FROM (SELECT date_trunc('hour', pickup_datetime) AS hour_start, total_amount, MAX(pickup_datetime) OVER () AS newest FROM fact)
GROUP BY hour_start, newest""")
    for name, body in VIEWS.items():
        out[f"rollup_{name}"] = with_base(body)
    for name, (view, select) in TILES.items():
        out[name] = over_view(view, select)

    # Reports
    out["r_time_of_day_share"] = with_base(f"""
SELECT time_of_day, COUNT(*) AS trip_count,
  {share("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS percentage,
  {avg("total_amount")} AS avg_fare
FROM fact GROUP BY time_of_day""")

    def diff(expr_we: str, expr_wd: str) -> str:
        return a2(f"(CAST({expr_we} AS DOUBLE) / CAST({expr_wd} AS DOUBLE) - 1) * 100")

    we, wd = "day_type = 'Weekend'", "day_type = 'Weekday'"
    out["r_day_type_diff"] = with_base(f"""
SELECT
  {diff(f"COUNT(*) FILTER (WHERE {we})", f"COUNT(*) FILTER (WHERE {wd})")} AS trip_count_diff_pct,
  {diff(f"AVG(total_amount) FILTER (WHERE {we})", f"AVG(total_amount) FILTER (WHERE {wd})")} AS avg_fare_diff_pct,
  {diff(f"AVG(trip_distance) FILTER (WHERE {we})", f"AVG(trip_distance) FILTER (WHERE {wd})")} AS avg_distance_diff_pct,
  {diff(f"SUM(total_amount) FILTER (WHERE {we})", f"SUM(total_amount) FILTER (WHERE {wd})")} AS total_revenue_diff_pct
FROM fact""")

    out["r_traffic_level"] = over_view("v_avg_speed_by_hour", """
SELECT trip_hour, avg_speed_mph,
  CASE WHEN avg_speed_mph < 10 THEN 'Heavy' WHEN avg_speed_mph < 14 THEN 'Moderate' ELSE 'Light' END AS traffic_level
FROM v_avg_speed_by_hour""")

    out["r_payment_share"] = with_base(f"""
SELECT payment_type_name, COUNT(*) AS trip_count,
  {share("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS percentage,
  {avg("tip_percentage")} AS avg_tip_pct,
  {total("tip_amount")} AS total_tips
FROM fact GROUP BY payment_type_name""")

    out["r_vendor_share"] = with_base(f"""
SELECT vendor_name, COUNT(*) AS trip_count,
  {share("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS market_share,
  {avg("total_amount")} AS avg_fare,
  {avg("avg_speed_mph")} AS avg_speed_mph
FROM fact GROUP BY vendor_name""")

    out["r_peak_hours"] = with_base(f"""
SELECT trip_hour, COUNT(*) AS trip_count, {total("total_amount")} AS total_revenue,
  row_number() OVER (ORDER BY COUNT(*) DESC, trip_hour ASC NULLS LAST) AS hour_rank
FROM fact GROUP BY trip_hour""")

    per_minute = f"{units('fare_per_minute')} / CAST(COUNT(fare_per_minute) AS DOUBLE)"
    out["r_top_segments"] = with_base(f"""
SELECT time_of_day, day_type, {avg("fare_per_mile")} AS avg_fare_per_mile,
  {avg("fare_per_minute")} AS avg_fare_per_minute, COUNT(*) AS trip_count,
  row_number() OVER (ORDER BY {per_minute} DESC NULLS LAST, time_of_day, day_type) AS segment_rank
FROM fact WHERE fare_per_mile IS NOT NULL AND fare_per_minute IS NOT NULL GROUP BY time_of_day, day_type""")

    # Keys and integrity checks
    out["assign_trip_id"] = with_base("""
SELECT COUNT(*) AS n_rows, COUNT(*) AS n_ids, 1 AS min_id, COUNT(*) AS max_id, 0 AS n_moved FROM fact""")
    out["check_pk"] = with_base("""
SELECT VendorID, pickup_datetime, COUNT(*) AS n_rows FROM fact
GROUP BY VendorID, pickup_datetime HAVING COUNT(*) > 1 OR VendorID IS NULL OR pickup_datetime IS NULL""")
    out["check_pk_raw_key"] = with_base("""
SELECT trip_distance, payment_type, COUNT(*) AS n_rows FROM raw_trips
GROUP BY trip_distance, payment_type HAVING COUNT(*) > 1 OR trip_distance IS NULL OR payment_type IS NULL""")
    out["check_fk_payment"] = with_base("""
SELECT f.payment_type, COUNT(*) AS n_rows FROM fact f
WHERE f.payment_type IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_payment_type d WHERE d.payment_type = f.payment_type AND d.payment_type < 5)
GROUP BY f.payment_type""")
    out["check_fk_vendor"] = with_base("""
SELECT f.VendorID AS vendor_id, COUNT(*) AS n_rows FROM fact f
WHERE f.VendorID IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_vendor d WHERE d.vendor_id = f.VendorID)
GROUP BY f.VendorID""")
    cols = [c.strip() for c in FACT_COLUMNS.split(",")]
    nulls = ",\n  ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in cols)
    out["check_not_null"] = with_base(f"""
SELECT column_name, null_count FROM (
  UNPIVOT (SELECT {nulls} FROM fact) ON COLUMNS(*) INTO NAME column_name VALUE null_count
)""")

    # Dimension loads: codes seen in the fact, inserted when absent.
    out["dim_vendor_upsert"] = with_base("""
SELECT vendor_id, vendor_name FROM dim_vendor
UNION ALL
SELECT o.vendor_id, o.vendor_name FROM (
  SELECT VendorID AS vendor_id, MIN(vendor_name) AS vendor_name FROM fact
  WHERE VendorID IS NOT NULL GROUP BY VendorID
) o WHERE NOT EXISTS (SELECT 1 FROM dim_vendor d WHERE d.vendor_id = o.vendor_id)""")
    # Loaded into a dimension that holds the codes below 4 so far.
    out["dim_payment_upsert"] = with_base("""
SELECT payment_type, payment_desc FROM dim_payment_type WHERE payment_type < 4
UNION ALL
SELECT payment_type, MIN(payment_type_name) AS payment_desc FROM fact
WHERE payment_type >= 4 GROUP BY payment_type""")

    # Raw months that differ in schema; the second one also holds values that fit no type.
    mixed = """SELECT CASE WHEN trip_key % 3 = 2 AND trip_key % 90 = 2 THEN NULL ELSE VendorID END AS VendorID,
  lpep_pickup_datetime, lpep_dropoff_datetime, trip_distance, total_amount, tip_amount,
  CASE WHEN trip_key % 3 = 1 AND trip_key % 70 = 1 THEN NULL ELSE payment_type END AS payment_type,
  CASE WHEN trip_key % 3 = 1 AND trip_key % 70 = 1 THEN 'payment_type'
       WHEN trip_key % 3 = 2 AND trip_key % 90 = 2 THEN 'VendorID' ELSE '' END AS uncastable
FROM raw_trips"""
    out["scan_raw_mixed_months"] = with_base(mixed)
    out["land_raw_extra_column"] = with_base(f"""
SELECT {raw_cols}, CASE WHEN trip_key % 2 = 0 THEN CAST(trip_key AS DOUBLE) / 4 END AS congestion_fee FROM raw_trips""")
    out["land_raw_two_months"] = with_base("""
SELECT CASE WHEN trip_key % 2 = 0 THEN '2024-01' ELSE '2024-02' END AS load_month, COUNT(*) AS n_rows,
  MIN(trip_key) AS first_key, MAX(trip_key) AS last_key FROM raw_trips GROUP BY 1""")
    out["fact_date_range"] = with_base(f"""
SELECT {FACT_COLUMNS} FROM fact
WHERE CAST(pickup_datetime AS DATE) BETWEEN (SELECT MIN(CAST(pickup_datetime AS DATE)) + 3 FROM fact)
  AND (SELECT MIN(CAST(pickup_datetime AS DATE)) + 9 FROM fact)""")
    for name, (view, select) in TILES.items():
        out[f"sql_{name}"] = over_view(view, select)
    for name, body in SORTED_VIEWS.items():
        out[f"sorted_{name}"] = with_base(body)
    return out
