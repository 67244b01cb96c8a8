"""The nine dashboard queries: projections over the views (D1-D9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# tile -> (view it reads, projection over that view)
TILES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "tile_time_of_day": ("v_trips_by_time_of_day", lambda v: v.select("time_of_day", "trip_count")),
    "tile_day_type": ("v_weekend_weekday_comparison",
                      lambda v: v.select("day_type", "total_revenue", "trip_count")),
    "tile_distance": ("v_distance_category_dist", lambda v: v.select("distance_category", "percentage")),
    "tile_fare": ("v_fare_category_breakdown", lambda v: v.select("fare_category", "percentage")),
    "tile_speed": ("v_avg_speed_by_hour", lambda v: v.select("trip_hour", "avg_speed_mph")),
    "tile_tips": ("v_tip_by_payment",
                  lambda v: v.filter(F.col("payment_type_name") != "Unknown")
                  .select("payment_type_name", "avg_tip_pct", "total_tips")),
    "tile_hourly": ("v_hourly_revenue", lambda v: v.select("trip_hour", "total_revenue", "trip_count")),
    "tile_vendor": ("v_vendor_performance", lambda v: v),
    "tile_kpi": ("v_kpi_summary", lambda v: v),
}

# The same queries as SQL text over the stored views of a database.
TILE_SQL: dict[str, str] = {
    "tile_time_of_day": "SELECT time_of_day, trip_count FROM {db}.v_trips_by_time_of_day",
    "tile_day_type": "SELECT day_type, total_revenue, trip_count FROM {db}.v_weekend_weekday_comparison",
    "tile_distance": "SELECT distance_category, percentage FROM {db}.v_distance_category_dist",
    "tile_fare": "SELECT fare_category, percentage FROM {db}.v_fare_category_breakdown",
    "tile_speed": "SELECT trip_hour, avg_speed_mph FROM {db}.v_avg_speed_by_hour",
    "tile_tips": "SELECT payment_type_name, avg_tip_pct, total_tips FROM {db}.v_tip_by_payment "
                 "WHERE payment_type_name != 'Unknown'",
    "tile_hourly": "SELECT trip_hour, total_revenue, trip_count FROM {db}.v_hourly_revenue",
    "tile_vendor": "SELECT * FROM {db}.v_vendor_performance",
    "tile_kpi": "SELECT * FROM {db}.v_kpi_summary",
}
