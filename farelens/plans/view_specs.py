"""The 17 views as data: what each groups by, measures, filters and sorts by.

``spark_sql`` renders a view for the Spark catalog (stored views, reachable
from other sessions).  The DuckDB statements that check the DataFrame views
are rendered from the same table by ``oracle_sql``, with arithmetic of their
own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from farelens import schema as S
from farelens.functions.numeric import SPLIT, UNITS, WIDE


@dataclass(frozen=True)
class ViewSpec:
    keys: tuple[str, ...] = ()                     # grouping columns of the fact
    measures: tuple[tuple[str, str, str], ...] = ()  # (output name, kind, column); kinds below
    where: str | None = None
    # A dimension looked up for the first key: (table, its key, its label, output name).
    dim: tuple[str, str, str, str] | None = None
    rename: dict[str, str] = field(default_factory=dict)
    order: tuple[str, ...] = ()                    # over output names; see LABEL_RANKS


# Kinds: n (rows), avg, sum, min, max (of the column), share (of all rows, in percent),
# dayname (of the key column).
def _m(text: str) -> tuple[tuple[str, str, str], ...]:
    """'name=kind:column' words, in output order."""
    out = []
    for word in text.split():
        name, _, rest = word.partition("=")
        kind, _, column = rest.partition(":")
        out.append((name, kind, column))
    return tuple(out)


SPECS: dict[str, ViewSpec] = {
    "v_trips_by_time_of_day": ViewSpec(
        ("time_of_day",), _m("trip_count=n avg_fare=avg:total_amount avg_distance=avg:trip_distance "
                             "avg_duration_min=avg:trip_duration_min total_revenue=sum:total_amount"),
        order=("rank(time_of_day)",)),
    "v_weekend_weekday_comparison": ViewSpec(
        ("day_type",), _m("trip_count=n avg_fare=avg:total_amount avg_distance=avg:trip_distance "
                          "avg_tip_pct=avg:tip_percentage total_revenue=sum:total_amount")),
    "v_distance_category_dist": ViewSpec(
        ("distance_category",), _m("trip_count=n percentage=share avg_fare=avg:total_amount "
                                   "avg_duration=avg:trip_duration_min"), order=("rank(distance_category)",)),
    "v_fare_category_breakdown": ViewSpec(
        ("fare_category",), _m("trip_count=n percentage=share avg_distance=avg:trip_distance "
                               "avg_tip_pct=avg:tip_percentage"), order=("rank(fare_category)",)),
    "v_avg_speed_by_hour": ViewSpec(
        ("trip_hour",), _m("trip_count=n avg_speed_mph=avg:avg_speed_mph avg_duration_min=avg:trip_duration_min"),
        where="avg_speed_mph IS NOT NULL", order=("trip_hour",)),
    "v_tip_by_payment": ViewSpec(
        ("payment_type_name",), _m("trip_count=n avg_tip_pct=avg:tip_percentage avg_tip_amount=avg:tip_amount "
                                   "total_tips=sum:tip_amount"), order=("avg_tip_pct DESC", "payment_type_name")),
    "v_vendor_performance": ViewSpec(
        ("vendor_name",), _m("total_trips=n avg_fare=avg:total_amount avg_distance=avg:trip_distance "
                             "avg_speed_mph=avg:avg_speed_mph avg_tip_pct=avg:tip_percentage "
                             "total_revenue=sum:total_amount")),
    "v_fare_efficiency": ViewSpec(
        ("time_of_day", "day_type"), _m("avg_fare_per_mile=avg:fare_per_mile avg_fare_per_minute=avg:fare_per_minute "
                                        "trip_count=n"),
        where="fare_per_mile IS NOT NULL AND fare_per_minute IS NOT NULL", order=("time_of_day", "day_type")),
    "v_hourly_revenue": ViewSpec(
        ("trip_hour",), _m("trip_count=n total_revenue=sum:total_amount avg_fare=avg:total_amount "
                           "total_tips=sum:tip_amount"), order=("trip_hour",)),
    "v_daily_summary": ViewSpec(
        ("trip_day",), _m("total_trips=n total_revenue=sum:total_amount avg_fare=avg:total_amount "
                          "avg_distance=avg:trip_distance avg_duration_min=avg:trip_duration_min"), order=("trip_day",)),
    "v_kpi_summary": ViewSpec(
        (), _m("total_trips=n total_revenue=sum:total_amount avg_fare=avg:total_amount "
               "avg_distance_miles=avg:trip_distance avg_duration_minutes=avg:trip_duration_min "
               "avg_speed_mph=avg:avg_speed_mph avg_tip_percentage=avg:tip_percentage total_tips=sum:tip_amount")),
    "v_trips_by_hour": ViewSpec(
        ("trip_hour",), _m("total_trips=n avg_distance=avg:trip_distance avg_fare=avg:total_amount"),
        order=("trip_hour",)),
    "v_trips_by_weekday": ViewSpec(
        ("trip_weekday",), _m("day_name=dayname total_trips=n avg_distance=avg:trip_distance avg_fare=avg:total_amount"),
        order=("trip_weekday",)),
    "v_payment_distribution": ViewSpec(
        ("payment_type",), _m("total_trips=n percentage=share total_revenue=sum:total_amount"),
        dim=("dim_payment_type", "payment_type", "payment_desc", "payment_desc"), order=("total_trips DESC", "payment_type")),
    "v_avg_duration_by_hour": ViewSpec(
        ("trip_hour",), _m("total_trips=n avg_duration_min=avg:trip_duration_min min_duration_min=min:trip_duration_min "
                           "max_duration_min=max:trip_duration_min"),
        where=f"trip_duration_min > 0 AND trip_duration_min < {S.DURATION_VIEW_MAX_MIN}", order=("trip_hour",)),
    "v_daily_summary_by_date": ViewSpec(
        ("CAST(pickup_datetime AS DATE)",), _m("total_trips=n total_revenue=sum:total_amount "
                                               "avg_distance=avg:trip_distance avg_duration_min=avg:trip_duration_min"),
        rename={"CAST(pickup_datetime AS DATE)": "trip_date"}, order=("trip_date",)),
    "v_vendor_performance_by_id": ViewSpec(
        ("VendorID",), _m("total_trips=n avg_distance=avg:trip_distance avg_fare=avg:total_amount "
                          "avg_duration_min=avg:trip_duration_min"),
        dim=("dim_vendor", "vendor_id", "vendor_name", "vendor_name"), rename={"VendorID": "vendor_id"},
        order=("total_trips DESC", "vendor_id")),
}

LABEL_RANKS = {"time_of_day": S.TIME_OF_DAY_LABELS, "distance_category": S.DISTANCE_ORDER, "fare_category": S.FARE_ORDER}


def order_terms(spec: ViewSpec) -> list[str]:
    """ORDER BY terms over the view's output columns, NULLs last."""
    out = []
    for term in spec.order:
        if term.startswith("rank("):
            column = term[5:-1]
            ranks = " ".join(f"WHEN '{label}' THEN {i}" for i, label in enumerate(LABEL_RANKS[column]))
            term = f"CASE {column} {ranks} END"
        out.append(f"{term} NULLS LAST")
    return out


def day_name_sql(column: str) -> str:
    names = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(S.WEEKDAY_NAMES, start=1))
    return f"CASE {column} {names} END"


def render(spec: ViewSpec, measure, fact: str = "fact", prefix: str = "") -> str:
    """SELECT text without ORDER BY; ``measure(kind, column)`` gives a dialect's aggregate."""
    names = [spec.rename.get(k, k) for k in spec.keys]
    keys = [f"{k} AS {n}" for k, n in zip(spec.keys, names)]
    cols = [f"{day_name_sql(spec.keys[0]) if kind == 'dayname' else measure(kind, column)} AS {name}"
            for name, kind, column in spec.measures]
    where = f" WHERE {spec.where}" if spec.where else ""
    group = f" GROUP BY {', '.join(spec.keys)}" if spec.keys else ""
    grouped = f"SELECT {', '.join(keys + cols)} FROM {fact}{where}{group}"
    if spec.dim is None:
        return grouped
    table, dim_key, label, out = spec.dim
    rest = ", ".join(f"g.{name}" for name, _, _ in spec.measures)
    return (f"SELECT g.{names[0]}, COALESCE(t.{label}, '{S.DIM_MISSING_LABEL}') AS {out}, {rest} FROM ({grouped}) g "
            f"LEFT JOIN {prefix}{table} t ON t.{dim_key} = g.{names[0]}")


def spark_measure(kind: str, column: str) -> str:
    units = f"TRY_CAST(RINT({column} * {UNITS}D) AS BIGINT)"
    total = (f"((CAST(SUM({units} DIV {SPLIT}) AS DECIMAL(20,0)) * {SPLIT} "
             f"+ CAST(SUM({units} % {SPLIT}) AS DECIMAL(19,0))) * 0.00000001BD)")
    value = {
        "n": "COUNT(*)",
        "sum": total,
        "avg": f"try_divide(CAST({total} AS DECIMAL(30,8)), CAST(COUNT({units}) AS DECIMAL(13,0)))",
        "min": f"MIN({column})",
        "max": f"MAX({column})",
        "share": "try_divide(CAST(100 * COUNT(*) AS DECIMAL(20,0)), CAST(SUM(COUNT(*)) OVER () AS DECIMAL(20,0)))",
    }[kind]
    return value if kind == "n" else f"CAST(ROUND(TRY_CAST({value} AS {WIDE}), 2) AS DOUBLE)"


def spark_sql(name: str, database: str) -> str:
    """The view's text over ``database``'s fact and dimensions, sorted as specified."""
    spec = SPECS[name]
    body = render(spec, spark_measure, f"`{database}`.fact_trips", f"`{database}`.")
    order = order_terms(spec)
    return f"SELECT * FROM ({body}) ORDER BY {', '.join(order)}" if order else body
