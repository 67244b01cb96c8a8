"""Data-quality gate over featured trips.

Six rules, and two for rows read from files: no value that does not fit its
column's type, no rate too large for the exact sums.  A row passes only when every rule is TRUE, so a NULL in any rule
drops the row (SQL filter semantics).  The complement keeps those NULL rows:
a plain ``~pred`` would lose them, so each rule is coalesced to FALSE first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens import schema as S
from farelens.functions.numeric import LARGEST_MEASURE, share_pct

RULE_NAMES = [
    "total_amount_positive",
    "distance_non_negative",
    "distance_below_max",
    "duration_positive",
    "duration_below_max",
    "speed_plausible",
]


# Rule name -> Spark SQL predicate that must hold for a clean row.
RULE_SQL = {
    "total_amount_positive": "total_amount > 0",
    "distance_non_negative": "trip_distance >= 0",
    "distance_below_max": f"trip_distance < {S.MAX_DISTANCE_MILES}",
    "duration_positive": "trip_duration_min > 0",
    "duration_below_max": f"trip_duration_min < {S.MAX_DURATION_MIN}",
    # "speed IS NULL OR speed < max", written so the derived speed is
    # evaluated once when Catalyst inlines it into the scan's filter.
    "speed_plausible": f"coalesce(avg_speed_mph < {S.MAX_SPEED_MPH}, true)",
}


# For rows that carry UNCASTABLE, as ``sources.io.read_raw`` gives them: its
# values fit their types, and the rates made of them (per mile, per minute, tip
# per rest) can be summed.  Told from the parts, so that no rate is worked out
# and rounded for the filter alone.
_MOST = f"{LARGEST_MEASURE:.0f}D"
FILE_RULE_SQL = {
    "values_castable": f"{S.UNCASTABLE} = ''",
    "rates_in_range": " AND ".join(f"coalesce({x}, true)" for x in (
        f"trip_distance <= 0 OR abs(total_amount) < {_MOST} * trip_distance",
        f"trip_duration_min <= 0 OR abs(total_amount) < {_MOST} * trip_duration_min",
        f"total_amount = tip_amount OR abs(tip_amount) * 100 < {_MOST} * abs(total_amount - tip_amount)")),
}


def rules(df: DataFrame | None = None) -> list[tuple[str, Column]]:
    """Rule name -> predicate that must hold for a clean row of ``df``, in order."""
    out = [(name, F.expr(RULE_SQL[name])) for name in RULE_NAMES]
    if df is not None and S.UNCASTABLE in df.columns:
        out += [(name, F.expr(sql)) for name, sql in FILE_RULE_SQL.items()]
    return out


def passes(rule_col: Column) -> Column:
    """TRUE only when the rule is TRUE (NULL counts as failing)."""
    return F.coalesce(rule_col, F.lit(False))


def clean_predicate_sql(df: DataFrame | None = None) -> str:
    sql = [RULE_SQL[n] for n in RULE_NAMES]
    if df is not None and S.UNCASTABLE in df.columns:
        sql += FILE_RULE_SQL.values()
    return " AND ".join(f"({x})" for x in sql)


def clean_predicate(df: DataFrame | None = None) -> Column:
    return F.expr(clean_predicate_sql(df))


def quality_filter(featured: DataFrame) -> DataFrame:
    """Rows that pass all rules (F7)."""
    return featured.filter(clean_predicate_sql(featured))


def _reasons(featured: DataFrame) -> dict[str, Column]:
    failing = [F.when(~passes(p), F.lit(name)) for name, p in rules(featured)]
    n_failed = sum((F.when(~passes(p), 1).otherwise(0) for _, p in rules(featured)), F.lit(0))
    return {"reject_reasons": F.concat_ws(",", *failing), "n_failed_rules": n_failed.cast("int")}


def quality_rejects(featured: DataFrame) -> DataFrame:
    """Rows that fail at least one rule, with the failing rules named (F8)."""
    return featured.filter(~passes(clean_predicate(featured))).withColumns(_reasons(featured))


VERDICT, CLEAN, REJECTED = "verdict", "clean", "rejected"


def judged(featured: DataFrame) -> DataFrame:
    """All rows with their verdict, and the failing rules of rejected ones (clean ones: empty, 0)."""
    verdict = F.when(passes(clean_predicate(featured)), CLEAN).otherwise(REJECTED)
    return featured.withColumns({**_reasons(featured), VERDICT: verdict})


def rule_failure_counts(featured: DataFrame) -> DataFrame:
    """One row: per rule, the number of rows failing it (NULL = failing)."""
    return featured.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        *[F.count_if(~passes(p)).alias(f"fail_{name}") for name, p in rules(featured)],
    )


def split_counts(featured: DataFrame) -> DataFrame:
    """One row: raw, clean and removed counts and the removal rate (A9).

    A single aggregate pass: the clean count is a conditional count, not a
    second scan.
    """
    clean = F.count_if(passes(clean_predicate(featured)))
    raw = F.count(F.lit(1))
    return featured.agg(raw.alias("raw_rows"), clean.alias("clean_rows")).select(
        "raw_rows",
        "clean_rows",
        (F.col("raw_rows") - F.col("clean_rows")).alias("removed_rows"),
        share_pct(F.col("raw_rows") - F.col("clean_rows"), F.col("raw_rows")).alias("removed_pct"),
    )
