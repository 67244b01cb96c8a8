"""Rounding, sums and shares shared by views, reports and the rollup.

Row-level features use Spark's own ``round`` on doubles (half-up on the
shortest decimal form), exactly what the original transform does.  Measures
are summed as whole numbers, which is exact and does not depend on the order of
the rows, and rounded once, half-up, like the warehouse's
``ROUND(x::numeric, 2)``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Measures are summed in whole units of 1e-8 (they carry at most a few decimals:
# amounts two, minutes a 60th).  One long would overflow at scale and a decimal
# per row costs five times a double, so units are summed in two longs: the
# multiples of SPLIT and the rest, enough for 9e12 rows.
UNITS = 100_000_000
SPLIT = 1_000_000
# Amounts, distances and rates beyond this are errors, not measures; below it
# every one has its units.
LARGEST_MEASURE = 9e10
# What a double or a quotient is rounded from: one rounding, at the 2nd place.
WIDE = "decimal(38,18)"


def units(col: Column) -> Column:
    """A measure in whole units of 1e-8 (NULL stays NULL).

    What is beyond LARGEST_MEASURE would have none; the gate counts and rejects
    such rows of files (``values_castable``, ``rates_in_range``).
    """
    return F.rint(col * F.lit(float(UNITS))).try_cast("long")


def agg2(col: Column) -> Column:
    """Round once to 2 places, half-up; returns a double (NaN and infinities: NULL)."""
    return F.round(col.try_cast(WIDE), 2).cast("double")


def exact_sum(col: Column) -> Column:
    """SUM as decimal(38,8), whatever the order of the rows."""
    u = units(col)
    high = F.sum(F.call_function("div", u, F.lit(SPLIT))).cast("decimal(20,0)")
    low = F.sum(u % F.lit(SPLIT)).cast("decimal(19,0)")
    return (high * F.lit(Decimal(SPLIT)) + low) * F.lit(Decimal(1) / UNITS)


def exact_avg(total: Column, count: Column) -> Column:
    """total / count with 16 decimals, NULL for no rows.

    The operand widths leave Spark's division that many (sums below 1e22,
    fewer than 1e13 rows).
    """
    return F.try_divide(total.cast("decimal(30,8)"), count.cast("decimal(13,0)"))


def avg_of(col: Column) -> Column:
    """AVG (NULLs ignored), not rounded yet."""
    return exact_avg(exact_sum(col), F.count(units(col)))


def avg2(column: str) -> Column:
    """AVG of a column, rounded once."""
    return agg2(avg_of(F.col(column)))


def sum2(column: str) -> Column:
    """SUM of a column, rounded once."""
    return agg2(exact_sum(F.col(column)))


def share_pct(count: Column, total: Column) -> Column:
    """100 * count / total as an exact decimal, rounded once."""
    return agg2(F.try_divide((F.lit(100) * count).cast("decimal(20,0)"), total.cast("decimal(20,0)")))
