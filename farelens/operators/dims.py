"""Dimension tables and the rerun-safe insert-if-absent load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens import schema as S


def _literal_table(spark: SparkSession, rows: list[tuple[int, str]], schema: T.StructType) -> DataFrame:
    """A few literal rows as a local relation, whose size the planner knows."""
    values = ", ".join(f"({code}, '{label}')" for code, label in rows)
    names = ", ".join(f.name for f in schema.fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return _literal_table(spark, S.DIM_PAYMENT_TYPE_ROWS, S.DIM_PAYMENT_SCHEMA)


def dim_vendor(spark: SparkSession) -> DataFrame:
    return _literal_table(spark, S.DIM_VENDOR_ROWS, S.DIM_VENDOR_SCHEMA)


def insert_if_absent(existing: DataFrame, offered: DataFrame, key: str,
                     tie_break: str | None = None) -> DataFrame:
    """Rows of ``existing`` plus offered rows whose key is not there yet.

    Like ``INSERT ... ON CONFLICT (key) DO NOTHING``: an existing key keeps its
    row; NULL keys are not inserted (a primary key cannot be NULL); several
    offered rows with the same new key collapse to one, the one with the
    smallest ``tie_break`` value (first non-key column by default).  Offered
    rows are reduced to one per key before the anti join, so the join sees at
    most one row per key on each side; the planner broadcasts whichever side
    its runtime statistics show to be small.
    """
    cols = existing.columns
    value_cols = [c for c in cols if c != key]
    order_col = tie_break or value_cols[0]
    ordered = [order_col] + [c for c in value_cols if c != order_col]
    # Distinct offered rows first: a hash aggregate with map-side combine, so
    # each task ships one row per distinct (key, values) however many trips
    # repeat it.  Only that small set reaches the per-key choice below, whose
    # min over a struct (the whole row with the smallest tie-break value)
    # needs a sort-based aggregate.  The hash repartition on the key is the
    # distribution that aggregate needs anyway; it also keeps the optimizer
    # from folding the distinct step into the duplicate-insensitive min.
    distinct_rows = (offered.select(*cols).filter(F.col(key).isNotNull())
                     .dropDuplicates().repartition(key))
    picked = (distinct_rows
              .groupBy(key)
              .agg(F.min(F.struct(*ordered)).alias("_row"))
              .select(key, *[F.col(f"_row.{c}").alias(c) for c in value_cols]))
    new_rows = picked.join(existing.select(key), on=key, how="left_anti")
    return existing.unionByName(new_rows)
