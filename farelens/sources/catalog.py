"""Catalog operations of the warehouse, on the Spark catalog.

Schema creation, name resolution and table (re)creation map onto
``CREATE DATABASE``, ``setCurrentDatabase``, ``CREATE TABLE`` and ``DROP
TABLE``; the 17 views are stored in the catalog, so that every session on it
(a dashboard) can query them after the load has ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.operators.dims import insert_if_absent
from farelens.plans.view_specs import SPECS, spark_sql
from farelens.session import ensure_checkpoint_dir
from farelens.sources import versions


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS, optionally at a shared location."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def use_database(spark: SparkSession, name: str) -> None:
    """Resolve unqualified table names in ``name`` (a search path of one)."""
    spark.catalog.setCurrentDatabase(name)


def create_table_if_absent(df: DataFrame, table: str, path: str | None = None) -> bool:
    """Create ``table`` from ``df`` unless it exists; True when created.

    Qualify the name (``db.table``): an unqualified name also matches a temp
    view of the same name.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        return False
    writer = df.write.format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return True


def drop_table(spark: SparkSession, table: str) -> None:
    """DROP TABLE IF EXISTS (temp views of the same name are left alone)."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def load_dimension(offered: DataFrame, table: str, key: str, root: str | None = None) -> int:
    """Insert the offered rows whose key the table lacks; returns how many.

    Creates the table if need be.  Loading the same rows again inserts none.
    The table's rows are kept as versions under ``root`` (by default a folder
    beside the table's own): old and new rows are staged as the next version,
    which only one of several loads can commit; the others start again from
    its rows.  So two loads at once leave one row per key.
    """
    spark = offered.sparkSession
    ensure_checkpoint_dir(spark)
    # One row per distinct offer, which a load may look at more than once.
    rows = offered.filter(F.col(key).isNotNull()).dropDuplicates().checkpoint()
    added = [0]

    def change(existing: DataFrame | None) -> DataFrame | None:
        known = existing if existing is not None else rows.limit(0)
        added[0] = insert_if_absent(known, rows, key).join(known.select(key), key, "left_anti").count()
        if existing is not None and not added[0]:
            return None
        return insert_if_absent(known, rows, key).select(*known.columns).coalesce(1)

    if root is None:
        if not spark.catalog.tableExists(table):
            create_table_if_absent(rows.limit(0), table)
        root = versions.root_of(spark, table)
    versions.adopt(spark, table, root)
    versions.update(spark, table, root, change)
    return added[0]


def store_views(spark: SparkSession, database: str, fact_path: str, dims: dict[str, DataFrame],
                keys: dict[str, str], location: str | None = None) -> list[str]:
    """Catalog database with the stored fact, the dimensions and all views.

    The fact is an external table over ``fact_path``; its partitions are
    registered anew, so after a load the same views show the new rows.
    Dimensions are loaded insert-if-absent by their key.
    """
    ensure_database(spark, database, location)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.fact_trips USING parquet LOCATION '{fact_path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.fact_trips")):
        spark.sql(f"MSCK REPAIR TABLE `{database}`.fact_trips SYNC PARTITIONS")
    spark.catalog.refreshTable(f"{database}.fact_trips")
    for name, df in dims.items():
        load_dimension(df, f"{database}.{name}", keys[name])
    for name in SPECS:
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.{name} AS {spark_sql(name, database)}")
    return list(SPECS)
