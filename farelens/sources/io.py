"""Sources and sinks: raw scans, the lake copy, and fact sinks.

- Raw scan (S1/S3): every file is read with its own footer schema, then cast
  to the transform's seven columns, so months that differ line up.
- Lake landing (S2): an unchanged copy, one partition per load month.
- Fact sinks (S5): parquet laid out by pickup date (partition pruning for
  date ranges, row groups sorted by pickup time for min/max skipping), a
  catalog table whose definition survives a reload, or JDBC with truncate.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.functions.numeric import LARGEST_MEASURE
from farelens.schema import FACT_COLUMNS, RAW_SCHEMA, UNCASTABLE
from farelens.sources.footers import list_files, read_footers

PARTITION_COL = "pickup_date"
LOAD_MONTH = "load_month"
# Lists in which the files of one schema reach the driver.
LISTS = 64


class SchemaMismatch(ValueError):
    pass


def data_files(spark: SparkSession, *paths: str) -> list[str]:
    """The files under ``paths`` (globs, folders, partitioned folders), listed by Spark's own readers."""
    return sorted(r.path for r in list_files(spark, *paths).select("path").collect())


def _grouped(spark: SparkSession, footers: DataFrame) -> list[tuple[T.StructType, list[str], int]]:
    """(schema, files, rows) of each footer schema, from one job; an unreadable file is an error."""
    some = footers.groupBy("schema", "error", F.pmod(F.xxhash64("path"), F.lit(LISTS)).alias("part")).agg(
        F.collect_list("path").alias("files"), F.sum("row_count").alias("n")).collect()
    groups: dict[str, tuple[T.StructType, list[str], list[int]]] = {}
    for r in some:
        if r.error:
            raise SchemaMismatch(f"no parquet file: {min(r.files)}: {r.error}")
        # Types that only Spark can tell: its own look at each such file.
        schemas = {r.schema: r.files} if r.schema else {spark.read.parquet(f).schema.json(): [f] for f in r.files}
        for key, files in schemas.items():
            group = groups.setdefault(key, (T.StructType.fromJson(json.loads(key)), [], []))
            group[1].extend(files)
        group[2].append(r.n)
    return sorted(((s, sorted(files), sum(n)) for s, files, n in groups.values()), key=lambda g: g[1])


def schema_groups(spark: SparkSession, *paths: str, footers: DataFrame | None = None) -> list[tuple[T.StructType, list[str], int]]:
    """Files grouped by equal footer schema, with their rows: one job, however many files.

    ``footers`` are rows of ``footers.read_footers`` at hand already.
    """
    groups = _grouped(spark, read_footers(spark, *paths) if footers is None else footers)
    if not groups:
        raise FileNotFoundError(f"no files under {paths}")
    return groups


def _cast(field: T.StructField, stored: T.DataType) -> tuple[Column, Column]:
    """A stored column as the target type, and whether a value did not fit.

    A value fits when the cast gives a value and, for whole numbers, loses no
    fraction.  NaN, infinities and absurd sizes are no amounts.  What cannot
    be cast is NULL.
    """
    c = F.col(f"`{field.name}`")
    numeric = isinstance(stored, T.NumericType)
    out = c if stored == field.dataType else c.try_cast(field.dataType)
    bad = F.lit(False) if stored == field.dataType else c.isNotNull() & out.isNull()
    if isinstance(field.dataType, T.IntegralType) and isinstance(stored, (T.FractionalType,)):
        bad = bad | (out.cast("double") != c.cast("double"))
    if isinstance(field.dataType, T.DoubleType) and (not numeric or isinstance(stored, (T.DoubleType, T.FloatType))):
        bad = bad | F.isnan(out) | (F.abs(out) >= LARGEST_MEASURE)
    bad = F.coalesce(bad, F.lit(False))
    # A column of the right type stays bare, so that filters on it reach the scan.
    return (out if stored == field.dataType else F.when(~bad, out)), bad


def read_raw(spark: SparkSession, *paths: str) -> DataFrame:
    """The records of ``scan_raw``."""
    return scan_raw(spark, *paths)[0]


def scan_raw(spark: SparkSession, *paths: str, footers: DataFrame | None = None) -> tuple[DataFrame, int]:
    """Raw trip records and their number, which the footers tell.

    The records are the seven transform columns typed as RAW_SCHEMA, plus UNCASTABLE.

    Files are grouped by their own footer schema and cast group by group, so
    a code stored as int, bigint and double in different months lines up.  A
    required column missing in any file is an error.  UNCASTABLE names the
    columns of a row whose value does not fit the type (empty: none); the
    quality gate counts and rejects such rows.
    """
    groups = schema_groups(spark, *paths, footers=footers)
    for schema, files, _ in groups:
        missing = [f.name for f in RAW_SCHEMA.fields if f.name not in schema.names]
        if missing:
            raise SchemaMismatch(f"raw trip files lack columns {missing}: {files[0]}")
    parts = []
    for schema, files, _ in groups:
        casts = {f.name: _cast(f, schema[f.name].dataType) for f in RAW_SCHEMA.fields}
        bad = [F.when(b, F.lit(name)) for name, (_, b) in casts.items()]
        parts.append(spark.read.schema(schema).parquet(*files).select(
            *[c.alias(name) for name, (c, _) in casts.items()], F.concat_ws(",", *bad).alias(UNCASTABLE)))
    return reduce(DataFrame.unionByName, parts), sum(n for *_, n in groups)


def land_raw(df: DataFrame, path: str, month: str | None = None, append: bool = False) -> None:
    """Copy into the lake (one job, no shuffle).

    With ``month`` the copy is the partition ``load_month=<month>`` of the
    lake: landing a month again replaces that month and keeps the others.
    The month is the file's, not the rows': trip files hold a few rows of
    other months, which must not touch those months' copies.  Without it the
    whole path is replaced.
    """
    mode = "append" if append else "overwrite"
    if month is None:
        df.write.mode(mode).parquet(path)
        return
    (df.withColumn(LOAD_MONTH, F.lit(month)).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy(LOAD_MONTH).parquet(path))


def month_of(path: str) -> str | None:
    """The last ``YYYY-MM`` in a file's path."""
    found = re.findall(r"(?<!\d)(\d{4}-(?:0[1-9]|1[0-2]))(?!\d)", path)
    return found[-1] if found else None


def land_files(spark: SparkSession, src_paths: list[str], lake_path: str, month: str | None = None) -> None:
    """Land raw files with all their columns, month by month.

    Files of one month that differ in schema are written one after the other
    with their own schemas; ``read_raw`` resolves them again.  ``month``
    overrides the month in the file names; a file without either is an error.
    """
    by_month: dict[str, list[tuple[T.StructType, list[str]]]] = {}
    for schema, files, _ in schema_groups(spark, *src_paths):
        for file in files:
            key = month or month_of(file)
            if key is None:
                raise ValueError(f"no month in the name of {file}; give one")
            groups = by_month.setdefault(key, [])
            if not groups or groups[-1][0] is not schema:
                groups.append((schema, []))
            groups[-1][1].append(file)
    for key, groups in sorted(by_month.items()):
        for i, (schema, files) in enumerate(groups):
            land_raw(spark.read.schema(schema).parquet(*files), lake_path, month=key, append=i > 0)


def cluster_by_time(df: DataFrame) -> DataFrame:
    """Rebalance trips by pickup date before a date-partitioned write.

    Without it, every task writes one file per date it happens to hold, so
    input that is not time-ordered turns into tasks x dates small files.
    ``REBALANCE`` hashes rows by date and lets AQE size the result: a hot
    date (a third of all trips, say) is split into several advisory-sized
    tasks, small dates are coalesced, and no sampling job re-reads the input
    (as a range exchange would).
    """
    with_date = df if PARTITION_COL in df.columns else df.withColumn(
        PARTITION_COL, F.to_date(F.col("pickup_datetime")))
    return with_date.hint("rebalance", PARTITION_COL)


def write_fact_parquet(fact: DataFrame, path: str, cluster: bool = False,
                       dynamic_overwrite: bool = False, partition_first: str | None = None) -> None:
    """Fact as parquet partitioned by pickup date, sorted by pickup time in each file.

    Default is a full reload (static overwrite).  ``dynamic_overwrite``
    replaces only the partitions present in ``fact``, for month-by-month
    loads.  ``cluster`` adds the rebalance of ``cluster_by_time``.
    ``partition_first`` is a column to partition by above the date.
    """
    out = fact if PARTITION_COL in fact.columns else fact.withColumn(
        PARTITION_COL, F.to_date(F.col("pickup_datetime")))
    if cluster:
        out = cluster_by_time(out)
    parts = [c for c in (partition_first, PARTITION_COL) if c]
    out = out.sortWithinPartitions(*parts, "pickup_datetime")
    cols = [c for c in out.columns if c not in parts]
    (out.select(*cols, *parts).write.mode("overwrite").partitionBy(*parts)
     .option("partitionOverwriteMode", "dynamic" if dynamic_overwrite else "static").parquet(path))


def read_fact_parquet(spark: SparkSession, path: str, date_from: str | None = None,
                      date_to: str | None = None) -> DataFrame:
    """The 23 fact columns; optional inclusive date bounds prune partitions."""
    df = spark.read.parquet(path)
    if date_from is not None:
        df = df.filter(F.col(PARTITION_COL) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.filter(F.col(PARTITION_COL) <= F.lit(date_to).cast("date"))
    return df.select(*FACT_COLUMNS)


def write_fact_table(fact: DataFrame, table: str, path: str | None = None) -> None:
    """Reload a catalog table, keeping its definition (truncate semantics).

    The first load creates the table (at ``path`` when given, a shared
    location); later loads overwrite its rows in place with ``insertInto``,
    so the table, its location and anything defined on it stay.
    """
    spark = fact.sparkSession
    if spark.catalog.tableExists(table):
        fact.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
        return
    writer = fact.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


# Connections a load opens to the warehouse unless told otherwise.
JDBC_WRITERS = 16


def jdbc_options(url: str, table: str, user: str, password: str, driver: str,
                 batch_size: int = 10_000, num_partitions: int = JDBC_WRITERS) -> dict[str, str]:
    """Writer options; ``num_partitions`` caps the concurrent connections (Spark coalesces to it)."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        # Empty the table instead of dropping it, so dependent views survive.
        "truncate": "true",
        "batchsize": str(batch_size),
        "numPartitions": str(num_partitions),
    }


def write_fact_jdbc(fact: DataFrame, options: dict[str, str]) -> None:
    """Load the fact into a warehouse table over JDBC (truncate + insert)."""
    fact.write.format("jdbc").options(**options).mode("overwrite").save()


def jdbc_read_options(options: dict[str, str], query: str | None = None, column: str | None = None,
                      bounds: tuple[str, str] | None = None, partitions: int = JDBC_WRITERS) -> dict[str, str]:
    """Reader options from writer options: write-only keys go.

    ``query`` replaces the table name (the warehouse evaluates it, e.g. a
    view) and is read in one task: it is for aggregated results.  A table is
    read in ``partitions`` tasks by ranges of ``column`` between ``bounds``.
    """
    opts = {k: v for k, v in options.items() if k not in ("truncate", "batchsize", "numPartitions")}
    if query is not None:
        opts.pop("dbtable", None)
        opts["query"] = query
    elif column is not None and bounds is not None:
        opts.update(partitionColumn=column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
                    numPartitions=str(partitions))
    else:
        raise ValueError("a table is read by ranges: give column and bounds")
    return opts


def read_jdbc(spark: SparkSession, options: dict[str, str], query: str | None = None, **ranges) -> DataFrame:
    """Read a warehouse table (by ranges) or a query's result over JDBC."""
    return spark.read.format("jdbc").options(**jdbc_read_options(options, query, **ranges)).load()
