"""Landing with a ledger: each raw file is copied once, bad files are set aside and named.

The ledger beside the lake has a row per file that a run dealt with: path,
length, time, and whether it was landed or refused and why.  A file is known
by these three; one that was delivered again in another form is landed again
and replaces its own copy.  Rows are written before the ledger says so, into
a partition of the file's own, so a run that died is simply run again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.schema import RAW_SCHEMA
from farelens.session import storage_root
from farelens.sources import io
from farelens.sources.footers import keep_footers

LEDGER = "path string, length long, modified timestamp, status string, reason string, load_month string, row_count long, run string"
KEPT = "_ledger"
LANDED, REFUSED = "landed", "refused"
LOAD_FILE = "load_file"
_SAME = ["path", "length", "modified"]


@dataclass
class Landing:
    run: str
    files: int       # new files
    landed: int
    refused: int
    rows: int        # copied


def refusal() -> Column:
    """Why a file of ``read_footers`` cannot be read as raw trips (NULL: it can)."""
    names = F.get_json_object("schema", "$.fields[*].name")
    lacks = F.concat_ws(",", *[F.when(~F.contains(names, F.lit(f'"{f.name}"')), f.name) for f in RAW_SCHEMA.fields])
    return (F.when(F.col("error").isNotNull(), F.concat(F.lit("no parquet file: "), "error"))
            .when(F.col("schema").isNotNull() & (lacks != ""), F.concat(F.lit("lacks columns "), lacks)))


def split_files(footers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound files, refused files with their ``reason``)."""
    judged = footers.withColumn("reason", refusal())
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def month_column(path: Column) -> Column:
    """The last ``YYYY-MM`` in a path, as ``io.month_of``; NULL without one."""
    found = F.regexp_extract_all(path, F.lit(r"(?<!\d)(\d{4}-(?:0[1-9]|1[0-2]))(?!\d)"), F.lit(1))
    return F.try_element_at(found, F.lit(-1))


def read_ledger(spark: SparkSession, lake: str) -> DataFrame:
    """All that runs did so far; ``status`` = refused is the quarantine."""
    kept = f"{lake.rstrip('/')}/{KEPT}"
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(kept)
    return spark.read.schema(LEDGER).parquet(kept)


def land_new_files(spark: SparkSession, src_paths: list[str], lake: str, month: str | None = None) -> Landing:
    """Copy files that the ledger does not know, with all their columns; refuse those that are no raw trips.

    A refused file stays where it is and is not tried again until it changes.
    Files lie in the lake by month and file; one write per schema.
    """
    run = uuid.uuid4().hex
    month_in = F.lit(month) if month else month_column(F.col("path"))
    known = read_ledger(spark, lake)
    fresh = keep_footers(spark, lake, *src_paths).join(known.select(*_SAME), _SAME, "left_anti")
    reason = F.coalesce(refusal(), F.when(F.col("load_month").isNull(), F.lit("no month in its name")))
    # What this run does is fixed before it copies.
    plan_path = f"{storage_root(spark)}/landing/{run}"
    (fresh.withColumn("load_month", month_in).withColumn("reason", reason)
     .withColumn("status", F.when(F.col("reason").isNull(), LANDED).otherwise(REFUSED))).write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    sound = plan.filter(F.col("status") == LANDED)
    here = F.col("_metadata.file_path")
    if sound.limit(1).count():
        for schema, files, _ in io.schema_groups(spark, footers=sound):
            rows = spark.read.schema(schema).parquet(*files)
            (rows.withColumns({io.LOAD_MONTH: F.lit(month) if month else month_column(here), LOAD_FILE: F.md5(here)})
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(io.LOAD_MONTH, LOAD_FILE).parquet(lake))
    done = plan.select(*_SAME, "status", "reason", "load_month", "row_count", F.lit(run).alias("run"))
    done.write.mode("append").parquet(f"{lake.rstrip('/')}/{KEPT}")
    n = plan.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("status") == LANDED).alias("landed"),
                 F.sum(F.when(F.col("status") == LANDED, F.col("row_count"))).alias("n")).first()
    return Landing(run, n.files, n.landed, n.files - n.landed, n.n or 0)
