"""Shared helpers: scratch tables in the shared folder, Arrow batch assembly."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.session import storage_root

WORD = "[^\\x20\\x09-\\x0D]+"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, never used by another call."""
    return f"{storage_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with a copy every executor can reach, so a lost executor
    costs at most the current stage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


# Rows of a narrow table that one task writes.
ROWS_PER_FILE = 20_000


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, the outcome of a shuffle with about ``rows`` narrow rows, in a file per ROWS_PER_FILE of them.

    Creating a file costs an executor more than filling it with a few rows: on
    a local or mounted folder Hadoop starts ``chmod`` for the file and its
    checksums.  Partitions are only put together, without a shuffle; ``df``
    stays as it is where a shuffle makes no more of them than that.
    """
    wanted = max(2, -(-rows // ROWS_PER_FILE))
    if wanted >= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.coalesce(wanted)


def word_count(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space (NULL: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Hash values kept by ``may_have``; bounds what it broadcasts (16 bytes a value).
FILTER_VALUES = 1 << 20


def may_have(df: DataFrame, keys: list[str], wanted: DataFrame, absent: bool = False) -> DataFrame:
    """Rows of ``df`` whose key may be in ``wanted`` (``absent``: those whose key is surely not).

    A filter in front of a shuffle, like a Bloom filter: keys are hashed to
    FILTER_VALUES values and the set of those is broadcast, whose size does
    not grow with the data.  With very many keys it lets everything pass.
    """
    value = F.pmod(F.xxhash64(*keys), F.lit(FILTER_VALUES))
    values = wanted.select(value.alias("__value")).distinct()
    return df.join(F.broadcast(values), value == values["__value"], "left_anti" if absent else "left_semi")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash partitions by ``keys`` for work that costs far more time than its bytes tell.

    The number is given, so that the planner does not pack them together by size.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
