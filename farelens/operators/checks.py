"""Table constraints re-aimed as data checks that return offending rows.

Spark tables do not enforce keys, so primary-key uniqueness, foreign keys
and NOT NULL become queries.  The primary key check sends a few bits per row
through the shuffle, the others one row per distinct key per task.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.operators.hashlists import hash_of, repeated_hashes, space_for
from farelens.session import storage_root

_HASH, _TWICE = "__key_hash", "__key_twice"
# Hashes of repeated keys that are broadcast (16 bytes each); with more, rows are grouped as they are.
MOST_REPEATED = 1 << 20


def check_pk(df: DataFrame, keys: list[str], rows: int | None = None, most_repeated: int = MOST_REPEATED) -> DataFrame:
    """Key values that occur more than once or contain a NULL, with counts.

    Two passes.  The first finds the hashes of keys that two rows share from
    compressed lists (a job of its own); the second groups only the rows with
    such a hash, so next to nothing of a sound key is shuffled.  Equal keys
    have equal hashes, so none is missed; unequal ones that share a hash fall
    out again.  Where very many keys repeat, all rows are grouped, which
    the map side then shrinks.

    ``rows`` is the table's size if known; otherwise they are counted.
    """
    spark = df.sparkSession
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    cuts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    space = space_for(max(1, df.count() if rows is None else rows), cuts)
    h = hash_of(keys, cuts, space).alias(_HASH)
    path = f"{storage_root(spark)}/check_pk/{uuid.uuid4().hex}"
    repeated_hashes(df.filter(~any_null).select(h), cuts, space).write.parquet(path)
    found = spark.read.schema("hash long").parquet(path)
    some = df.select(*keys, h)
    if found.count() <= most_repeated:
        some = some.join(F.broadcast(found.select(F.col("hash").alias(_HASH), F.lit(True).alias(_TWICE))), _HASH, "left").filter(
            F.col(_TWICE).isNotNull() | any_null)
    return (some.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .filter((F.col("n_rows") > 1) | any_null))


def check_fk(df: DataFrame, fk: str, dim: DataFrame, dim_key: str, out_name: str | None = None) -> DataFrame:
    """Non-NULL foreign-key values without a dimension row, with row counts.

    The fact side is reduced to one row per distinct key first; the anti join
    then works on distinct keys only, and the planner broadcasts the
    dimension when its size allows.
    """
    out = out_name or fk
    per_key = (df.filter(F.col(fk).isNotNull())
               .groupBy(F.col(fk).alias(out))
               .agg(F.count(F.lit(1)).alias("n_rows")))
    return per_key.join(dim.select(F.col(dim_key).alias(out)), on=out, how="left_anti")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, null_count) for every column: one aggregate pass."""
    cols = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")
