"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows get dense numbers 0..N-1 in a fixed order, the permutation maps number
x to y, and y alone tells the place: shard y mod S, slot y div S.  Shards
differ by at most one row, slots are gapless from 0, and the shard and slot
of any row number can be computed without the table.

Dense numbers need no global sort: rows are hashed into a fixed number of
buckets, numbered within their bucket, and shifted by the rows in earlier
buckets.  The numbering depends only on the rows, not on files or tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.common import materialize
from farelens.llm.feistel import permute

# Fixed, so that row numbers do not depend on the cluster; at 3e10 rows a
# bucket holds seven million narrow rows, sorted with spilling.
BUCKETS = 4096


def number_rows(df: DataFrame, order: list[str], buckets: int = BUCKETS,
                name: str = "row_number") -> DataFrame:
    """``df`` plus dense ``name`` from 0 and ``n_rows``.

    Rows equal in all ``order`` columns are numbered in any order; give all
    columns that matter.  NULLs are ordinary values.  ``df`` should be narrow
    and cheap to read twice (a materialized table).
    """
    keyed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most `buckets` rows: one small task, and a broadcast of fixed size.
    offsets = counts.select(
        "_bucket",
        (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("n_rows"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)) - 1
    return (keyed.withColumn("_within", within)
            .join(F.broadcast(offsets), "_bucket")
            .withColumn(name, F.col("_before") + F.col("_within"))
            .drop("_bucket", "_within", "_before"))


def place(row_number: Column, n_rows: Column, n_shards: int, key: str) -> tuple[Column, Column]:
    """(shard, slot) of a global row number; needs nothing but the number."""
    y = permute(row_number, n_rows, key)
    return (F.pmod(y, F.lit(n_shards)).cast("int"),
            F.floor(y / F.lit(n_shards)).cast("long"))


def shard_rows(df: DataFrame, order: list[str], n_shards: int, key: str = "shuffle-1") -> DataFrame:
    """``df`` plus ``shard`` and ``slot``.  An empty table stays empty."""
    numbered = number_rows(df, order)
    shard, slot = place(F.col("row_number"), F.col("n_rows"), n_shards, key)
    return numbered.select(*df.columns, "row_number", shard.alias("shard"), slot.alias("slot"))


def shard_documents(docs: DataFrame, n_shards: int = 24, key: str = "shuffle-1") -> DataFrame:
    """Places every document; the text itself never moves.

    Size is the text's UTF-8 bytes plus 8; a NULL text has no bytes (crc 0).
    Repeated rows each get a slot of their own.  Law ``rows``: shard counts
    at most one apart; ``grown_shard`` is NULL under this law.
    """
    digest = materialize(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0).cast("long")).alias("text_crc32")),
        "shard_digest")
    placed = shard_rows(digest, ["doc_id", "size", "text_crc32"], n_shards, key)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row_number")
