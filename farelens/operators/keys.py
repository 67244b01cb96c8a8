"""Dense surrogate keys (the warehouse's SERIAL) without moving a row.

SERIAL promises unique, growing numbers, not an order.  So rows of a stored
table are numbered where they lie: rows per scan task are counted (a scan
without columns, from the file footers), running totals over the tasks give
each task its first number, and a row's number is that plus its position.
No row crosses an exchange and nothing is staged.

The numbers follow the table's files and the session's split size.  Store
them (``write_with_ids``) to fix them for good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_TASK = "__task"
# Offsets (one row of 16 bytes per scan task) that are broadcast.
MOST_TASKS = 1 << 20
_POSITION_BITS = 33  # of monotonically_increasing_id: the row's position in its task


def task_offsets(stored: DataFrame) -> DataFrame:
    """(task, first): rows in earlier tasks; one row per scan task."""
    counts = (stored.select(F.spark_partition_id().alias(_TASK)).groupBy(_TASK)
              .agg(F.count(F.lit(1)).alias("n")))
    before = Window.orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(_TASK, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))


def assign_dense_id(spark: SparkSession, path: str, id_col: str = "trip_id") -> DataFrame:
    """Rows of the parquet table at ``path`` with ``id_col`` = 1..N.

    Only the offsets are joined, two small columns per scan task.  The
    planner takes them to be as large as the table they count, so they are
    broadcast by hand; a scan of more than ``MOST_TASKS`` tasks is an error
    (raise ``spark.sql.files.maxPartitionBytes``).
    """
    stored = spark.read.parquet(path)
    if stored.rdd.getNumPartitions() > MOST_TASKS:
        raise ValueError(f"a scan of more than {MOST_TASKS} tasks: raise spark.sql.files.maxPartitionBytes")
    place = F.monotonically_increasing_id()
    placed = stored.withColumns({
        _TASK: F.shiftright(place, _POSITION_BITS).cast("int"),
        id_col: place.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))})
    return (placed.join(F.broadcast(task_offsets(stored)), _TASK)
            .withColumn(id_col, F.col(id_col) + F.col("first") + 1)
            .select(id_col, *stored.columns))


def write_with_ids(spark: SparkSession, path: str, out_path: str, id_col: str = "trip_id") -> None:
    """Number the table at ``path`` once and store it with its numbers."""
    assign_dense_id(spark, path, id_col).write.mode("overwrite").parquet(out_path)
