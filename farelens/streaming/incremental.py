"""The scheduled load as an incremental file stream.

Each scheduled run (daily, say) processes only raw files that arrived since
the previous run: a Structured Streaming file source with
``trigger(availableNow=True)`` names the new files, and every micro-batch
reads them with the batch job's own reader (each file by its footer schema,
the same casts and errors), gate and layout.

A batch is written as the partition ``load_batch=<id>`` of the fact with
dynamic overwrite.  The checkpoint fixes which files belong to a batch id, so
a batch that is run again after a failure replaces exactly its own rows:
every file counts once.  The checkpoint lies beside the data of its fact
(``_load_checkpoint``, which readers skip), so two facts loaded from one
folder don't share progress.

A file that is no raw trip file does not stop the load: it is named in the
batch's part of the quarantine table and the others are loaded.  With a
rollup path the batch's rollup is stored, too, so the views are brought up to
date from the new trips alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farelens.plans.etl import transform
from farelens.plans.rollup import LOAD_BATCH, write_rollup_batch
from farelens.session import storage_root
from farelens.sources import io
from farelens.sources.footers import FOOTERS, read_footers
from farelens.sources.ledger import split_files

QUARANTINE = "_quarantine"
# Files of one micro-batch; their names are all that reaches the driver.
FILES_PER_BATCH = 1_000
# Fixed columns of Spark's binary file source.
_FILE = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, raw_dir: str, max_files: int = FILES_PER_BATCH) -> DataFrame:
    """Paths of new raw files under ``raw_dir`` as a stream (contents are not read)."""
    return (spark.readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", str(max_files)).load(raw_dir).select("path"))


def load_batch(spark: SparkSession, files: list[str], batch_id: int, fact_path: str, rollup_path: str | None = None) -> int:
    """Write the fact rows of ``files`` as one batch partition; returns the raw rows read."""
    kept = f"{storage_root(spark)}/load_footers/{uuid.uuid4().hex}"
    read_footers(spark, *files).write.parquet(kept)
    sound, refused = split_files(spark.read.schema(FOOTERS).parquet(kept))
    (refused.select("path", "length", "modified", "reason", F.lit(batch_id).cast("long").alias(LOAD_BATCH))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD_BATCH)
     .parquet(f"{fact_path.rstrip('/')}/{QUARANTINE}"))
    if not sound.limit(1).count():
        return 0
    raw, n = io.scan_raw(spark, *files, footers=sound)
    fact, _ = transform(raw, cluster=True)
    io.write_fact_parquet(fact.withColumn(LOAD_BATCH, F.lit(batch_id).cast("long")), fact_path,
                          dynamic_overwrite=True, partition_first=LOAD_BATCH)
    if rollup_path:
        write_rollup_batch(io.read_fact_parquet(spark, f"{fact_path.rstrip('/')}/{LOAD_BATCH}={batch_id}"), rollup_path, batch_id)
    return n


def quarantined(spark: SparkSession, fact_path: str) -> DataFrame:
    """(path, length, modified, reason, load_batch) of the files that loads refused."""
    schema = "path string, length long, modified timestamp, reason string, load_batch long"
    return spark.read.schema(schema).parquet(f"{fact_path.rstrip('/')}/{QUARANTINE}")


def start_incremental_load(spark: SparkSession, raw_dir: str, fact_path: str,
                           checkpoint_location: str | None = None, available_now: bool = True,
                           rows_read: dict[int, int] | None = None, rollup_path: str | None = None) -> StreamingQuery:
    """Start the load; with ``available_now`` it stops once caught up.

    The checkpoint must live on storage every executor and the driver can
    reach; it defaults to a folder inside ``fact_path``.
    """
    ckpt = checkpoint_location or f"{fact_path.rstrip('/')}/_load_checkpoint"

    def write(batch: DataFrame, batch_id: int) -> None:
        files = [r.path for r in batch.collect()]
        n = load_batch(spark, files, batch_id, fact_path, rollup_path) if files else 0
        if rows_read is not None:
            rows_read[batch_id] = n

    writer = new_files(spark, raw_dir).writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()


def run_incremental_load(spark: SparkSession, raw_dir: str, fact_path: str,
                         checkpoint_location: str | None = None, rollup_path: str | None = None) -> int:
    """One scheduled run: process what arrived, wait; return raw rows read."""
    rows: dict[int, int] = {}
    start_incremental_load(spark, raw_dir, fact_path, checkpoint_location, rows_read=rows,
                           rollup_path=rollup_path).awaitTermination()
    return sum(rows.values())
