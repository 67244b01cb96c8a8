"""Schemas and row counts of raw parquet files, read from their footers in one Spark job.

Spark lists the files; its tasks open only the footers, so the driver opens
none however many months a lake holds.  The result is a table, one row per
file, that can be kept beside the lake: a later scan opens the footers of new
or changed files only.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOOTERS = "path string, length long, modified timestamp, `schema` string, row_count long, error string"
KEPT = "_footers"
# Where Spark stores a file's own schema.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
# Schemes that Arrow's file systems open; the S3 ones by the session's s3a settings.
_S3 = ("s3", "s3a", "s3n")
SCHEMES = ("file", "hdfs", "gs", "abfs", "abfss", *_S3)


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, length, modified) of the files under ``paths``: globs, folders, partitioned folders.

    Names that begin with ``_`` or ``.`` and files without a byte are no data,
    as in Spark's own scans.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def _s3_options(spark: SparkSession) -> dict[str, str]:
    conf = spark.sparkContext.getConf()
    names = {"access_key": "access.key", "secret_key": "secret.key", "endpoint_override": "endpoint"}
    found = {k: conf.get(f"spark.hadoop.fs.s3a.{v}", None) for k, v in names.items()}
    return {k: v for k, v in found.items() if v}


def _spark_type(kind: pa.DataType, physical: str | None) -> T.DataType:
    """The type that Spark's parquet reader gives a column of this Arrow type."""
    from pyspark.sql.pandas.types import from_arrow_type

    wider = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64(), pa.uint64(): pa.decimal128(20, 0)}
    if physical == "INT96":                      # always an instant
        return T.TimestampType()
    if pa.types.is_timestamp(kind) and kind.unit == "ns":
        raise TypeError("Spark reads no nanoseconds")
    return from_arrow_type(wider.get(kind, kind), prefer_timestamp_ntz=True)


def footer_schema(meta) -> str | None:
    """A file's schema as Spark reads it, as JSON; None for types that only Spark can tell."""
    stored = (meta.metadata or {}).get(_SPARK_SCHEMA)
    if stored:
        return T.StructType.fromJson(json.loads(stored)).toNullable().json()
    physical = {c.path: c.physical_type for c in (meta.schema.column(i) for i in range(len(meta.schema)))}
    try:
        return T.StructType([T.StructField(f.name, _spark_type(f.type, physical.get(f.name)), True)
                             for f in meta.schema.to_arrow_schema()]).toNullable().json()
    except Exception:
        return None


def _open_footers(s3: dict[str, str]):
    def opened(path: str):
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        url = urlparse(path)
        if url.scheme in _S3:
            system, name = fs.S3FileSystem(**s3), f"{url.netloc}{unquote(url.path)}"
        elif url.scheme in ("", "file"):
            system, name = fs.LocalFileSystem(), unquote(url.path)
        else:
            system, name = fs.FileSystem.from_uri(path)
        return pq.read_metadata(name, filesystem=system)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schemas, counts, errors = [], [], []
            for path in batch.column("path").to_pylist():
                schema = count = error = None
                try:
                    meta = opened(path)
                    schema, count = footer_schema(meta), meta.num_rows
                except pa.ArrowInvalid as e:             # no parquet file; a store out of reach fails the task
                    error = str(e).split("\n")[0]
                schemas.append(schema)
                counts.append(count)
                errors.append(error)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("path", "length", "modified")), pa.array(schemas, pa.string()),
                 pa.array(counts, pa.int64()), pa.array(errors, pa.string())],
                names=["path", "length", "modified", "schema", "row_count", "error"])

    return run


def _by_spark(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The same rows for stores that only Spark's readers open: one small job a file."""
    rows = []
    for r in files.collect():
        schema = count = error = None
        try:
            df = spark.read.parquet(r.path)
            schema, count = df.schema.json(), df.count()
        except Exception as e:
            error = str(e).split("\n")[0]
        rows.append((r.path, r.length, r.modified, schema, count, error))
    return spark.createDataFrame(rows, FOOTERS)


def read_footers(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per file under ``paths``: path, length, modified, schema, row_count, error.

    ``schema`` is Spark's JSON, NULL where only Spark can tell it; ``error``
    says why a file is no parquet file.
    """
    return _footers_of(spark, list_files(spark, *paths), paths)


def _footers_of(spark: SparkSession, files: DataFrame, paths: tuple[str, ...]) -> DataFrame:
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    schemes = {urlparse(p).scheme or urlparse(default).scheme for p in paths}
    if not schemes <= set(SCHEMES):
        return _by_spark(spark, files)
    return files.mapInArrow(_open_footers(_s3_options(spark)), FOOTERS)


def keep_footers(spark: SparkSession, lake: str, *paths: str) -> DataFrame:
    """``read_footers`` with a table kept at ``lake``/_footers, to which new and changed files are added.

    Rows of files that changed or went stay in the table and are passed over.
    """
    kept = f"{lake.rstrip('/')}/{KEPT}"
    empty = spark.createDataFrame([], FOOTERS)
    empty.write.mode("append").parquet(kept)
    known = spark.read.schema(FOOTERS).parquet(kept)
    same = ["path", "length", "modified"]
    files = list_files(spark, *paths)
    _footers_of(spark, files.join(known, same, "left_anti"), paths).write.mode("append").parquet(kept)
    return spark.read.schema(FOOTERS).parquet(kept).join(files, same, "left_semi").dropDuplicates(same)
