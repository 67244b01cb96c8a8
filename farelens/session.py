"""Session settings and shared storage locations.

Durations and DATE() depend on the session time zone (the raw timestamps are
wall-clock values), so the session is pinned to UTC.  ANSI mode stays on; the
one unguarded division of the original job goes through ``try_divide``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale.  Aggregation keys in this workload are all
# low-cardinality, so shuffles after partial aggregation are tiny; AQE
# coalesces them and splits skewed partitions if a join ever meets one.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target size AQE uses when it coalesces or splits shuffle partitions;
    # for the date-rebalanced fact write this is roughly the file size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Call-site capture for error messages costs several py4j round trips
    # per Column function while a plan is being built; off for batch jobs.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The fused scan -> features -> quality gate -> partial aggregate stage
    # generates a method just over HotSpot's 8000-byte JIT limit; without
    # this flag that hot loop would run in the bytecode interpreter.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(master: str | None = None, app_name: str = "farelens",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def object_store_conf(endpoint: str, access_key: str, secret_key: str,
                      path_style: bool = True) -> dict[str, str]:
    """Settings for an S3-compatible object store (``s3a://`` paths).

    Pass to ``build_session(extra_conf=...)``; the path scheme then picks the
    filesystem.  Credentials come from the caller (environment, secrets
    store), never from defaults in code.
    """
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true" if path_style else "false",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def pin_session(spark: SparkSession) -> None:
    """Apply the settings the results depend on to a session built elsewhere."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # pragma: no cover - conf lookup never fails in practice
        value = None
    if not value:
        value = spark.sparkContext.getConf().get(key, None)
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    (tests) gets one of its own when nothing is set; elsewhere that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = _conf(spark, "spark.checkpoint.dir")
    if not configured:
        if not sc.master.split("[")[0] == "local":
            # A folder of the driver's machine is out of the executors' reach.
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {sc.master}")
        configured = tempfile.mkdtemp(prefix="farelens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def storage_root(spark: SparkSession) -> str:
    """Shared folder for lake copies and fact tables written by the jobs.

    ``spark.farelens.storage.root`` wins; otherwise a ``farelens`` folder next
    to the checkpoint data in ``spark.checkpoint.dir``.
    """
    root = _conf(spark, "spark.farelens.storage.root")
    if root:
        return root.rstrip("/")
    configured = _conf(spark, "spark.checkpoint.dir")
    if not configured:
        configured = ensure_checkpoint_dir(spark)
    return os.path.join(configured.rstrip("/"), "farelens")
