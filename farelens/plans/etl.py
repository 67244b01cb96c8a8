"""The batch job: extract (land a raw copy), transform, load, then views.

``run_etl`` scans the raw columns once.  The raw count comes from the file
footers (a count without columns); the clean count is collected with an
``Observation`` while the fact is written.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farelens.functions.features import add_features
from farelens.operators.dims import dim_payment_type, dim_vendor
from farelens.operators import quality
from farelens.plans.rollup import materialize_rollup, views_from_rollup, write_rollup
from farelens.schema import FACT_COLUMNS, RAW_COLUMNS
from farelens.sources import io
from farelens.sources.catalog import store_views
from farelens.sources.versions import publish


@dataclass
class EtlConfig:
    raw_paths: list[str]
    fact_path: str
    lake_path: str | None = None          # land a raw copy here first (extract)
    fact_table: str | None = None         # also (re)load a catalog table
    # Keep that table's rows as versions here and switch to the new one at the end, so that
    # readers see no gap and a load that fails changes nothing.
    versions_path: str | None = None
    jdbc: dict[str, str] | None = None    # also load a warehouse over JDBC
    # Rebalance by pickup date before the write (AQE-sized, hot dates split).
    # None: only if the input is not in date order already, or too small to occupy all cores.
    cluster_fact: bool | None = None
    dynamic_overwrite: bool = False       # replace only the dates being loaded
    month: str | None = None              # load month of raw files whose names don't tell
    # Store rejected rows, too: the fact then lies under fact_path/verdict=clean.
    keep_rejects: bool = False
    database: str | None = None           # store fact, dimensions and views in this catalog database
    rollup_path: str | None = None        # keep the views' rollup as a table for later sessions


@dataclass
class EtlResult:
    raw_rows: int
    clean_rows: int
    fact_path: str
    views: dict[str, DataFrame] = field(default_factory=dict)
    rollup: DataFrame | None = None

    @property
    def removed_rows(self) -> int:
        return self.raw_rows - self.clean_rows

    @property
    def removed_pct(self) -> float:
        """Removal rate in percent, 2 dp half-up (as the SQL side rounds)."""
        if not self.raw_rows:
            return 0.0
        pct = Decimal(100 * self.removed_rows) / Decimal(self.raw_rows)
        return float(pct.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def extract(spark: SparkSession, src_paths: list[str], lake_path: str, month: str | None = None) -> DataFrame:
    """Land the raw files with all their columns in the lake, by month; returns the raw scan of the lake."""
    io.land_files(spark, src_paths, lake_path, month)
    return io.read_raw(spark, lake_path)


def _scanned(spark: SparkSession, cfg: EtlConfig) -> tuple[DataFrame, int]:
    """The job's raw records and their number, from one look at the footers."""
    if cfg.lake_path is None:
        return io.scan_raw(spark, *cfg.raw_paths)
    io.land_files(spark, cfg.raw_paths, cfg.lake_path, cfg.month)
    return io.scan_raw(spark, cfg.lake_path)


def in_date_order(raw: DataFrame, slack: int = 2) -> bool:
    """Whether writing ``raw`` by date as it lies makes few files.

    Reads the pickup column only: counts the (task, date) pairs, each of
    which would become a file.  In order, a task's dates are its own but for
    the first and last, so pairs stay near dates + tasks.
    """
    pairs = raw.select(F.spark_partition_id().alias("task"), F.to_date("lpep_pickup_datetime").alias("day"))
    n = (pairs.groupBy("task", "day").agg(F.lit(1).alias("one"))
         .agg(F.count("one").alias("pairs"), F.countDistinct("day").alias("days"),
              F.countDistinct("task").alias("tasks")).first())
    return n.pairs <= slack * (n.days + n.tasks)


def wants_clustering(raw: DataFrame) -> bool:
    """Whether rows should be rebalanced by date before the write.

    Yes if they lie in no date order.  Also if the scan has fewer tasks than
    there are cores: the exchange then spreads features and write over all.
    """
    few = raw.rdd.getNumPartitions() < raw.sparkSession.sparkContext.defaultParallelism
    return few or not in_date_order(raw)


def transform(raw: DataFrame, cluster: bool = False) -> tuple[DataFrame, Observation]:
    """Filtered, featured fact with its date column, plus the clean count.

    The gate comes first.  With ``cluster`` only the seven raw columns of
    clean rows and the date cross the rebalance; features are derived after
    it.  The count is observed in the write stage: a result stage applies
    each partition's metrics once, while a re-executed shuffle map stage
    could count rows twice.
    """
    clean = quality.quality_filter(add_features(raw)).select(*RAW_COLUMNS)
    if cluster:
        clean = io.cluster_by_time(clean.withColumn(io.PARTITION_COL, F.to_date("lpep_pickup_datetime")))
    count = Observation("clean")
    fact = add_features(clean).observe(count, F.count(F.lit(1)).alias("rows"))
    if not cluster:
        fact = fact.withColumn(io.PARTITION_COL, F.to_date("lpep_pickup_datetime"))
    return fact.select(*FACT_COLUMNS, io.PARTITION_COL), count


def load_split(raw: DataFrame, path: str, cluster: bool = False) -> tuple[int, int]:
    """Write clean and rejected rows with their features from one scan; returns (raw, clean) counts.

    Clean rows lie under ``path``/verdict=clean, a fact by date, rejected ones
    under verdict=rejected with the rules they fail.  Both counts are
    observed in the write.
    """
    if cluster:
        raw = io.cluster_by_time(raw.withColumn(io.PARTITION_COL, F.to_date("lpep_pickup_datetime"))).drop(io.PARTITION_COL)
    counts = Observation("split")
    rows = quality.judged(add_features(raw)).withColumn(io.PARTITION_COL, F.to_date("lpep_pickup_datetime")).select(
        *FACT_COLUMNS, "reject_reasons", "n_failed_rules", quality.VERDICT, io.PARTITION_COL)
    rows = rows.observe(counts, F.count(F.lit(1)).alias("raw"),
                        F.count_if(F.col(quality.VERDICT) == quality.CLEAN).alias("clean"))
    rows = rows.sortWithinPartitions(quality.VERDICT, io.PARTITION_COL, "pickup_datetime")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(quality.VERDICT, io.PARTITION_COL).parquet(path))
    return int(counts.get["raw"]), int(counts.get["clean"])


def stored_rejects(spark: SparkSession, split_path: str) -> DataFrame:
    """The rejected rows of the last load: fact columns, reject_reasons, n_failed_rules."""
    rows = spark.read.parquet(split_path).filter(F.col(quality.VERDICT) == quality.REJECTED)
    return rows.select(*FACT_COLUMNS, "reject_reasons", "n_failed_rules")


def load(fact: DataFrame, cfg: EtlConfig) -> None:
    io.write_fact_parquet(fact, cfg.fact_path, dynamic_overwrite=cfg.dynamic_overwrite)


def run_etl(spark: SparkSession, cfg: EtlConfig, build_views: bool = True,
            raw: DataFrame | None = None) -> EtlResult:
    """Extract -> transform -> load; then the 17 views over the written fact.

    ``raw`` replaces the raw file scan (for inputs Spark derives elsewhere).
    The views come from one rollup pass over the written fact and are also
    registered as temp views under their names.  With ``cfg.database`` they
    are stored in the catalog as well, for other sessions.
    """
    raw_rows = None
    if raw is None:
        raw, raw_rows = _scanned(spark, cfg)
    cluster = cfg.cluster_fact if cfg.cluster_fact is not None else wants_clustering(raw)
    fact_path = cfg.fact_path
    if cfg.keep_rejects:
        raw_rows, clean_rows = load_split(raw, cfg.fact_path, cluster)
        fact_path = f"{cfg.fact_path.rstrip('/')}/{quality.VERDICT}={quality.CLEAN}"
    else:
        fact, clean = transform(raw, cluster=cluster)
        load(fact, cfg)
        raw_rows, clean_rows = raw.count() if raw_rows is None else raw_rows, int(clean.get["rows"])
    result = EtlResult(raw_rows=raw_rows, clean_rows=clean_rows, fact_path=fact_path)
    # Secondary sinks read the written fact, not the raw data again.
    written = io.read_fact_parquet(spark, fact_path)
    if cfg.fact_table and cfg.versions_path:
        publish(written.withColumn(io.PARTITION_COL, F.to_date("pickup_datetime")), cfg.fact_table, cfg.versions_path,
                partition_by=[io.PARTITION_COL])
    elif cfg.fact_table:
        io.write_fact_table(written, cfg.fact_table)
    if cfg.jdbc:
        io.write_fact_jdbc(written, cfg.jdbc)
    if build_views:
        pay, ven = dim_payment_type(spark), dim_vendor(spark)
        written.createOrReplaceTempView("fact_trips")
        pay.createOrReplaceTempView("dim_payment_type")
        ven.createOrReplaceTempView("dim_vendor")
        result.rollup = (write_rollup(written, cfg.rollup_path) if cfg.rollup_path
                         else materialize_rollup(written))
        result.views = views_from_rollup(result.rollup, pay, ven)
        for name, view in result.views.items():
            view.createOrReplaceTempView(name)
        if cfg.database:
            store_views(spark, cfg.database, fact_path, {"dim_payment_type": pay, "dim_vendor": ven},
                        {"dim_payment_type": "payment_type", "dim_vendor": "vendor_id"})
    return result
