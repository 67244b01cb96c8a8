"""Volume probe: the load and the dashboard on k shifted copies of sf0.1.

Usage: python tools/volume_probe.py SCRATCH_DIR [k] [cluster 0/1]

The sf0.1 trip fixture is replicated k times with pickup times shifted by
whole months (a generator, ``explode(sequence(...))``; no join), written as
64 unordered files under SCRATCH_DIR/raw (once), then loaded with
``run_etl`` and summarised through the one-pass dashboard and through the
17 direct views.  Prints one JSON line with timings and sizes.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv: list[str]) -> None:
    from pyspark.sql import functions as F

    from farelens.operators.dims import dim_payment_type, dim_vendor
    from farelens.plans.etl import EtlConfig, run_etl
    from farelens.plans.rollup import materialize_rollup, views_from_rollup
    from farelens.plans.views import build_views
    from farelens.session import build_session
    from farelens.sources import io
    from farelens.sources.fixtures import raw_trips

    run, k = argv[1], int(argv[2]) if len(argv) > 2 else 100
    cluster = (argv[3] if len(argv) > 3 else "1") == "1"
    spark = build_session("local[8]", app_name="farelens-volume", shuffle_partitions=8,
                          extra_conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    out: dict[str, object] = {"copies": k, "cluster": cluster}
    if not os.path.exists(f"{run}/raw"):
        copies = (raw_trips(spark, "/root/testdata/sf0.1")
                  .withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
                  .withColumn("lpep_pickup_datetime", F.expr("lpep_pickup_datetime + make_interval(0, _i)"))
                  .withColumn("lpep_dropoff_datetime", F.expr("lpep_dropoff_datetime + make_interval(0, _i)"))
                  .drop("_i", "trip_key"))
        t = time.perf_counter()
        copies.repartition(64).write.parquet(f"{run}/raw")
        out["generate_sec"] = round(time.perf_counter() - t, 2)
    fact_path = f"{run}/fact_{int(cluster)}"
    t = time.perf_counter()
    res = run_etl(spark, EtlConfig(raw_paths=[f"{run}/raw"], fact_path=fact_path, cluster_fact=cluster),
                  build_views=False)
    out["etl_load_sec"] = round(time.perf_counter() - t, 2)
    fact = io.read_fact_parquet(spark, fact_path)
    pay, ven = dim_payment_type(spark), dim_vendor(spark)
    t = time.perf_counter()
    rollup = materialize_rollup(fact)
    for view in views_from_rollup(rollup, pay, ven).values():
        view.collect()
    out["dashboard_rollup_sec"] = round(time.perf_counter() - t, 2)
    t = time.perf_counter()
    for view in build_views(fact, {"dim_payment_type": pay, "dim_vendor": ven}).values():
        view.collect()
    out["views_direct_sec"] = round(time.perf_counter() - t, 2)
    out.update(raw_rows=res.raw_rows, clean_rows=res.clean_rows, rollup_rows=rollup.count(),
               fact_files=len(glob.glob(f"{fact_path}/*/*.parquet")),
               etl_rows_per_sec=round(res.raw_rows / out["etl_load_sec"]))
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
