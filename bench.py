"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

An untimed warm-up runs the same paths on sf0.001 first.  Timed work
(each forces full computation; row outputs go to Spark's
``noop`` sink or are collected when they are a handful of aggregate rows):
- etl_load: fixture -> quality gate -> features -> fact parquet (counts from
  the footers and an Observation)
- dashboard_rollup: the 17 views from one rollup pass over the written fact
- views_direct: the 17 views one by one over the written fact (17 scans)
- end-to-end registry queries from the events table

Per query, ``stage_metrics`` reports input bytes, shuffle bytes written,
spill and task count, read from Spark's event log in a scratch folder.
Shuffle and spill bytes are exact; input bytes come from per-thread
filesystem counters and are approximate when tasks share one JVM.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def _sf_of(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def stage_metrics(eventlog_dir: str) -> dict[str, dict[str, int]]:
    """Per job description: input bytes, shuffle bytes written, spill, tasks.

    Read from Spark's event log (written to a scratch folder), the same
    numbers the UI would show, without starting it.
    """
    stage_owner: dict[int, str] = {}
    totals: dict[str, dict[str, int]] = {}
    for path in glob.glob(os.path.join(eventlog_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    if desc:
                        for sid in ev.get("Stage IDs", []):
                            stage_owner[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    owner = stage_owner.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if owner is None or not m:
                        continue
                    t = totals.setdefault(owner, {"input_bytes": 0, "shuffle_write_bytes": 0,
                                                  "spill_bytes": 0, "tasks": 0})
                    t["input_bytes"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                    t["shuffle_write_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    t["spill_bytes"] += m.get("Disk Bytes Spilled", 0)
                    t["tasks"] += 1
    return totals


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from farelens.operators.dims import dim_payment_type, dim_vendor
    from farelens.plans.etl import EtlConfig, run_etl
    from farelens.plans.registry import all_queries
    from farelens.plans.rollup import materialize_rollup, views_from_rollup
    from farelens.plans.views import build_views
    from farelens.session import build_session, storage_root
    from farelens.sources import io
    from farelens.sources.fixtures import raw_trips

    # Local benchmark only: the event log goes to a fresh scratch folder.
    # BENCH_EVENTLOG=0 turns the metrics (and their small overhead) off.
    use_eventlog = os.environ.get("BENCH_EVENTLOG", "1") != "0"
    conf = {"spark.driver.memory": "16g"}
    eventlog_dir = None
    if use_eventlog:
        eventlog_dir = os.environ.get("BENCH_EVENTLOG_DIR") or tempfile.mkdtemp(prefix="farelens-bench-events-")
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": eventlog_dir,
                     "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
    spark = build_session(f"local[{cpus}]", app_name="farelens-bench", shuffle_partitions=cpus,
                          extra_conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    run_dir = f"{storage_root(spark)}/bench/{uuid.uuid4().hex}"
    timings: dict[str, float] = {}

    def timed(name, fn):
        sc.setJobDescription(name)
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        sc.setJobDescription(None)
        return out

    # JVM warm-up, not timed: run the same code paths once on the smallest
    # data set so JIT and codegen caches are hot, as on long-lived executors.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.exists(f"{warm_dir}/events.parquet"):
        wcfg = EtlConfig(raw_paths=[], fact_path=f"{run_dir}/warmup_fact")
        run_etl(spark, wcfg, build_views=False, raw=raw_trips(spark, warm_dir))
        wfact = io.read_fact_parquet(spark, wcfg.fact_path)
        for v in views_from_rollup(materialize_rollup(wfact), dim_payment_type(spark), dim_vendor(spark)).values():
            v.collect()
        for v in build_views(wfact, {"dim_payment_type": dim_payment_type(spark),
                                     "dim_vendor": dim_vendor(spark)}).values():
            v.collect()

    cfg = EtlConfig(raw_paths=[], fact_path=f"{run_dir}/fact")
    result = timed("etl_load", lambda: run_etl(spark, cfg, build_views=False, raw=raw_trips(spark, sf_dir)))
    fact = io.read_fact_parquet(spark, cfg.fact_path)
    pay, ven = dim_payment_type(spark), dim_vendor(spark)

    def dashboard():
        r = materialize_rollup(fact)
        return {k: v.collect() for k, v in views_from_rollup(r, pay, ven).items()}

    def direct():
        views = build_views(fact, {"dim_payment_type": pay, "dim_vendor": ven})
        return {k: v.collect() for k, v in views.items()}

    timed("dashboard_rollup", dashboard)
    timed("views_direct", direct)

    qs = all_queries()
    row_level = ["fact_trips", "quality_rejects", "assign_trip_id", "feat_speed"]
    aggregates = ["v_kpi_summary", "v_payment_distribution", "v_daily_summary_by_date",
                  "r_day_type_diff", "check_not_null", "dq_rule_counts", "dim_vendor_upsert"]
    for key in row_level:
        timed(key, lambda k=key: qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save())
    for key in aggregates:
        timed(key, lambda k=key: qs[k](spark, sf_dir).collect())

    spark.stop()
    metrics = stage_metrics(eventlog_dir) if eventlog_dir else {}
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": _sf_of(sf_dir),
        "raw_rows": result.raw_rows,
        "clean_rows": result.clean_rows,
        "etl_raw_rows_per_sec": round(result.raw_rows / timings["etl_load"], 1) if timings["etl_load"] else None,
        "cpus": cpus,
        "stage_metrics": {k: metrics.get(k, {}) for k in timings},
    }))


if __name__ == "__main__":
    main()
