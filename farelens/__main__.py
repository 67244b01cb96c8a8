"""Command line for the two batch jobs (usable with spark-submit).

    python -m farelens extract --src PATH [PATH ...] --lake PATH
    python -m farelens load --raw PATH [PATH ...] --fact PATH
                            [--table NAME] [--database NAME]
                            [--jdbc-url URL --jdbc-table NAME --jdbc-writers N]
                            [--time-ordered | --unordered] [--dynamic-overwrite]

``extract`` lands the raw files with all their columns in the lake, one
partition per month (from the file names or ``--month``).  ``load`` reads raw
trips, applies features and the quality gate, writes the fact (and
optionally a catalog table and a JDBC table with truncate semantics) and
prints the raw / clean / removed counts as one JSON line.  ``--database``
stores the fact, the dimensions and the 17 views in the catalog, where other
sessions find them.  ``--s3-endpoint`` reads and writes ``s3a://`` paths of an
S3-compatible store.  Credentials come from the environment
(FARELENS_JDBC_USER, FARELENS_JDBC_PASSWORD, FARELENS_JDBC_DRIVER,
FARELENS_S3_ACCESS_KEY, FARELENS_S3_SECRET_KEY).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from farelens.plans.etl import EtlConfig, extract, run_etl
from farelens.session import build_session, object_store_conf
from farelens.sources.io import JDBC_WRITERS, jdbc_options


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="farelens")
    sub = p.add_subparsers(dest="job", required=True)
    ex = sub.add_parser("extract", help="land raw files in the lake")
    ex.add_argument("--src", nargs="+", required=True)
    ex.add_argument("--lake", required=True)
    ex.add_argument("--month", help="YYYY-MM, if the file names don't tell")
    ld = sub.add_parser("load", help="transform raw trips and load the fact")
    ld.add_argument("--raw", nargs="+", required=True)
    ld.add_argument("--fact", required=True)
    ld.add_argument("--table")
    ld.add_argument("--jdbc-url")
    ld.add_argument("--jdbc-table", default="fact_trips")
    ld.add_argument("--jdbc-writers", type=int, default=JDBC_WRITERS, help="concurrent warehouse connections")
    ld.add_argument("--database", help="store fact, dimensions and views in this catalog database")
    order = ld.add_mutually_exclusive_group()
    order.add_argument("--time-ordered", dest="cluster", action="store_false", default=None,
                       help="raw files arrive in pickup-time order: skip the layout rebalance")
    order.add_argument("--unordered", dest="cluster", action="store_true", default=None,
                       help="rebalance by date; without either option the input is looked at")
    ld.add_argument("--dynamic-overwrite", action="store_true",
                    help="replace only the pickup dates being loaded")
    for job in (ex, ld):
        job.add_argument("--s3-endpoint")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    conf = None
    if args.s3_endpoint:
        conf = object_store_conf(args.s3_endpoint, os.environ.get("FARELENS_S3_ACCESS_KEY", ""),
                                 os.environ.get("FARELENS_S3_SECRET_KEY", ""))
    spark = build_session(app_name=f"farelens-{args.job}", extra_conf=conf)
    if args.job == "extract":
        rows = extract(spark, args.src, args.lake, args.month).count()
        out = {"job": "extract", "lake": args.lake, "rows": rows}
    else:
        jdbc = None
        if args.jdbc_url:
            jdbc = jdbc_options(args.jdbc_url, args.jdbc_table,
                                os.environ.get("FARELENS_JDBC_USER", ""),
                                os.environ.get("FARELENS_JDBC_PASSWORD", ""),
                                os.environ.get("FARELENS_JDBC_DRIVER", "org.postgresql.Driver"),
                                num_partitions=args.jdbc_writers)
        cfg = EtlConfig(raw_paths=args.raw, fact_path=args.fact, fact_table=args.table, jdbc=jdbc,
                        cluster_fact=args.cluster, dynamic_overwrite=args.dynamic_overwrite, database=args.database)
        res = run_etl(spark, cfg)
        out = {"job": "load", "fact": args.fact, "raw_rows": res.raw_rows, "clean_rows": res.clean_rows,
               "removed_rows": res.removed_rows, "removed_pct": res.removed_pct}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
