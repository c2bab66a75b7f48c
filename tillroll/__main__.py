"""Command line: run one report, list the reports, or run a whole batch.

    python -m tillroll list
    python -m tillroll show rpt_monthly_growth --sf-dir /root/testdata/sf0.01 [-n 20]
    python -m tillroll export rpt_top_customers --sf-dir DIR --out DIR [--format csv|parquet]
    python -m tillroll batch --sf-dir DIR --root DIR

On a cluster, submit the same module with ``spark-submit``; the session is
then the cluster's own (``getOrCreate`` picks it up) and its
``spark.checkpoint.dir`` is used for the star and intermediate tables.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    if args.master:
        from .session import local_session
        return local_session(args.master.removeprefix("local[").rstrip("]") or "*", args.shuffle_partitions)
    spark = SparkSession.builder.appName("tillroll").getOrCreate()
    from .session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tillroll")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    ap.add_argument("--shuffle-partitions", type=int, default=8)
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    show = sub.add_parser("show")
    show.add_argument("key")
    show.add_argument("--sf-dir", required=True)
    show.add_argument("-n", type=int, default=20)
    exp = sub.add_parser("export")
    exp.add_argument("key")
    exp.add_argument("--sf-dir", required=True)
    exp.add_argument("--out", required=True)
    exp.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    batch = sub.add_parser("batch")
    batch.add_argument("--sf-dir", required=True)
    batch.add_argument("--root", required=True)
    args = ap.parse_args(argv)

    from .plans.registry import queries
    if args.cmd == "list":
        print("\n".join(sorted(queries())))
        return 0
    spark = _session(args)
    try:
        return _run(spark, args, queries)
    finally:
        from .session import drop_work
        drop_work(spark, "tables")   # what ranking queries wrote while they were built


def _run(spark: SparkSession, args, queries) -> int:
    if args.cmd == "show":
        queries()[args.key](spark, args.sf_dir).show(args.n, truncate=False)
    elif args.cmd == "export":
        df = queries()[args.key](spark, args.sf_dir)
        w = df.write.mode("errorifexists")
        (w.option("header", True).csv(args.out) if args.format == "csv" else w.parquet(args.out))
    elif args.cmd == "batch":
        from .plans.batch import run_batch
        res = run_batch(spark, args.sf_dir, args.root)
        print(json.dumps({"fact_rows_added": res.fact_rows_added, "rows_dropped": res.rows_dropped, "exports": res.exports,
                          "kpis": res.kpi_paths, "seconds": res.seconds}, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
