"""Run a registered job: ``python -m ledgerline list`` /
``python -m ledgerline run <job> --data <dir> [--out <path>] [--show N]``.

Uses the session the environment provides (``spark-submit`` settings apply);
``--master`` is only for running outside a cluster.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerline")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered jobs")
    run = sub.add_parser("run", help="run one job")
    run.add_argument("job")
    run.add_argument("--data", required=True, help="directory with the input tables (<name>.parquet)")
    run.add_argument("--out", help="write the result here as Parquet")
    run.add_argument("--show", type=int, default=0, help="print the first N rows")
    run.add_argument("--master", help="e.g. local[8], when not submitted to a cluster")
    args = p.parse_args(argv)

    from ledgerline.plans.registry import JOBS, ORACLE

    if args.cmd == "list":
        for name in JOBS:
            print(f"{name}{'' if name in ORACLE else '  (no SQL twin)'}")
        return 0
    if args.job not in JOBS:
        print(f"unknown job {args.job!r}; try: python -m ledgerline list", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName(f"ledgerline-{args.job}")
    if args.master:
        builder = builder.master(args.master).config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    df = JOBS[args.job](spark, args.data)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    if args.show:
        df.show(args.show, truncate=80)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
