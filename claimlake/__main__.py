"""Command line for the end-to-end jobs: ``python -m claimlake <job> ...``.

    ingest     --landing L --lake K [--log P]
    model      --lake K --predictions P [--seed N] [--log P]
    warehouse  --db D --root R --lake K --predictions P
    dashboards --table T | --predictions P  --out O
    profile    --csv C --out O

The session comes from ``spark-submit`` / the environment (``getOrCreate``);
this command sets no cluster options of its own.
"""

from __future__ import annotations

import argparse
import json
import sys


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m claimlake", description=__doc__.split("\n")[0])
    p.add_argument("--size-partitions", action="store_true",
                   help="set spark.sql.shuffle.partitions from the input file sizes first")
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("ingest", help="archives under a landing folder -> lake datasets")
    s.add_argument("--landing", required=True)
    s.add_argument("--lake", required=True)
    s.add_argument("--log")
    s = sub.add_parser("model", help="lake -> scored annual-cost table")
    s.add_argument("--lake", required=True)
    s.add_argument("--predictions", required=True)
    s.add_argument("--seed", type=int, default=42)
    s.add_argument("--log")
    s = sub.add_parser("warehouse", help="full refresh of the five warehouse tables")
    s.add_argument("--db", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--lake", required=True)
    s.add_argument("--predictions", required=True)
    s = sub.add_parser("dashboards", help="write every worksheet query as Parquet")
    g = s.add_mutually_exclusive_group(required=True)
    g.add_argument("--table")
    g.add_argument("--predictions")
    s.add_argument("--out", required=True)
    s = sub.add_parser("profile", help="column profiles of a raw CSV file")
    s.add_argument("--csv", required=True)
    s.add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from claimlake.plans import jobs
    from claimlake.session import ensure_checkpoint_dir

    spark = SparkSession.builder.appName(f"claimlake-{args.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.size_partitions:
        from claimlake.session import suggest_shuffle_partitions
        inputs = [getattr(args, a) for a in ("landing", "lake", "csv", "predictions") if getattr(args, a, None)]
        if inputs:
            spark.conf.set("spark.sql.shuffle.partitions", str(suggest_shuffle_partitions(spark, inputs)))
    if args.job == "ingest":
        result = jobs.ingest_all(spark, args.landing, args.lake, args.log)
    elif args.job == "model":
        result = jobs.model_job(spark, args.lake, args.predictions, args.seed, args.log)
    elif args.job == "warehouse":
        result = jobs.warehouse_job(spark, args.db, args.root, args.lake, args.predictions)
    elif args.job == "dashboards":
        scored = spark.table(args.table) if args.table else spark.read.parquet(args.predictions)
        result = {}
        for name, df in jobs.dashboard_pack(scored, method="radix").items():
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
            result[name] = f"{args.out.rstrip('/')}/{name}"
    else:
        result = {}
        for name, df in jobs.profile_job(spark, args.csv).items():
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
            result[name] = f"{args.out.rstrip('/')}/{name}"
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
