"""Command line for scheduled jobs (the session comes from the environment,
e.g. ``spark-submit``; nothing here sets cluster configuration)::

    python -m stratum ingest  --root <lake> --landing <raw> [--entity results ...] [--parallelism 4]
    python -m stratum refine  --root <lake> --landing <raw> [--entity results ...]
    python -m stratum vacuum  --root <lake> --landing <raw> --entity results [--retain-hours 168]
    python -m stratum runs    --root <lake> --landing <raw>

Uses the seeded configuration and rule tables (``Engine.seeded``); prints one
summary row per entity.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m stratum")
    parser.add_argument("command", choices=["ingest", "refine", "vacuum", "runs"])
    parser.add_argument("--root", required=True, help="lakehouse root (shared file system)")
    parser.add_argument("--landing", required=True, help="root of the raw landing folders")
    parser.add_argument("--entity", action="append", help="entity (repeatable); default: all active")
    parser.add_argument("--parallelism", type=int, default=1)
    parser.add_argument("--retain-hours", type=float, default=168.0)
    parser.add_argument("--trust-metadata", action="store_true",
                        help="hash only files whose mtime or size changed")
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    from stratum.plans.engine import Engine
    from stratum.plans.jobs import run_bronze_layer, run_refine_layer

    spark = SparkSession.builder.getOrCreate()
    eng = Engine.seeded(spark, args.root, args.landing)
    if args.command == "ingest":
        out = run_bronze_layer(spark, eng.lake, eng.entities, eng.validation_rules, eng.dq_rules,
                               entities=args.entity, parallelism=args.parallelism,
                               trust_metadata=args.trust_metadata)
    elif args.command == "refine":
        out = run_refine_layer(spark, eng.lake, eng.refine_entities, eng.entities,
                               entities=args.entity, parallelism=args.parallelism)
    elif args.command == "vacuum":
        for e in args.entity or []:
            print(e, eng.vacuum(e, args.retain_hours))
        return 0
    else:
        out = eng.runs()
    out.show(truncate=False)
    failed = args.command in ("ingest", "refine") and out.filter("status = 'FAILED'").count() > 0
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
