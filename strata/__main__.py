"""Command line: ``python -m strata <command>`` (or ``spark-submit strata/__main__.py <command>``).

Commands
  layered   landing CSVs -> bronze -> silver -> gold (config files are JSON data)
  dq        PASS / WARN / FAIL checks over written gold tables
  ingest    incremental (streaming, availableNow) load of new files of one landing folder

The session comes from ``SparkSession.builder.getOrCreate()``, i.e. from the
cluster's configuration when submitted; nothing here overrides it.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession


def _configs(args) -> list:
    from .specs import IngestConfig

    out = []
    for path in args.config:
        cfg = IngestConfig.from_json(path)
        base = cfg.base_path if os.path.isabs(cfg.base_path) or "://" in cfg.base_path else \
            os.path.join(args.landing_root, cfg.base_path)
        out.append(IngestConfig(base, cfg.target_schema, cfg.sources))
    return out


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="strata")
    sub = p.add_subparsers(dest="cmd", required=True)
    lay = sub.add_parser("layered", help="landing CSVs -> bronze -> silver -> gold")
    lay.add_argument("--config", action="append", required=True, help="ingest config JSON (repeatable)")
    lay.add_argument("--landing-root", default=".", help="root for relative base_path values")
    lay.add_argument("--prefix", default="", help="schema name prefix (bronze/silver/gold get it)")
    lay.add_argument("--parallel", type=int, default=1, help="source files ingested concurrently")
    dq = sub.add_parser("dq", help="data-quality checks over written gold tables")
    dq.add_argument("--gold-schema", default="gold")
    dq.add_argument("--as-of", required=True, help="reference date for freshness, YYYY-MM-DD")
    ing = sub.add_parser("ingest", help="incremental load of new files of one landing folder")
    ing.add_argument("--landing", required=True)
    ing.add_argument("--table", required=True, help="bronze table spec name, e.g. bronze_erp_cust_az12")
    ing.add_argument("--schema", default="bronze")
    ing.add_argument("--checkpoint", required=True, help="stream checkpoint folder (keep it between runs)")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"strata-{args.cmd}").getOrCreate()
    if args.cmd == "layered":
        from .plans.layered import run_from_csv

        layers, audit = run_from_csv(spark, _configs(args), args.prefix, parallel=args.parallel)
        for r in audit.collect():  # one row per table written: bounded
            print(json.dumps(r.asDict()))
        print(json.dumps({"layers": layers}))
    elif args.cmd == "dq":
        from .plans.dashboard import dq_checks_gold

        g = lambda t: spark.table(f"{args.gold_schema}.{t}")
        checks = dq_checks_gold(g("gold_customer_enriched"), g("gold_sales_denormalized"), args.as_of)
        failed = 0
        for r in checks.collect():  # one row per rule: bounded
            print(json.dumps(r.asDict()))
            failed += r.status == "FAIL"
        return 2 if failed else 0
    elif args.cmd == "ingest":
        from .schemas import BRONZE
        from .streaming import ingest_incremental

        spec = BRONZE[args.table]
        ingest_incremental(spark, args.landing, spec.schema, f"{args.schema}.{spec.name}",
                           checkpoint=args.checkpoint, table_comment=spec.comment)
    return 0


if __name__ == "__main__":
    sys.exit(main())
