"""Command line: ingest, run the whole pipeline, or gate one layer.

    python -m tidemark ingest --registry sources.yml --warehouse W (--all | --source NAME)
    python -m tidemark run    --registry sources.yml --warehouse W --as-of TS [--full-refresh]
    python -m tidemark check  --registry sources.yml --warehouse W --layer silver --as-of TS

``check`` exits 0 when the layer passes (warnings allowed), 2 when a check
fails, 3 when no check produced a result (Q12). Under spark-submit the
master and shuffle width come from the launcher.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from tidemark.operators import dq, rules
from tidemark.session import apply_cluster_defaults, build_session
from tidemark.sources import landing, published
from tidemark.sources.registry import load_registry

SILVER = ["customers", "identity_map", "subscriptions", "events"]


def stored_tables(spark, registry: dict, warehouse: str) -> dict:
    """Every table the warehouse holds, by model name."""
    out = {}
    for name, cfg in registry.items():
        path = landing.table_path(warehouse, cfg["target_bronze"])
        if landing.table_exists(spark, path):
            out[name] = landing.read_table(spark, path)
    for n in SILVER:
        path = f"{warehouse}/silver/{n}"
        if landing.table_exists(spark, path) or landing.path_exists(spark, path):
            out[n] = spark.read.parquet(path)
    version = published.current(spark, f"{warehouse}/gold")     # the gold of the last run that passed
    for n in version.places if version else ():
        out[n] = published.read(spark, f"{warehouse}/gold", n, version)
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "run", "check"):
        p = sub.add_parser(name)
        p.add_argument("--registry", required=True)
        p.add_argument("--warehouse", required=True)
        p.add_argument("--as-of", default=None, help="logical clock, ISO text (default: now, UTC)")
        p.add_argument("--master", default=None)
        if name == "ingest":
            g = p.add_mutually_exclusive_group(required=True)
            g.add_argument("--all", action="store_true")
            g.add_argument("--source", action="append")
            p.add_argument("--lookback-hours", type=float, default=None)
        if name in ("run", "check"):
            p.add_argument("--scale", type=float, default=1.0)
            p.add_argument("--reference-now", default=None)
        if name == "run":
            p.add_argument("--full-refresh", action="store_true")
            p.add_argument("--reset-history", action="store_true")
            p.add_argument("--publish-failed", action="store_true", help="show the run's gold although a gate failed")
            p.add_argument("--register", metavar="PREFIX", nargs="?", const="", default=None,
                           help="make the tables reachable by name, their schemas named with this prefix")
        if name == "check":
            p.add_argument("--layer", required=True, choices=["bronze", "silver", "gold"])
    a = ap.parse_args(argv)

    as_of = a.as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    spark = build_session(a.master, None if a.master is None else 8, "tidemark-cli")
    if not spark.sparkContext.master.startswith("local"):
        apply_cluster_defaults(spark)   # on a cluster: large-data defaults where unset
    registry = load_registry(a.registry)

    if a.cmd == "ingest":
        lookback = dt.timedelta(hours=a.lookback_hours) if a.lookback_hours else None
        names = None if a.all else a.source
        landed = landing.ingest(spark, registry, a.warehouse, names,
                                run_ts=dt.datetime.fromisoformat(as_of), lookback=lookback)
        print(json.dumps({"landed": landed}))
        return 0
    if a.cmd == "run":
        from tidemark.plans.runner import run_pipeline
        run = run_pipeline(spark, registry, a.warehouse, as_of, full_refresh=a.full_refresh, reset_history=a.reset_history,
                           scale=a.scale, reference_now=a.reference_now, prefix=a.register,
                           publish_failed=a.publish_failed)
        print(json.dumps({"landed": run.landed, "rows": run.rows, "gates": run.gates, "published": run.published,
                          "freshness_hours": run.freshness, "pass_rate": run.pass_rate}, default=str))
        return 2 if "fail" in run.gates.values() else 3 if "error" in run.gates.values() else 0
    tables = stored_tables(spark, registry, a.warehouse)
    wanted = rules.checks_for(a.layer)
    checks = [c for c in wanted if c.table in tables]
    if not checks:
        print("no check results", file=sys.stderr)
        return 3
    res = dq.run_checks(spark, tables, checks, as_of, a.reference_now, scale=a.scale)
    rows = [r.asDict() for r in res.collect()]          # one row per check
    for r in rows:
        print(json.dumps(r, default=str))
    counts: dict[str, int] = {"error": len(wanted) - len(checks)}     # their table is missing
    for r in rows:
        counts[r["outcome"]] = counts.get(r["outcome"], 0) + 1
    try:
        dq.gate_counts(counts)
    except dq.GateError as e:
        print(str(e), file=sys.stderr)
        return e.code
    return 0


if __name__ == "__main__":
    sys.exit(main())
