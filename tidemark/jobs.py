"""Command-line entry points (``spark-submit -m``-style or ``python -m``).

    python -m tidemark.jobs strict      --lake ROOT --series DIR [--quotes DIR]
    python -m tidemark.jobs incremental --lake ROOT --series DIR [--quotes DIR] [--run-ts TS] [--pricing in_force]
    python -m tidemark.jobs compact     --lake ROOT [--file-mb 128]
    python -m tidemark.jobs zorder      --table PATH --columns a,b
    python -m tidemark.jobs vacuum      --table PATH --keys k1,k2 [--retention-hours 168] [--now TS]
    python -m tidemark.jobs vacuum      --lake ROOT --keys k1,k2 [--table-keys NAME=k3 ...] [--retention-hours 168] [--now TS]
    python -m tidemark.jobs depth       --table PATH --columns a,b

Times are UTC. Each prints one JSON line with the job's metrics. The session comes from the
environment (``spark-submit`` settings); ``--master`` is for local runs.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from tidemark.plans import maintenance
from tidemark.plans.medallion import Lake, run_incremental, run_strict
from tidemark.session import build_session


def _ts(text: str | None) -> dt.datetime:
    """A time without zone, as UTC; default: now."""
    at = dt.datetime.fromisoformat(text) if text else dt.datetime.now(dt.timezone.utc)
    return at.astimezone(dt.timezone.utc).replace(tzinfo=None) if at.tzinfo else at


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="tidemark.jobs")
    ap.add_argument("--master", default=None)
    ap.add_argument("--cluster", action="store_true", help="apply the large-cluster settings")
    sub = ap.add_subparsers(dest="job", required=True)
    for name in ("strict", "incremental"):
        j = sub.add_parser(name)
        j.add_argument("--lake", required=True)
        j.add_argument("--series", required=True)
        j.add_argument("--quotes")
        if name == "incremental":
            j.add_argument("--run-ts", help="lineage timestamp (ISO); default: now")
            j.add_argument("--pricing", choices=("latest", "in_force"), default="latest")
    c = sub.add_parser("compact")
    c.add_argument("--lake", required=True)
    c.add_argument("--file-mb", type=int, default=128)
    for name in ("zorder", "depth"):
        z = sub.add_parser(name)
        z.add_argument("--table", required=True)
        z.add_argument("--columns", required=True)
    v = sub.add_parser("vacuum")
    what = v.add_mutually_exclusive_group(required=True)
    what.add_argument("--table")
    what.add_argument("--lake")
    v.add_argument("--keys", required=True)
    v.add_argument("--table-keys", action="append", default=[], metavar="NAME=k1,k2")
    v.add_argument("--retention-hours", type=float, default=168.0)
    v.add_argument("--now", help="ISO timestamp; default: now")
    a = ap.parse_args(argv)

    spark = build_session(a.master, app=f"tidemark-{a.job}", cluster=a.cluster)
    if a.job == "strict":
        out = run_strict(spark, Lake(a.lake), a.series, a.quotes)
    elif a.job == "incremental":
        out = run_incremental(spark, Lake(a.lake), a.series, a.quotes, _ts(a.run_ts), a.pricing)
    elif a.job == "compact":
        tables = maintenance.find_tables(spark, a.lake)
        out = maintenance.run_all(spark, tables, maintenance.compact, target_file_bytes=a.file_mb << 20)
    elif a.job == "zorder":
        out = maintenance.zorder(spark, a.table, a.columns.split(","))
    elif a.job == "depth":
        out = {r["column"]: r.asDict() for r in maintenance.clustering_depth(spark, a.table, a.columns.split(",")).collect()}
    elif a.lake:
        own = {name: keys.split(",") for name, keys in (x.split("=", 1) for x in a.table_keys)}
        out = maintenance.vacuum_lake(spark, a.lake, a.keys.split(","), _ts(a.now), a.retention_hours, own)
    else:
        out = maintenance.vacuum(spark, a.table, a.keys.split(","), _ts(a.now), a.retention_hours)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
