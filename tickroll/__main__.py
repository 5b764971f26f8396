"""Command line for scheduled runs.

    python -m tickroll rollup --interval 1h --source <3m table> --target <1h table> \
        [--run-time 2024-01-20T00:00:00Z] [--since ...] [--until ...]
    python -m tickroll sync --meta <pair metadata> --pages <landed pages> \
        --candles <3m table> --checkpoints <checkpoint table> [--rejects <table>] [--since-days 1]
    python -m tickroll load --table vn_eod --landed <landed payloads> --target <table> \
        [--codes <code list>] [--companies <companies>] [--columns <indicator names.json>]
        [--listings HOSE,HNX,UPCOM] [--run-date 2024-01-20 --lookback-days 3] [--policy update|nothing]
        [--truncate] [--on-error fail|skip]

Landed data, metadata and code lists are Parquet folders (any Hadoop file
system); candle, checkpoint and load tables are ``KeyedTable`` folders. The
scheduler owns cron, retries and concurrency; each call is one run.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from tickroll.operators.candles import CANDLE_KEYS
from tickroll.operators.incremental import CHECKPOINT_KEYS
from tickroll.plans import jobs, loads
from tickroll.session import build_session
from tickroll.sources.keyed_table import KeyedTable
from tickroll.sources.landed import read_pages
from tickroll.streaming.ingest import reject_table


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tickroll")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("rollup", help="one candle rollup run")
    r.add_argument("--interval", required=True, choices=["15m", "1h", "4h", "8h", "1d", "7d"])
    r.add_argument("--source", required=True)
    r.add_argument("--target", required=True)
    r.add_argument("--run-time", default=None)
    r.add_argument("--since", default=None)
    r.add_argument("--until", default=None)
    s = sub.add_parser("sync", help="one incremental candle ingest run")
    s.add_argument("--meta", required=True)
    s.add_argument("--pages", required=True)
    s.add_argument("--candles", required=True)
    s.add_argument("--checkpoints", required=True)
    s.add_argument("--rejects", default=None)
    s.add_argument("--since-days", type=int, default=1)
    s.add_argument("--timeframe", default="3m")
    t = sub.add_parser("load", help="one run of a table load")
    t.add_argument("--table", required=True, choices=sorted(loads.TABLES))
    t.add_argument("--landed", required=True)
    t.add_argument("--target", required=True)
    t.add_argument("--codes", default=None)
    t.add_argument("--companies", default=None)
    t.add_argument("--columns", default=None)
    t.add_argument("--listings", default=None)
    t.add_argument("--run-date", default=None)
    t.add_argument("--lookback-days", type=int, default=None)
    t.add_argument("--policy", default="update", choices=["update", "nothing"])
    t.add_argument("--truncate", action="store_true")
    t.add_argument("--dead-letters", default=None, help="folder that payloads without records are added to")
    t.add_argument("--on-error", default="fail", choices=["fail", "skip"])
    args = ap.parse_args(argv)

    spark = build_session(app=f"tickroll-{args.cmd}")
    candle_table = lambda path: KeyedTable(spark, path, CANDLE_KEYS, "timestamp")
    frame = lambda path: spark.read.parquet(path) if path else None
    if args.cmd == "rollup":
        counts = jobs.rollup_job(spark, candle_table(args.source), candle_table(args.target), args.interval,
                                 args.run_time or _now(), {"since": args.since, "until": args.until})
        for row in counts.collect():        # one row per report slice
            print(json.dumps(row.asDict()))
    elif args.cmd == "sync":
        now_ms = int(datetime.now(timezone.utc).timestamp() * 1000)
        jobs.candle_sync_job(spark, frame(args.meta), read_pages(spark, args.pages), candle_table(args.candles),
                             KeyedTable(spark, args.checkpoints, CHECKPOINT_KEYS), now_ms, args.since_days, args.timeframe,
                             rejects=reject_table(spark, args.rejects) if args.rejects else None)
    else:
        run = jobs.load_run(
            spark, args.table, frame(args.landed), loads.stored_table(spark, args.table, args.target),
            codes=frame(args.codes), companies=frame(args.companies),
            columns=loads.ratio_columns_from(args.columns) if args.columns else None, policy=args.policy,
            listings=args.listings.split(",") if args.listings else None, run_date=args.run_date,
            lookback_days=args.lookback_days, truncate=args.truncate, on_error=args.on_error)
        print(json.dumps({"table": args.table, **run.counts}), file=sys.stderr)
        if args.dead_letters:
            run.dead.write.mode("append").parquet(args.dead_letters)
        print(json.dumps({"table": args.table, "rows_written": run.counts["written"]}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
