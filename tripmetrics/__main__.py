"""Command line: ``python -m tripmetrics <job> ...`` (or via spark-submit).

  live     --source DIR | --topics T --bootstrap HOST:PORT, --out DIR [--monitor ID ...]
  monitor  --source DIR | --topics T --bootstrap HOST:PORT, --out DIR --monitor ID [...]
  widecol  --cells DIR [--to DIR]
  compact  --out DIR --before DAY
  serving  --out DIR --to DIR

Streams run until stopped, or once over the available input with
``--available-now``.  Stream checkpoints live under
``<spark.checkpoint.dir>/jobs/<job>``: a restarted job resumes where it
stopped.
"""

from __future__ import annotations

import argparse
import sys

from tripmetrics import jobs
from tripmetrics.functions.variants import ParseRules
from tripmetrics.schema import HEARTBEAT_TTL_MAIN_S, HEARTBEAT_TTL_MONITOR_S
from tripmetrics.session import build_session
from tripmetrics.sources.messages import message_stream


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tripmetrics")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("live", "monitor"):
        s = sub.add_parser(name)
        s.add_argument("--source", help="folder of message files (event_id, ts, value)")
        s.add_argument("--topics", nargs="*", help="Kafka topics")
        s.add_argument("--bootstrap", help="Kafka bootstrap servers")
        s.add_argument("--out", required=True)
        s.add_argument("--monitor", nargs="*", default=[], help="terminal ids whose messages are heartbeats")
        s.add_argument("--ttl", type=int,
                       default=HEARTBEAT_TTL_MAIN_S if name == "live" else HEARTBEAT_TTL_MONITOR_S)
        s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
        s.add_argument("--job", default=name,
                       help="job name: its stream checkpoints live under <spark.checkpoint.dir>/jobs/<job>")
        if name == "live":
            s.add_argument("--expiry", action="store_true", help="write a row when a device falls silent")
    r = sub.add_parser("repair")
    r.add_argument("--out", required=True, help="output root of the live job")
    r.add_argument("--corrections", help="parquet folder of corrected lines (event_id, line_no, line)")
    r.add_argument("--version", type=int, default=1, help="version of the parse rules")
    r.add_argument("--name", action="append", default=[], metavar="FIELD=OTHER",
                   help="another name of a JSON field, e.g. mileage=mileageKm")
    w = sub.add_parser("widecol")
    w.add_argument("--cells", required=True)
    w.add_argument("--to", help="where to write the projection (default: print every row)")
    c = sub.add_parser("compact")
    c.add_argument("--out", required=True, help="output root of the live job")
    c.add_argument("--before", required=True, help="first day (yyyy-MM-dd) that is still open")
    v = sub.add_parser("serving")
    v.add_argument("--out", required=True, help="output root of the live job")
    v.add_argument("--to", required=True, help="where to write the key/field/value table")
    p.add_argument("--master", default=None)
    p.add_argument("--time-zone", default="UTC", help="zone in which days and hours begin")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(args.master, app_name=f"tripmetrics-{args.command}", time_zone=args.time_zone)
    if args.command == "widecol":
        count, projection = jobs.widecol_scan(spark, args.cells)
        print(count.first().n_rows)
        if args.to:
            projection.write.mode("overwrite").parquet(args.to)
        else:  # every row, one at a time through the driver
            for row in projection.toLocalIterator():
                print("\t".join("" if v is None else str(v) for v in row))
        return 0
    if args.command == "repair":
        names: dict[str, tuple[str, ...]] = {}
        for pair in args.name:
            field, _, other = pair.partition("=")
            names[field] = (*names.get(field, ()), other)
        corrections = spark.read.parquet(args.corrections) if args.corrections else None
        jobs.repair_rejects(spark, args.out, ParseRules(args.version, names), corrections)
        return 0
    if args.command == "compact":
        jobs.compact(spark, args.out, args.before)
        return 0
    if args.command == "serving":
        jobs.serving_snapshot(spark, args.out).write.mode("overwrite").partitionBy("day").parquet(args.to)
        return 0
    if not (args.source or args.topics):
        raise SystemExit("--source or --topics is required")
    messages = message_stream(spark, topics=args.topics, bootstrap_servers=args.bootstrap,
                              path=args.source)
    trigger = {"availableNow": True} if args.available_now else None
    if args.command == "live":
        queries = list(jobs.live_job(spark, messages, args.out, monitored=args.monitor or None,
                                     ttl_s=args.ttl, expiry=args.expiry, trigger=trigger, job=args.job).values())
    else:
        if not args.monitor:
            raise SystemExit("monitor needs --monitor ID")
        queries = [jobs.monitor_job(spark, messages, args.out, args.monitor, ttl_s=args.ttl,
                                    trigger=trigger, job=args.job)]
    for q in queries:
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
