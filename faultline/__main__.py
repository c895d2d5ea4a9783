"""Jobs for spark-submit: fill a store, check it, query it, ingest messages, drop old days.

    python -m faultline generate --path STORE --rows 1000000
    python -m faultline verify --path STORE
    python -m faultline query error-rate --path STORE --service payment-service --from 2026-10-02 --to 2026-10-03
    python -m faultline ingest --messages LANDING --root SINKS
    python -m faultline retain --path STORE --days 7 --dry-run
    python -m faultline compact --path STORE --day 2026-10-02

The session takes its settings from spark-submit; without it, a local one is started.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession

from faultline.operators import analytics, audit, latency
from faultline.session import local_session, use_utc
from faultline.sources import names, store, synthetic
from faultline.streaming import ingest, jobs

QUERIES = {
    "error-rate": lambda table, a: analytics.error_rate(table, a.service, a.lo, a.hi),
    "p95": lambda table, a: analytics.p95_latency(table, a.service, a.lo, a.hi),
    "slowest-endpoints": lambda table, a: analytics.slowest_endpoints(table, a.service, a.lo, a.hi, a.top),
    "lookup": lambda table, a: analytics.range_lookup(table, a.service, a.lo, a.hi, a.limit),
    "errors": lambda table, a: analytics.error_lookup(table, a.service, a.lo, a.hi, a.limit),
    "errors-per-hour": lambda table, a: analytics.errors_per_hour(table, a.service, a.lo, a.hi),
    "events": lambda table, a: analytics.window_events(table, a.service, a.lo, a.hi),
    "alert": lambda table, a: analytics.alert_error_rate(
        table, a.service, as_of=a.hi or store.latest_stored(table.sparkSession, a.path)
    ),
    "latency-summary": lambda table, a: latency.latency_summary(table),
}


#: Queries that return events without a limit; they go to a folder.
UNBOUNDED = {"events"}


def deliver(result: DataFrame, out: str | None) -> None:
    """To a folder, or all rows to the terminal; those are aggregates or limited."""
    if out:
        result.write.mode("overwrite").parquet(out)
        return
    print("\t".join(result.columns))
    for row in result.toLocalIterator():
        print("\t".join("NULL" if value is None else str(value) for value in row))


def generate(spark: SparkSession, a: argparse.Namespace) -> None:
    events = synthetic.synthetic_events(spark, a.rows, a.seed)
    store.write_daily(events, a.path, a.mode, row_group_bytes=a.row_group_bytes)


def verify(spark: SparkSession, a: argparse.Namespace) -> None:
    table = store.read_store(spark, a.path)
    deliver(audit.row_count(table), None)
    deliver(audit.schema_check(table), None)
    deliver(audit.partition_profile(table).orderBy("event_date"), None)


def query(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.name in UNBOUNDED and not a.out:
        raise SystemExit(f"{a.name} returns events without a limit: name a folder with --out")
    table = store.read_store(spark, a.path)
    if a.loose:
        table, a.service = analytics.of_service(table, names.spellings(spark, a.path, a.service)), None
    deliver(QUERIES[a.name](table, a), a.out)


def take_in(spark: SparkSession, a: argparse.Namespace) -> None:
    ingest.ingest(jobs.message_stream(spark, a.messages, a.max_files), ingest.Sinks(a.root), a.max_receives)


def retain(spark: SparkSession, a: argparse.Namespace) -> None:
    as_of = dt.date.fromisoformat(a.as_of) if a.as_of else None
    if a.dry_run:
        print(*store.expired_days(spark, a.path, a.days, as_of), sep="\n")
        return
    deliver(audit.partition_profile(store.retain_days(spark, a.path, a.days, as_of)).orderBy("event_date"), None)


def compact(spark: SparkSession, a: argparse.Namespace) -> None:
    store.compact_day(spark, a.path, dt.date.fromisoformat(a.day), a.files)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="faultline")
    commands = parser.add_subparsers(required=True)

    def command(name: str, job) -> argparse.ArgumentParser:
        added = commands.add_parser(name)
        added.set_defaults(job=job)
        return added

    filled = command("generate", generate)
    filled.add_argument("--path", required=True)
    filled.add_argument("--rows", type=int, default=1_000_000)
    filled.add_argument("--seed", type=int, default=42)
    filled.add_argument("--row-group-bytes", type=int)
    filled.add_argument("--mode", choices=["append", "overwrite", "errorifexists"], default="append")

    command("verify", verify).add_argument("--path", required=True)

    asked = command("query", query)
    asked.add_argument("name", choices=sorted(QUERIES))
    asked.add_argument("--path", required=True)
    asked.add_argument("--service")
    asked.add_argument("--from", dest="lo")
    asked.add_argument("--to", dest="hi")
    asked.add_argument("--top", type=int, default=10)
    asked.add_argument("--limit", type=int, default=100)
    asked.add_argument("--out")
    asked.add_argument("--loose", action="store_true", help="compare the service without case, accents and trailing spaces")

    taken = command("ingest", take_in)
    taken.add_argument("--messages", required=True)
    taken.add_argument("--root", required=True)
    taken.add_argument("--max-files", type=int)
    taken.add_argument("--max-receives", type=int, default=ingest.MAX_RECEIVES)

    kept = command("retain", retain)
    kept.add_argument("--path", required=True)
    kept.add_argument("--days", type=int, required=True)
    kept.add_argument("--as-of", help="the newest day that may be stored; today by default")
    kept.add_argument("--dry-run", action="store_true", help="list the days that would go")

    packed = command("compact", compact)
    packed.add_argument("--path", required=True)
    packed.add_argument("--day", required=True)
    packed.add_argument("--files", type=int)
    return parser


def main(argv: list[str] | None = None) -> None:
    parsed = arguments().parse_args(argv)
    spark = SparkSession.getActiveSession()
    if spark is None:
        submitted = "SPARK_ENV_LOADED" in os.environ or "PYSPARK_GATEWAY_PORT" in os.environ
        spark = SparkSession.builder.getOrCreate() if submitted else local_session()
    parsed.job(use_utc(spark), parsed)


if __name__ == "__main__":
    main()
