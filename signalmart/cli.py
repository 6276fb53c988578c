"""The two programs around a mart: the streaming load, and a quality run with an exit status.

    python -m signalmart stream  --mart DIR --brokers HOST:PORT --checkpoints DIR
    python -m signalmart stream  --mart DIR --files DIR --dead-letters DIR --checkpoints DIR --drain
    python -m signalmart quality --mart DIR [--constraints]
"""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from signalmart import session
from signalmart.operators import quality
from signalmart.plans import load
from signalmart.sources import records
from signalmart.sources.sinks import FileSink, KafkaSink
from signalmart.sources.store import SEEDED, Store
from signalmart.streaming import jobs

DLQ_TOPICS = ("failed-transactions",)


def open_mart(spark: SparkSession, root: str) -> Store:
    """The mart under `root`, its fixed dimensions written if they are not there yet."""
    store = load.open_store(spark, root)
    if not all(store.folder.names(table) for table in SEEDED):
        store.seed()
    return store


def stream(spark: SparkSession, args: argparse.Namespace) -> int:
    """Load events and dead letters until stopped; with `--drain`, until the sources are read to their end."""
    store = open_mart(spark, args.mart)
    trigger = jobs.Trigger(args.interval, args.drain)
    if args.brokers:
        sink = KafkaSink(args.brokers)
        read = lambda topics: records.kafka_stream(
            spark, args.brokers, topics, args.max_records, args.fail_on_data_loss
        )
        events, dead_letters = (lambda: read(records.event_topics())), (lambda: read(DLQ_TOPICS))
    else:
        sink = FileSink(args.dead_letters)
        events = lambda: records.file_stream(spark, args.files, args.max_files)
        dead_letters = lambda: records.file_stream(spark, args.dead_letters)
    job = jobs.Jobs(store, sink, args.checkpoints, trigger, {"as_of": args.as_of})
    started = job.start_events(events())
    if args.drain:
        started.awaitTermination()  # the dead letters of this run are read, too
        if args.brokers or store.folder_of(args.dead_letters).names():
            job.start_dead_letters(dead_letters()).awaitTermination()
        return 0
    if not args.brokers:
        store.folder_of(args.dead_letters).make()
    job.start_dead_letters(dead_letters())
    jobs.supervise(spark)
    return 1  # a query that ends by itself is a failure to be restarted


def check(spark: SparkSession, args: argparse.Namespace) -> int:
    """Print a verdict per table and every broken expectation; the exit status is 0 only if all hold."""
    mart = load.open_store(spark, args.mart).mart
    report = quality.report(mart, args.as_of)
    if args.constraints:
        report = report.unionByName(quality.constraints(mart))
    rows = report.orderBy("table_name", "column_name").collect()  # one per expectation
    broken = [row for row in rows if not row["success"]]
    for table in sorted({row["table_name"] for row in rows}):
        print(f"{'FAIL' if any(row['table_name'] == table for row in broken) else 'PASS'}  {table}")
    for row in broken:
        print(
            f"  FAILED {row['table_name']}: {row['expectation']} {row['column_name']},"
            f" {row['unexpected']} of {row['evaluated']}"
        )
    return 1 if broken else 0


def _time(text: str) -> datetime:
    found = datetime.fromisoformat(text)
    return found if found.tzinfo else found.replace(tzinfo=UTC)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="signalmart")
    commands = top.add_subparsers(required=True)
    run = commands.add_parser("stream", help="load events and dead letters")
    run.set_defaults(run=stream)
    run.add_argument("--mart", required=True)
    run.add_argument("--checkpoints", required=True)
    source = run.add_mutually_exclusive_group(required=True)
    source.add_argument("--brokers")
    source.add_argument("--files", help="folder of records in broker shape")
    run.add_argument("--dead-letters", help="folder for dead letters, with --files")
    run.add_argument("--interval", default="5 seconds")
    run.add_argument("--max-records", type=int, default=20_000, help="per batch, with --brokers")
    run.add_argument("--max-files", type=int, default=1000, help="per batch, with --files")
    run.add_argument("--fail-on-data-loss", action="store_true")
    run.add_argument("--drain", action="store_true", help="stop when all there is has been read")
    run.add_argument("--as-of", type=_time, help="clock of the batches, to load history again")
    checks = commands.add_parser("quality", help="check a mart")
    checks.set_defaults(run=check)
    checks.add_argument("--mart", required=True)
    checks.add_argument("--as-of", type=_time, help="clock of the checks")
    checks.add_argument("--constraints", action="store_true", help="keys and mandatory columns as well")
    return top


def main(argv: list[str] | None = None, builder: SparkSession.Builder | None = None) -> int:
    args = parser().parse_args(argv)
    if getattr(args, "files", None) and not args.dead_letters:
        raise SystemExit("--files needs --dead-letters")
    return args.run(session.start(builder or SparkSession.builder.appName("signalmart")), args)
