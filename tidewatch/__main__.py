"""Command line: ``spark-submit -m`` style entry to the jobs.

    python -m tidewatch batch --lake LAKE --out TABLES [--days 7]
    python -m tidewatch batch --lake LAKE --jdbc-url URL --jdbc-driver CLASS [--truncate]
    python -m tidewatch ingest --captured DIR --servers HOSTS --topic NAME --checkpoints DIR
    python -m tidewatch live --servers HOSTS --topic NAME --root TABLES --checkpoint DIR [--max-offsets N] [--hitters]
    python -m tidewatch traffic --servers HOSTS --topic NAME --root TABLES --checkpoint DIR [--max-offsets N]
    python -m tidewatch archive --servers HOSTS --topic NAME --lake LAKE --checkpoint DIR [--by-month | --ledger DIR]
    python -m tidewatch forget --ledger DIR [--days 30]
    python -m tidewatch hitters --root TABLES [--hours 24]
    python -m tidewatch expire --root TABLES [--hours 24]
    python -m tidewatch compact --lake LAKE --target LAKE [--year 2024 [--month 1]] [--by-day]
    python -m tidewatch hours --lake LAKE --table TABLE
    python -m tidewatch tables --lake LAKE --state DIR --out TABLES [--days 7]
    python -m tidewatch silence --root TABLES
    python -m tidewatch alarm --servers HOSTS --topic NAME --root TABLES --checkpoint DIR [--seconds 300]
"""

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidewatch.operators import heavy_hitters, monitoring
from tidewatch.operators.retention import RETENTION_HOURS
from tidewatch.plans import batch_job, incremental, pipelines, retention
from tidewatch.session import clean, configure
from tidewatch.sources import jdbc, lake
from tidewatch.streaming import live as streams
from tidewatch.streaming.queries import LIVE_INTERVAL, run_forever
from tidewatch.streaming.stats import IngestTotals

# How long the archive's ledger remembers an event, counted from the event's own day.
LEDGER_DAYS = 30


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidewatch")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    batch = job("batch", "lake")
    batch.add_argument("--days", type=int, default=7)
    batch.add_argument("--out")
    batch.add_argument("--jdbc-url")
    batch.add_argument("--jdbc-driver")
    batch.add_argument("--truncate", action="store_true")
    batch.add_argument("--literal-counts", action="store_true")
    job("ingest", "captured", "servers", "topic", "checkpoints")
    live = job("live", "servers", "topic", "root", "checkpoint")
    live.add_argument("--max-offsets", type=int)
    live.add_argument("--hitters", action="store_true")
    job("traffic", "servers", "topic", "root", "checkpoint").add_argument("--max-offsets", type=int)
    archive = job("archive", "servers", "topic", "lake", "checkpoint")
    how = archive.add_mutually_exclusive_group()
    how.add_argument("--by-month", action="store_true")
    how.add_argument("--ledger")
    job("forget", "ledger").add_argument("--days", type=int, default=LEDGER_DAYS)
    job("hitters", "root").add_argument("--hours", type=int, default=RETENTION_HOURS)
    job("expire", "root").add_argument("--hours", type=int, default=RETENTION_HOURS)
    compact = job("compact", "lake", "target")
    compact.add_argument("--year", type=int)
    compact.add_argument("--month", type=int)
    compact.add_argument("--by-day", action="store_true")
    job("hours", "lake", "table")
    tables = job("tables", "lake", "state", "out")
    tables.add_argument("--days", type=int, default=7)
    tables.add_argument("--literal-counts", action="store_true")
    job("silence", "root")
    alarm = job("alarm", "servers", "topic", "root", "checkpoint")
    alarm.add_argument("--seconds", type=int, default=60 * monitoring.SILENCE_MINUTES)
    return parser.parse_args()


def _store(args: argparse.Namespace) -> batch_job.Store:
    if args.out:
        return batch_job.parquet_store(args.out)
    connect = jdbc.connection(
        args.jdbc_url,
        args.jdbc_driver,
        os.environ.get("JDBC_USER"),
        os.environ.get("JDBC_PASSWORD"),
    )
    return batch_job.jdbc_store(connect, truncate=args.truncate)


def _counted(spark: SparkSession, writer: DataStreamWriter) -> None:
    """Run for good, adding up and logging the stream's ingest counters."""
    spark.streams.addListener(IngestTotals())
    run_forever(writer, LIVE_INTERVAL).awaitTermination()


def main() -> None:
    args = _arguments()
    spark = configure(SparkSession.builder.appName(f"tidewatch-{args.job}").getOrCreate())
    if args.job == "batch":
        counts = batch_job.run(
            spark, args.lake, _store(args), args.days, literal_counts=args.literal_counts
        )
        print(counts or "no events in the look-back window, nothing written")
        clean(spark)
    elif args.job == "ingest":
        writer = pipelines.captured_to_topic(
            spark, args.captured, args.servers, args.topic, args.checkpoints
        )
        _counted(spark, writer)
    elif args.job == "live":
        writer = pipelines.topic_to_live(
            spark, args.servers, args.topic, args.root, args.checkpoint, args.max_offsets,
            args.hitters,
        )
        _counted(spark, writer)
    elif args.job == "traffic":
        writer = pipelines.topic_to_traffic(
            spark, args.servers, args.topic, args.root, args.checkpoint, args.max_offsets
        )
        _counted(spark, writer)
    elif args.job == "archive":
        writer = pipelines.topic_to_lake(
            spark, args.servers, args.topic, args.lake, args.checkpoint, not args.by_month,
            args.ledger,
        )
        _counted(spark, writer)
    elif args.job == "expire":
        for table in (
            streams.changes_path(args.root), streams.traffic_path(args.root),
            streams.window_traffic_path(args.root), streams.partials_path(args.root),
            streams.hitters_path(args.root),
        ):
            print(table, retention.expire_levels(spark, table, args.hours))
    elif args.job == "forget":
        print(args.ledger, retention.expire_levels(spark, args.ledger, 24 * args.days))
    elif args.job == "hitters":
        sketches = streams.read_hitters(spark, args.root, args.hours)
        for dimension in heavy_hitters.KEYS:
            heavy_hitters.heavy_keys(sketches, dimension).show(truncate=False)
    elif args.job == "compact":
        lake.compact_lake(spark, args.lake, args.target, args.year, args.month, args.by_day)
    elif args.job == "hours":
        incremental.update_hours(spark, args.lake, args.table)
        clean(spark)
    elif args.job == "tables":
        store = batch_job.parquet_store(args.out)
        counts = incremental.store_tables(
            spark, args.lake, args.state, store, args.days, literal_counts=args.literal_counts
        )
        print(counts or "no events in the look-back window, nothing written")
        clean(spark)
    elif args.job == "alarm":
        writer = pipelines.topic_to_alarms(
            spark, args.servers, args.topic, args.root, args.checkpoint, args.seconds
        )
        run_forever(writer, LIVE_INTERVAL).awaitTermination()
    elif args.job == "silence":
        monitoring.silence_now(streams.read_live_changes(spark, args.root)).show(truncate=False)


if __name__ == "__main__":
    main()
