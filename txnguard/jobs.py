"""The jobs of a deployment, to be submitted one by one:

    spark-submit txnguard/jobs.py ingest --lake LAKE --topic payments --servers host:9092
    spark-submit txnguard/jobs.py profile --lake LAKE --before "2024-01-16 00:00:00"
    spark-submit txnguard/jobs.py detect --lake LAKE
    spark-submit txnguard/jobs.py late --lake LAKE
    spark-submit txnguard/jobs.py compact --lake LAKE

``ingest`` and ``detect`` run until they are stopped, or with ``--once`` until what is there is done.
With ``--database`` alerts go to a relational table too. Messages come from a topic, or with ``--files``
from a folder of parquet files with the columns key, value and timestamp.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from txnguard.operators import profile
from txnguard.schema import RuleParams
from txnguard.session import build_session
from txnguard.sources.database import Database
from txnguard.sources.tables import read_table, stream_table
from txnguard.sources.topics import Topic, stream_topic
from txnguard.streaming import ingest, monitor
from txnguard.streaming.alert_table import AlertSink, AlertTable, AllSinks, DatabaseAlerts
from txnguard.streaming.detection import alert_writers
from txnguard.streaming.known import KnownTables
from txnguard.streaming.late import late_pass

MESSAGES = "key binary, value binary, timestamp timestamp"


class Lake:
    """Where the tables lie below one folder."""

    def __init__(self, root: str) -> None:
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def _arguments(given: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="txnguard", description="Fraud analytics for payment transactions.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--lake", required=True, help="folder of all tables and checkpoints")
    parser.add_argument("--topic", help="topic of the messages (ingest)")
    parser.add_argument("--servers", help="bootstrap servers of the topic (ingest)")
    parser.add_argument("--files", help="folder of messages, instead of a topic (ingest)")
    parser.add_argument("--before", help="time before which transactions are history (profile)")
    parser.add_argument("--database", help="JDBC URL of a database for alerts (detect)")
    parser.add_argument("--table", default="fraud_alerts", help="table of alerts in the database (detect)")
    parser.add_argument("--once", action="store_true", help="stop when all that is there is done")
    parser.add_argument("--every", default="10 seconds", help="how often a micro-batch starts")
    parser.add_argument("--max-files", type=int, help="files of a micro-batch, at most")
    return parser.parse_args(given)


def _run(writers: list[DataStreamWriter], args: argparse.Namespace) -> list[StreamingQuery]:
    trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
    return [writer.trigger(**trigger).start() for writer in writers]


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return spark.readStream.schema(MESSAGES).parquet(args.files)
    if not (args.topic and args.servers):
        raise SystemExit("give --topic and --servers, or --files")
    return stream_topic(spark, Topic(args.servers, args.topic))


def ingest_job(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    """Topic to bronze, silver and quarantine."""
    bronze = ingest.bronze_writer(_messages(spark, args), lake.bronze, lake.checkpoint("bronze"))
    queries = _run([bronze], args)
    if args.once:
        monitor.await_all(queries)
    else:
        # Readers of bronze need its first micro-batch.
        queries[0].processAllAvailable()
    rest = [("silver", ingest.silver_writer), ("quarantine", ingest.quarantine_writer)]
    for name, writer in rest:
        stream = stream_table(spark, lake.bronze, ingest.BRONZE_TABLE_SCHEMA, max_files_per_trigger=args.max_files)
        queries += _run([writer(stream, f"{lake.root}/{name}", lake.checkpoint(name))], args)
    monitor.await_all(queries)


def profile_job(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    """A new version of what rules hold transactions against; running queries take it up."""
    silver = read_table(spark, lake.silver)
    history = profile.history_before(silver, args.before) if args.before else silver.filter("status = 'SUCCESS'")
    KnownTables(spark, lake.known).publish(history)


def detect_job(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    """Silver to alerts, by both queries."""
    sink: AlertSink = AlertTable(spark, lake.alerts)
    if args.database:
        sink = AllSinks(sink, DatabaseAlerts(Database(args.database), args.table))
    stream = stream_table(spark, lake.silver, ingest.SILVER_SCHEMA, max_files_per_trigger=args.max_files)
    known = KnownTables(spark, lake.known)
    writers = alert_writers(spark, stream, lake.silver, known, RuleParams(), sink, lake.checkpoint("alerts"))
    monitor.await_all(_run(writers, args))


def late_job(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    """Windows that were evaluated without some of their rows."""
    late_pass(spark, lake.silver, KnownTables(spark, lake.known), RuleParams(), AlertTable(spark, lake.alerts))


def compact_job(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    AlertTable(spark, lake.alerts).compact()


JOBS = {"ingest": ingest_job, "profile": profile_job, "detect": detect_job, "late": late_job, "compact": compact_job}


def main(given: Sequence[str], spark: SparkSession | None = None) -> None:
    args = _arguments(given)
    JOBS[args.job](spark or build_session(f"txnguard-{args.job}"), Lake(args.lake), args)


if __name__ == "__main__":
    main(sys.argv[1:])
