"""Where alerts go. Every sink takes the findings of a numbered micro-batch, and takes them once."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.operators import alerts
from txnguard.schema import ALERT_FIELDS, ALERT_SCHEMA
from txnguard.sources.database import Database, alert_row_types, execute, merge_statement, write_database
from txnguard.streaming.ledger import Ledger, load_or_none


class AlertSink(Protocol):
    def write_batch(self, found: DataFrame, batch_id: int, query_id: str = "batch") -> None:
        """Stores what a batch has found. The same batch again, after a crash, changes nothing."""


class AlertTable:
    """Alerts in parquet: a folder per batch, which counts once the ledger names it.

    Batches are numbered anew for each checkpoint, so the query's id, which is kept in the checkpoint,
    tells them apart. A batch is only appended, whatever other batches hold; readers see one alert per
    transaction: the strongest reason, of that the earliest window as it was last evaluated, with most
    rows. So neither the order in which batches arrive nor an evaluation that is repeated with late rows
    leaves a trace.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.ledger = Ledger(spark, f"{self.path}/ledger")
        self.retractions = f"{self.path}/retracted"
        self._done: dict[str, int] = {}

    def _write(self, rows: DataFrame, name: str) -> str:
        folder = f"{self.path}/data/{name}-{uuid.uuid4().hex}"
        rows.select(*ALERT_FIELDS, "created_at").write.parquet(folder)
        return folder

    def write_batch(self, found: DataFrame, batch_id: int, query_id: str = "batch") -> None:
        if query_id not in self._done:
            # Only the first batch after a start can be one that is in the ledger.
            self._done[query_id] = self.ledger.done().get(query_id, -1)
        if batch_id <= self._done[query_id]:
            return
        name = f"{query_id}-{batch_id}"
        folder = self.stage(found, name)
        if folder:
            self.ledger.commit(name, folder, {query_id: batch_id})
        self._done[query_id] = batch_id

    def stage(self, found: DataFrame, name: str) -> str | None:
        """Writes alerts to a folder that does not count yet; None if there are none."""
        fresh = alerts.one_per_txn(found).withColumn("created_at", F.current_timestamp()).persist()
        try:
            return None if fresh.isEmpty() else self._write(fresh, name)
        finally:
            fresh.unpersist()

    def _stored(self, folders: list[str]) -> DataFrame | None:
        if not folders:
            return None
        schema = ALERT_SCHEMA.simpleString()[len("struct<") : -1] + ",created_at:timestamp"
        return load_or_none(self.spark, *folders, schema=schema.replace(":", " "))

    def _standing(self, rows: DataFrame) -> DataFrame:
        gone = load_or_none(self.spark, self.retractions)
        one = alerts.one_per_txn(rows)
        return one if gone is None else alerts.retract(one, gone)

    def read(self) -> DataFrame | None:
        """One alert per transaction, of those not taken back; None before the first one is written."""
        stored = self._stored([e.folder for e in self.ledger.entries() if e.folder])
        return None if stored is None else self._standing(stored)

    def retract(self, keys: DataFrame) -> None:
        """Takes alerts back by ``txn_id``. Keys are appended, no alert file is rewritten."""
        keys.select("txn_id").distinct().write.mode("append").parquet(self.retractions)

    def compact(self) -> None:
        """Puts the batches so far into one folder, sorted by time, one alert per transaction.

        Runs beside writers and readers: batches committed meanwhile stay as they are. Until the commit,
        and if it never comes, nothing has changed. Replaced folders are left to those who still read them.
        """
        entries = self.ledger.entries()
        stored = self._stored([e.folder for e in entries if e.folder])
        if len(entries) < 2:
            return
        name = f"compaction-{uuid.uuid4().hex}"
        folder = None
        if stored is not None:
            laid = self._standing(stored).repartitionByRange("txn_timestamp").sortWithinPartitions("txn_timestamp")
            folder = self._write(laid, name)
        done = {q: max(e.done.get(q, -1) for e in entries) for e in entries for q in e.done}
        self.ledger.commit(name, folder, done, [e.name for e in entries])


class DatabaseAlerts:
    """Alerts in a relational table with a unique key on ``txn_id``.

    A batch is written to a staging table of its query, then moved over by one statement that leaves
    known transactions alone. Run again after a crash, it stages the same rows and moves none of them.
    """

    def __init__(
        self,
        database: Database,
        table: str,
        stage: Callable[[DataFrame, Database, str], None] = write_database,
        run: Callable[[SparkSession, Database, str], None] = execute,
    ) -> None:
        self.database, self.table, self.stage, self.run = database, table, stage, run

    def write_batch(self, found: DataFrame, batch_id: int, query_id: str = "batch") -> None:
        staging = f"{self.table}_staging_{query_id.replace('-', '_')}"
        self.stage(alert_row_types(alerts.one_per_txn(found)), self.database, staging)
        self.run(found.sparkSession, self.database, merge_statement(staging, self.table))


class DeltaAlerts:
    """The same in a Delta table, by its own transaction."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def write_batch(self, found: DataFrame, batch_id: int, query_id: str = "batch") -> None:
        fresh = alerts.one_per_txn(found).withColumn("created_at", F.current_timestamp())
        fresh.createOrReplaceTempView("fresh_alerts")
        self.spark.sql(delta_merge(self.path, "fresh_alerts"))


class AllSinks:
    """Several sinks in turn. Each takes a batch once, so a crash between them repeats nothing."""

    def __init__(self, *sinks: AlertSink) -> None:
        self.sinks = sinks

    def write_batch(self, found: DataFrame, batch_id: int, query_id: str = "batch") -> None:
        kept = found.persist()
        try:
            for sink in self.sinks:
                sink.write_batch(kept, batch_id, query_id)
        finally:
            kept.unpersist()


def delta_merge(path: str, source: str) -> str:
    """The statement that adds alerts of unknown transactions to a Delta table."""
    columns = [*ALERT_FIELDS, "created_at"]
    return (
        f"MERGE INTO delta.`{path}` t USING {source} s ON t.txn_id = s.txn_id "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join(f's.{c}' for c in columns)})"
    )
