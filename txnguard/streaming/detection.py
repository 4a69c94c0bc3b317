"""The rules over the silver table as streams: one query for single transactions, one for windows.

Profiles are joined inside each micro-batch, where a batch plan can split a hot sender and where the
version of the profile is chosen. Window state holds counts only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from txnguard.operators import alerts, bursts, profile, reports, rules
from txnguard.schema import DEVICE_DRAIN, INGESTED_AT, RAPID_FIRE, RuleParams
from txnguard.session import materialise
from txnguard.streaming.alert_table import AlertSink
from txnguard.streaming.ingest import EVENT_DATE
from txnguard.streaming.known import Known, KnownTables

# Events of a burst are stamped up to 44 s ahead of publication and up to 29 s out of order.
SKEW_SECONDS = 60
WATERMARK_SECONDS = 120


def timely(rows: DataFrame) -> DataFrame:
    """Rows that windows may see at once: none stamped far ahead of its arrival, as one such row would
    make all others late."""
    return reports.within_skew(rows, SKEW_SECONDS)


def window_hits(stream: DataFrame, p: RuleParams) -> DataFrame:
    """Windows that can hold a burst or a drain, from counts alone: no members are gathered in state.

    Whether a transfer is high for its sender, from a device not seen before, is looked up once a window
    of enough transfers has closed.
    """
    rows = timely(stream).withWatermark("timestamp", f"{WATERMARK_SECONDS} seconds")
    burst = rules.burst_windows(rules.burst_candidates(rows, p), p)
    drain = rules.drain_windows(rules.settled_transfers(rows), p)
    named = [(burst, RAPID_FIRE), (drain, DEVICE_DRAIN)]
    frames = [hits.withColumn("fraud_reason", F.lit(reason)) for hits, reason in named]
    return frames[0].unionByName(frames[1])


def between(silver: DataFrame, windows: DataFrame) -> DataFrame | None:
    """Silver rows of the days that windows lie in; None without windows.

    Days are listed one by one, so that two windows a year apart do not ask for the year between. They
    travel as numbers, so the zone of the driver's clock plays no part.
    """
    days = windows.select(F.explode(F.sequence(F.unix_date(F.to_date("window_start")), F.unix_date(F.to_date("window_end")))).alias("day"))
    found = [r["day"] for r in days.distinct().collect()]
    if not found:
        return None
    return silver.filter(F.col(EVENT_DATE).isin([F.date_from_unix_date(F.lit(day)) for day in sorted(found)]))


def burst_alerts(rows: DataFrame, windows: DataFrame, p: RuleParams) -> DataFrame:
    """Alerts of burst windows, counted again from the rows that they saw."""
    inside = bursts.in_windows(rules.burst_candidates(rows, p), windows, p.burst_slide_seconds)
    return rules.window_alerts(materialise(inside), RAPID_FIRE, p.burst_min_txns, p.burst_min_payees)


def drain_alerts(rows: DataFrame, windows: DataFrame, known: Known, p: RuleParams) -> DataFrame:
    """Alerts of windows with enough high transfers from an unseen device, of the rows that they saw."""
    inside = bursts.in_windows(rules.settled_transfers(rows), windows, p.drain_slide_seconds)
    enriched = profile.enrich(materialise(inside), known.profile, p.spend_floor)
    candidates = materialise(rules.drain_candidates(enriched, known.seen_devices, p))
    return rules.window_alerts(candidates, DEVICE_DRAIN, p.drain_min_txns)


def alerts_of_windows(hits: DataFrame, silver: DataFrame, known: Known, p: RuleParams) -> DataFrame | None:
    """Windows as alerts; members are looked up in silver. ``hits`` is read twice: give it persisted.

    Hits tell until when their rows came in, so a batch that is run again finds the same members,
    whatever has been added to silver since.
    """
    frames = []
    for reason in (RAPID_FIRE, DEVICE_DRAIN):
        windows = hits.filter(F.col("fraud_reason") == reason).drop("fraud_reason", "txn_count", "total_amount")
        rows = between(silver, windows)
        if rows is not None:
            rows = timely(rows)
            frames.append(burst_alerts(rows, windows, p) if reason == RAPID_FIRE else drain_alerts(rows, windows, known, p))
    return alerts.union_alerts(frames) if frames else None


def alerts_of_rows(rows: DataFrame, known: Known, p: RuleParams) -> DataFrame:
    """The rules that look at one transaction and its sender's past."""
    enriched = profile.enrich(rows, known.profile, p.spend_floor)
    marked = profile.with_new(enriched, known.seen_states, profile.STATE, "new_state")
    return rules.point_alerts(marked, p)


def last_micros(rows: DataFrame, column: str) -> int | None:
    """Times travel as microseconds, so the zone of the driver's clock plays no part."""
    return rows.agg(F.unix_micros(F.max(column))).first()[0]


def _writer(
    spark: SparkSession, found: DataFrame, name: str, checkpoint: str, write: Callable[[DataFrame, int, str], None]
) -> DataStreamWriter:
    query_ids: list[str] = []

    def write_batch(rows: DataFrame, batch_id: int) -> None:
        if not query_ids:
            # Batches are numbered per checkpoint, which keeps its query's id.
            query_ids.append(spark.read.json(f"{checkpoint}/metadata").first()["id"])
        write(rows, batch_id, query_ids[0])

    return (
        found.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .foreachBatch(write_batch)
    )


def point_writer(
    spark: SparkSession, stream: DataFrame, known: Known | KnownTables, p: RuleParams, sink: AlertSink, checkpoint: str
) -> DataStreamWriter:
    """Amounts, hours and places. ``stream`` is the silver table as a stream."""

    def write(rows: DataFrame, batch_id: int, query_id: str) -> None:
        now = known if isinstance(known, Known) else known.as_of(last_micros(rows, INGESTED_AT))
        sink.write_batch(alerts_of_rows(rows, now, p), batch_id, query_id)

    return _writer(spark, stream, "point_alerts", checkpoint, write)


def window_writer(
    spark: SparkSession,
    stream: DataFrame,
    silver_path: str,
    known: Known | KnownTables,
    p: RuleParams,
    sink: AlertSink,
    checkpoint: str,
    fmt: str = "parquet",
) -> DataStreamWriter:
    """Bursts and drains. ``stream`` is the silver table at ``silver_path`` as a stream."""

    def write(found: DataFrame, batch_id: int, query_id: str) -> None:
        hits = found.persist()
        try:
            if hits.isEmpty():
                return
            silver = spark.read.format(fmt).load(silver_path)
            now = known.as_of(last_micros(hits, "seen_until"))
            of_batch = alerts_of_windows(hits, silver, now, p)
            if of_batch is not None:
                sink.write_batch(of_batch, batch_id, query_id)
        finally:
            hits.unpersist()

    return _writer(spark, window_hits(stream, p), "window_alerts", checkpoint, write)


def alert_writers(
    spark: SparkSession,
    stream: DataFrame,
    silver_path: str,
    known: Known | KnownTables,
    p: RuleParams,
    sink: AlertSink,
    checkpoint: str,
    fmt: str = "parquet",
) -> list[DataStreamWriter]:
    """Both queries, each with its checkpoint below the given folder."""
    return [
        point_writer(spark, stream, known, p, sink, f"{checkpoint}/points"),
        window_writer(spark, stream, silver_path, known, p, sink, f"{checkpoint}/windows", fmt),
    ]
