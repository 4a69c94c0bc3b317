"""Rows that the window query did not count, and the windows they belong to.

A row is left out of a window if it came in after the window had closed, or if it was stamped ahead of
its arrival. Which rows these are follows from silver alone: it tells when each row came in, and the
watermark at that time can be no further than the latest row that came in before. From time to time a
late pass evaluates the windows of such rows again, from all that silver holds, and adds what it finds to
the alerts. Together they are what the rules find over the same rows as a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnguard.functions.time import window_spec
from txnguard.operators import alerts, bursts, rules
from txnguard.schema import INGESTED_AT, RuleParams
from txnguard.session import materialise
from txnguard.streaming.alert_table import AlertTable
from txnguard.streaming.detection import SKEW_SECONDS, WATERMARK_SECONDS, between, burst_alerts, drain_alerts, last_micros, timely
from txnguard.streaming.known import Known, KnownTables

#: The name under which passes are entered in the ledger, and that of the watermark they have reached.
PASS, REACHED = "late_pass", "late_pass_watermark"


def _closed_by(time: Column) -> Column:
    return time - F.expr(f"INTERVAL {WATERMARK_SECONDS} SECONDS")


def watermarks(silver: DataFrame, reached: int | None = None) -> DataFrame:
    """(ingested_at, closed, closed_after): per micro-batch of ingest, the end of windows that may have
    closed before it, and that of those closed once it is in. One row per micro-batch is sorted.

    ``reached`` is the watermark, in microseconds, of what came in before these rows.
    """
    latest = timely(silver).groupBy(INGESTED_AT).agg(_closed_by(F.max("timestamp")).alias("own"))
    at = Window.orderBy(INGESTED_AT)
    start = F.timestamp_micros(F.lit(reached).cast("long"))
    before = F.max("own").over(at.rowsBetween(Window.unboundedPreceding, -1))
    upto = F.max("own").over(at.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    batches = silver.select(INGESTED_AT).distinct().join(latest, INGESTED_AT, "left")
    return batches.select(INGESTED_AT, F.greatest(before, start).alias("closed"), F.greatest(upto, start).alias("closed_after"))


def uncounted(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """The side table: rows that came in behind the watermark or were stamped ahead, with ``closed``."""
    limit = F.col("kafka_timestamp") + F.expr(f"INTERVAL {SKEW_SECONDS} SECONDS")
    ahead = F.coalesce(F.col("timestamp") > limit, F.lit(False))
    marked = rows.join(marks.select(INGESTED_AT, "closed"), INGESTED_AT).withColumn("ahead", ahead)
    return marked.filter(F.col("ahead") | (F.col("timestamp") < F.col("closed")))


def touched(late: DataFrame, length: int, slide: int, before: Column, now: Column, fresh: Column) -> DataFrame:
    """The closed windows that have a row too little: of a late row those closed when it came in; of a row
    stamped ahead those that have closed since the pass ``before``."""
    placed = late.withColumn("window", F.window("timestamp", *window_spec(length, slide)))
    end = F.col("window.end")
    due = (end <= now) & (fresh | (end > before))
    mine = F.when(F.col("ahead"), due).otherwise(fresh & (end <= F.col("closed")))
    windows = placed.filter(mine).select(*bursts.GROUP, F.col("window.start").alias("window_start"), end.alias("window_end"))
    return materialise(windows.distinct())


def late_alerts(
    silver: DataFrame, known: Known, p: RuleParams, since: int | None = None, reached: int | None = None
) -> tuple[DataFrame | None, int | None, int | None]:
    """Alerts of the windows that rows ingested after ``since`` (microseconds; null: from the start) have
    changed, the time up to which silver has been looked at, and its watermark."""
    fresh = F.lit(True) if since is None else F.col(INGESTED_AT) > F.timestamp_micros(F.lit(since))
    marks = materialise(watermarks(silver.filter(fresh), reached))
    until, now = marks.agg(F.unix_micros(F.max(INGESTED_AT)), F.unix_micros(F.max("closed_after"))).first()
    if until is None or now is None:
        return None, since if until is None else until, reached
    seen = silver.filter(F.col(INGESTED_AT) <= F.timestamp_micros(F.lit(until)))
    longest = max(p.burst_seconds, p.drain_seconds)
    # Rows stamped ahead wait for their windows to close; those of windows closed before are done.
    waiting = F.lit(False)
    if reached is not None:
        waiting = ~fresh & (F.col("timestamp") > F.timestamp_micros(F.lit(reached)) - F.expr(f"INTERVAL {longest} SECONDS"))
    low = F.timestamp_micros(F.lit(reached if reached is not None else 0).cast("long"))
    older = seen.filter(waiting).withColumn("closed", low).withColumn("ahead", F.lit(True))
    older = older.filter(F.col("timestamp") > F.col("kafka_timestamp") + F.expr(f"INTERVAL {SKEW_SECONDS} SECONDS"))
    side = uncounted(seen.filter(fresh), marks).withColumn("fresh", F.lit(True))
    late = materialise(side.unionByName(older.withColumn("fresh", F.lit(False))))
    end = F.timestamp_micros(F.lit(now))
    frames = []
    burst = touched(rules.burst_candidates(late, p), p.burst_seconds, p.burst_slide_seconds, low, end, F.col("fresh"))
    rows = between(seen, burst)
    if rows is not None:
        frames.append(burst_alerts(rows, burst, p))
    drain = touched(rules.settled_transfers(late), p.drain_seconds, p.drain_slide_seconds, low, end, F.col("fresh"))
    rows = between(seen, drain)
    if rows is not None:
        frames.append(drain_alerts(rows, drain, known, p))
    return (alerts.union_alerts(frames) if frames else None), until, now


def late_pass(
    spark: SparkSession, silver_path: str, known: Known | KnownTables, p: RuleParams, table: AlertTable, fmt: str = "parquet"
) -> None:
    """Adds the alerts of windows that were evaluated without some of their rows, since the last pass.

    Run it beside the window query, as often as late rows matter; where it has stopped is kept in the
    table's ledger. Windows still open are left to the query, or to a later pass.
    """
    done = table.ledger.done()
    silver = spark.read.format(fmt).load(silver_path)
    since, reached = done.get(PASS), done.get(REACHED)
    found, until, now = late_alerts(silver, known.as_of(last_micros(silver, INGESTED_AT)), p, since, reached)
    if until is None or until == since:
        return
    folder = table.stage(found, f"{PASS}-{until}") if found is not None else None
    marks = {PASS: until} if now is None else {PASS: until, REACHED: now}
    table.ledger.commit(f"{PASS}-{until}", folder, marks)
