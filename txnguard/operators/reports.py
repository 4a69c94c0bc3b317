"""Checks and reports over transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnguard.functions.time import pane, window_spec
from txnguard.operators.bursts import EXACT_AMOUNT
from txnguard.session import materialise


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def repeated_ids(txns: DataFrame) -> DataFrame:
    """Ids that occur more than once: has to be empty behind an exactly-once ingest."""
    return txns.groupBy("txn_id").count().filter("count > 1")


def first_of_each_id(txns: DataFrame) -> DataFrame:
    """One row per id, the first to arrive. Batch twin of the streaming removal of repeats."""
    order = W.partitionBy("txn_id").orderBy("kafka_timestamp", "timestamp")
    return txns.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def lookup(txns: DataFrame, txn_id: str) -> DataFrame:
    return txns.filter(F.col("txn_id") == txn_id)


def within_skew(txns: DataFrame, tolerance_seconds: int) -> DataFrame:
    """Rows stamped no later than their arrival plus a tolerance.

    One row from the future would push a watermark past everybody else's present.
    """
    limit = F.col("kafka_timestamp") + F.expr(f"INTERVAL {tolerance_seconds} SECONDS")
    return txns.filter(F.col("timestamp") <= limit)


def sender_window_stats(txns: DataFrame, length: int, slide: int) -> DataFrame:
    """Count and sum per sender and event-time window."""
    found = txns.groupBy(
        F.window("timestamp", *window_spec(length, slide)).alias("window"), "sender_upi"
    ).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum(F.col("amount").cast(EXACT_AMOUNT)).alias("total_amount"),
    )
    return found.select(
        "sender_upi",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "txn_count",
        "total_amount",
    )


#: Rows of a sender in one chunk of time that one task may sort.
MOST_IN_CHUNK = 1_000_000


def sender_velocity(txns: DataFrame, seconds: int, chunk: int = 4, most: int = MOST_IN_CHUNK) -> DataFrame:
    """Per transaction: count and sum of the sender's trailing ``seconds``, itself included.

    A sender is cut into chunks of time, so a hot one is spread over tasks; the tail of a
    chunk is carried into the next as context and dropped again after the window. Senders with more
    than ``most`` rows in a chunk are told first, and theirs are differences of running totals.
    """
    rows = txns.select("txn_id", "sender_upi", "timestamp", "amount")
    per_chunk = rows.groupBy("sender_upi", pane("timestamp", seconds * chunk)).count()
    heavy = materialise(per_chunk.filter(F.col("count") > most).select("sender_upi").distinct())
    if heavy.isEmpty():
        return _velocity_by_chunk(rows, seconds, chunk)
    light = _velocity_by_chunk(rows.join(heavy, "sender_upi", "left_anti"), seconds, chunk)
    return light.unionByName(_velocity_by_totals(rows.join(heavy, "sender_upi", "left_semi"), seconds))


def _velocity_by_chunk(rows: DataFrame, seconds: int, chunk: int) -> DataFrame:
    span = seconds * chunk
    step = F.expr(f"INTERVAL {span} SECONDS")
    carried = F.col("timestamp") >= F.col("_chunk") + F.expr(f"INTERVAL {span - seconds} SECONDS")
    here = F.struct(F.col("_chunk").alias("chunk"), F.lit(True).alias("own"))
    there = F.struct((F.col("_chunk") + step).alias("chunk"), F.lit(False).alias("own"))
    placed = rows.withColumn("_chunk", pane("timestamp", span)).withColumn(
        "_at", F.explode(F.when(carried, F.array(here, there)).otherwise(F.array(here)))
    )
    trailing = (
        "OVER (PARTITION BY sender_upi, _at.chunk ORDER BY timestamp "
        f"RANGE BETWEEN INTERVAL {seconds} SECONDS PRECEDING AND CURRENT ROW)"
    )
    return (
        placed.select(
            "txn_id",
            "sender_upi",
            "timestamp",
            "_at",
            F.expr(f"count(1) {trailing}").alias("recent_count"),
            F.expr(f"sum(CAST(amount AS {EXACT_AMOUNT})) {trailing}").alias("recent_amount"),
        )
        .filter("_at.own")
        .drop("_at")
    )


def _velocity_by_totals(rows: DataFrame, seconds: int) -> DataFrame:
    """The total up to a time less the total before the window's begin.

    Rows of one time are added up first. Each time asks for the total before its window by an entry of
    its own, and all entries are sorted by range: a sender is spread over as many tasks as its rows need,
    and what a range adds is carried to the next ones. Ranges are cut by volume, whatever the times are.
    """
    times = materialise(
        rows.groupBy("sender_upi", "timestamp").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("amount").cast(EXACT_AMOUNT)).alias("total"),
            F.count("amount").alias("known"),
        )
    )
    begin = F.col("timestamp") - F.expr(f"INTERVAL {seconds} SECONDS")
    sums = ["n", "total", "known"]
    nothing = [F.lit(0).cast(times.schema[c].dataType).alias(c) for c in sums]
    entry = F.array(
        F.struct(begin.alias("at"), F.lit(0).alias("kind"), *nothing),
        F.struct(F.col("timestamp").alias("at"), F.lit(1).alias("kind"), *[F.coalesce(c, F.lit(0)).cast(times.schema[c].dataType).alias(c) for c in sums]),
    )
    order = ["sender_upi", "at", "kind"]
    entries = times.select("sender_upi", "timestamp", F.inline(entry))
    laid = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = materialise(laid.withColumn("part", F.spark_partition_id()))
    ahead = W.partitionBy("sender_upi").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = laid.groupBy("sender_upi", "part").agg(*[F.sum(c).alias(c) for c in sums])
    carried = materialise(parts.select("sender_upi", "part", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"{c}_before") for c in sums]))
    inside = W.partitionBy("part", "sender_upi").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = laid.select("sender_upi", "timestamp", "part", "kind", *[F.sum(c).over(inside).alias(c) for c in sums])
    upto = running.join(carried, ["sender_upi", "part"]).select(
        "sender_upi", "timestamp", *[F.when(F.col("kind") == 1, F.col(c) + F.col(f"{c}_before")).otherwise(-F.col(c) - F.col(f"{c}_before")).alias(c) for c in sums]
    )
    recent = upto.groupBy("sender_upi", "timestamp").agg(*[F.sum(c).alias(c) for c in sums])
    amount = F.when(F.col("known") > 0, F.col("total")).cast("decimal(38,2)").alias("recent_amount")
    stored = materialise(recent.select("sender_upi", "timestamp", F.col("n").alias("recent_count"), amount))
    return rows.drop("amount").join(stored, ["sender_upi", "timestamp"]).select(
        "txn_id", "sender_upi", "timestamp", "recent_count", "recent_amount"
    )


def _mix(df: DataFrame) -> list:
    total = F.sum(F.col("amount").cast(EXACT_AMOUNT))
    return [
        F.count(F.lit(1)).alias("n_txns"),
        total.alias("total_amount"),
        (total.cast("double") / F.count(F.lit(1))).alias("mean_amount"),
    ]


def traffic_mix(txns: DataFrame) -> DataFrame:
    """By receiver type and category, with subtotals and a grand total (null = all)."""
    return txns.rollup("receiver_type", "receiver_category").agg(
        F.grouping_id().alias("level"), *_mix(txns)
    )


def traffic_by(txns: DataFrame, column: str) -> DataFrame:
    return txns.groupBy(column).agg(*_mix(txns))


def key_skew(txns: DataFrame, partitions: int) -> DataFrame:
    """How a topic of so many partitions would be loaded by keys: rows, keys, heaviest key."""
    place = F.conv(F.substring(F.md5("sender_upi"), 1, 8), 16, 10).cast("bigint") % partitions
    return (
        txns.groupBy("sender_upi")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(place.alias("topic_partition"))
        .agg(
            F.sum("n").alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
            F.max("n").alias("heaviest_key_rows"),
        )
    )


def ingest_rate(messages: DataFrame, partition_bytes_per_second: float) -> DataFrame:
    """Per minute of arrival: messages, bytes of key and value, topic partitions needed."""
    size = F.octet_length("key") + F.octet_length("value")
    minute = F.window("timestamp", "1 minute")["start"].alias("minute_start")
    per_second = F.col("n_bytes") / 60.0
    return (
        messages.groupBy(minute)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(size).alias("n_bytes"))
        .withColumn("partitions_needed", F.ceil(per_second / F.lit(partition_bytes_per_second)))
    )


def ingest_peak(rate: DataFrame) -> DataFrame:
    return rate.agg(
        F.max("n_rows").alias("peak_rows"),
        F.max("n_bytes").alias("peak_bytes"),
        F.max("partitions_needed").alias("partitions_needed"),
        F.count(F.lit(1)).alias("n_minutes"),
    )
