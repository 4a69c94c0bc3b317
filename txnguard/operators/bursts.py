"""Groups of transactions close in time: windows of one sender and device."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.time import pane, window_spec
from txnguard.schema import INGESTED_AT
from txnguard.session import materialise

GROUP = ["sender_upi", "sender_device_id"]
# Sums in decimals do not depend on the order of rows. An amount that does not fit breaks the
# contract; where the contract was not applied, the job fails rather than leaving it out.
EXACT_AMOUNT = "decimal(28,2)"


def crowded(df: DataFrame, length: int, slide: int, min_txns: int) -> DataFrame:
    """Batch only: the rows that can be in a window of at least ``min_txns``; no such row is lost.

    Counts per slide-long pane are summed over all panes that share a window with a pane. The
    sum bounds every such window from above. This replaces the copying of each row into
    every sliding window by one narrow count, and leaves that copying to the few rows left.
    Panes of one group are bounded by the time span, not by its rows. The busy panes are
    written down first, so the planner knows their size: few are broadcast and the rows are
    not shuffled, many are joined by shuffle.
    """
    reach = length - slide
    panes = df.groupBy(*GROUP, pane("timestamp", slide).alias("pane")).agg(
        F.count(F.lit(1)).alias("n")
    )
    around = F.expr(
        f"sum(n) OVER (PARTITION BY {', '.join(GROUP)} ORDER BY pane RANGE BETWEEN "
        f"INTERVAL {reach} SECONDS PRECEDING AND INTERVAL {reach} SECONDS FOLLOWING)"
    )
    busy = panes.withColumn("around", around).filter(F.col("around") >= min_txns)
    busy = materialise(busy.select(*GROUP, "pane"))
    keyed = df.withColumn("pane", pane("timestamp", slide))
    return keyed.join(busy, [*GROUP, "pane"], "left_semi").drop("pane")


def windows(
    df: DataFrame, length: int, slide: int, min_txns: int, min_payees: int = 1
) -> DataFrame:
    """Windows with enough transactions to enough payees; for batches and streams alike.

    Payees are told apart by a first aggregation that has the payee in its key, so no set
    of payees is ever built, and a hot sender is spread over tasks by payee.
    """
    sliding = F.window("timestamp", *window_spec(length, slide))
    found = qualified(df.withColumn("window", sliding), ["window"], min_txns, min_payees)
    return found.select(
        *GROUP,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in found.columns if c not in (*GROUP, "window")],
    )


def qualified(df: DataFrame, window: list[str], min_txns: int, min_payees: int = 1) -> DataFrame:
    """(window, group, txn_count, total_amount) of the windows with enough rows, given each row's windows.

    Where rows tell when they were ingested, ``seen_until`` is the last of these times in the window: no
    row ingested later has been counted.
    """
    keys, amount = [*window, *GROUP], F.col("amount").cast(EXACT_AMOUNT)
    seen = [INGESTED_AT] if INGESTED_AT in df.columns else []
    last = [F.max(c).alias("seen_until") for c in seen]
    if min_payees <= 1:
        sums = [F.count(F.lit(1)).alias("txn_count"), F.sum(amount).alias("total_amount")]
        return df.groupBy(*keys).agg(*sums, *last).filter(F.col("txn_count") >= min_txns)
    per_payee = df.groupBy(*keys, "receiver_upi").agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).alias("payee_amount"), *last
    )
    sums = [F.sum("n").alias("txn_count"), F.sum("payee_amount").alias("total_amount"), F.count(F.lit(1)).alias("payees")]
    found = per_payee.groupBy(*keys).agg(*sums, *[F.max("seen_until").alias("seen_until") for _ in seen])
    return found.filter((F.col("txn_count") >= min_txns) & (F.col("payees") >= min_payees)).drop("payees")


def _earliest_per_pane(hits: DataFrame, slide: int) -> DataFrame:
    step = F.expr(f"INTERVAL {slide} SECONDS")
    panes = F.sequence(F.col("window_start"), F.col("window_end") - step, step)
    whole = F.struct("window_start", "window_end", "txn_count", "total_amount")
    return (
        hits.withColumn("pane", F.explode(panes))
        .groupBy(*GROUP, "pane")
        .agg(F.min(whole).alias("first"))
        .select(*GROUP, "pane", "first.*")
    )


def members(df: DataFrame, hits: DataFrame, slide: int) -> DataFrame:
    """The transactions inside the windows found, each once, with its earliest window.

    All rows of a pane lie in the same windows, so the earliest is looked up per pane and
    joined on equality. The look-up table is stored first, so that the join can be a
    broadcast by its real size, or else split a hot pane.
    """
    first = materialise(_earliest_per_pane(hits, slide))
    keyed = df.withColumn("pane", pane("timestamp", slide))
    return keyed.join(first, [*GROUP, "pane"]).drop("pane")


def in_windows(df: DataFrame, hits: DataFrame, slide: int) -> DataFrame:
    """The rows of the same group in the time of each window, once per window, with the columns of
    ``hits``. Where hits tell until when rows were seen, rows ingested later are left out."""
    step = F.expr(f"INTERVAL {slide} SECONDS")
    panes = F.explode(F.sequence(F.col("window_start"), F.col("window_end") - step, step)).alias("pane")
    by_pane = materialise(hits.select("*", panes))
    rows = df.withColumn("pane", pane("timestamp", slide)).join(by_pane, [*GROUP, "pane"]).drop("pane")
    if "seen_until" in hits.columns:
        rows = rows.filter(F.col(INGESTED_AT) <= F.col("seen_until")).drop("seen_until")
    return rows
