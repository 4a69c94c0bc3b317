"""The five rules. Point rules take enriched transactions, on batches and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.functions.time import ist_hour
from txnguard.operators import bursts
from txnguard.operators.profile import DEVICE, SENDER, STATE
from txnguard.schema import (
    ALERT_FIELDS,
    AMOUNT,
    DEVICE_DRAIN,
    LOCATION,
    ODD_HOUR,
    RAPID_FIRE,
    RuleParams,
)
from txnguard.session import materialise


def _alerts(df: DataFrame, reason: str | Column) -> DataFrame:
    """Rows in alert form. ``df`` has the window columns if the rule looks at windows."""
    if "txn_count" not in df.columns:
        df = df.withColumns(
            {
                "window_start": F.col("timestamp"),
                "window_end": F.col("timestamp"),
                "txn_count": F.lit(None),
                "total_amount": F.lit(None),
            }
        )
    return df.withColumns(
        {
            "amount": F.col("amount").cast("decimal(28,2)"),
            "total_amount": F.col("total_amount").cast("decimal(38,2)"),
            "txn_count": F.col("txn_count").cast("long"),
            "txn_timestamp": F.col("timestamp"),
            "fraud_reason": reason if isinstance(reason, Column) else F.lit(reason),
        }
    ).select(ALERT_FIELDS)


def _not_in_history(df: DataFrame, attribute: str, seen: DataFrame) -> DataFrame:
    """Rows of senders with a profile whose attribute is not among their distinct pairs ``seen``."""
    known = df.filter(F.col("typical_spend").isNotNull() & F.col(attribute).isNotNull())
    return known.join(seen, [SENDER, attribute], "left_anti")


def _is_odd_hour(enriched: DataFrame, p: RuleParams) -> Column:
    hour = ist_hour(enriched, "timestamp")
    return (F.col("ratio") >= p.odd_hour_ratio) & hour.between(p.odd_hour_first, p.odd_hour_last)


def odd_hour(enriched: DataFrame, p: RuleParams) -> DataFrame:
    """A high amount in the small hours."""
    return _alerts(enriched.filter(_is_odd_hour(enriched, p)), ODD_HOUR)


def amount_anomaly(enriched: DataFrame, p: RuleParams) -> DataFrame:
    """An amount far above the sender's typical spend."""
    return _alerts(enriched.filter(F.col("ratio") >= p.amount_ratio), AMOUNT)


def location(enriched: DataFrame, seen_states: DataFrame) -> DataFrame:
    """A state the sender has not paid from before."""
    return _alerts(_not_in_history(enriched, STATE, seen_states), LOCATION)


def _is_new_state() -> Column:
    return F.col("typical_spend").isNotNull() & F.col(STATE).isNotNull() & F.col("new_state")


def point_alerts(marked: DataFrame, p: RuleParams) -> DataFrame:
    """The three point rules in one pass. ``marked`` has ``ratio`` and ``new_state``."""
    reasons = F.array_compact(
        F.array(
            F.when(F.col("ratio") >= p.amount_ratio, AMOUNT),
            F.when(_is_odd_hour(marked, p), ODD_HOUR),
            F.when(_is_new_state(), LOCATION),
        )
    )
    return _alerts(marked.withColumn("reason", F.explode(reasons)), F.col("reason"))


def _settled_transfers() -> Column:
    return (F.col("receiver_type") == "P2P") & (F.col("status") == "SUCCESS")


def burst_candidates(txns: DataFrame, p: RuleParams) -> DataFrame:
    rows = txns.filter(_settled_transfers())
    if p.burst_max_amount is not None:
        rows = rows.filter(F.col("amount") <= p.burst_max_amount)
    return rows


def burst_windows(candidates: DataFrame, p: RuleParams) -> DataFrame:
    return bursts.windows(
        candidates, p.burst_seconds, p.burst_slide_seconds, p.burst_min_txns, p.burst_min_payees
    )


def burst_alerts(candidates: DataFrame, hits: DataFrame, p: RuleParams) -> DataFrame:
    return _alerts(bursts.members(candidates, hits, p.burst_slide_seconds), RAPID_FIRE)


def rapid_fire(txns: DataFrame, p: RuleParams) -> DataFrame:
    """Many small transfers to many payees within a window, from one device."""
    near = bursts.crowded(
        burst_candidates(txns, p), p.burst_seconds, p.burst_slide_seconds, p.burst_min_txns
    )
    near = materialise(near)
    return burst_alerts(near, burst_windows(near, p), p)


def drain_candidates(enriched: DataFrame, seen_devices: DataFrame, p: RuleParams) -> DataFrame:
    rows = enriched.filter(_settled_transfers() & (F.col("ratio") >= p.drain_ratio))
    return _not_in_history(rows, DEVICE, seen_devices)


def drain_windows(candidates: DataFrame, p: RuleParams) -> DataFrame:
    return bursts.windows(candidates, p.drain_seconds, p.drain_slide_seconds, p.drain_min_txns)


def settled_transfers(txns: DataFrame) -> DataFrame:
    return txns.filter(_settled_transfers())


def window_alerts(rows: DataFrame, reason: str, min_txns: int, min_payees: int = 1) -> DataFrame:
    """Alerts of windows whose rows are given, each row once per window it lies in."""
    window = ["window_start", "window_end"]
    hits = bursts.qualified(rows, window, min_txns, min_payees).drop("seen_until")
    return _alerts(rows.join(hits, [*window, *bursts.GROUP]), reason)


def drain_alerts(candidates: DataFrame, hits: DataFrame, p: RuleParams) -> DataFrame:
    return _alerts(bursts.members(candidates, hits, p.drain_slide_seconds), DEVICE_DRAIN)


def unseen_device_drain(
    enriched: DataFrame, seen_devices: DataFrame, p: RuleParams
) -> DataFrame:
    """Several high transfers within a window, from a device new to the sender.

    Candidates are stored, as they are read twice: for the windows and for their rows.
    """
    candidates = materialise(drain_candidates(enriched, seen_devices, p))
    return drain_alerts(candidates, drain_windows(candidates, p), p)


def suspects(marked: DataFrame, p: RuleParams) -> DataFrame:
    """Everything a rule on enriched rows could report: usually a small part of the traffic."""
    return marked.filter(
        (F.col("ratio") >= min(p.amount_ratio, p.drain_ratio))
        | _is_odd_hour(marked, p)
        | _is_new_state()
    )
