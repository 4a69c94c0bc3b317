"""All rules over a batch."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame

from txnguard.operators import alerts, profile, rules
from txnguard.schema import RuleParams
from txnguard.session import materialise


@dataclass(frozen=True)
class Suspects:
    """Suspicious transactions with their profile, and what senders were seen with."""

    rows: DataFrame
    seen_devices: DataFrame
    seen_states: DataFrame


def find_suspects(txns: DataFrame, history: DataFrame, p: RuleParams) -> Suspects:
    """All traffic joined with profile and known states; the small rest is written down.

    History is read twice: for what is spent, and for all values that senders were seen with.
    """
    known = materialise(profile.spend_profile(history))
    values = profile.stored_values(history, [profile.DEVICE, profile.STATE])
    states = profile.pairs_of(values, profile.STATE)
    enriched = profile.enrich(txns, known, p.spend_floor)
    marked = profile.with_new(enriched, states, profile.STATE, "new_state")
    rows = materialise(rules.suspects(marked, p))
    return Suspects(rows, profile.pairs_of(values, profile.DEVICE), states)


def detect(txns: DataFrame, history: DataFrame, p: RuleParams) -> DataFrame:
    """Alerts of all rules, one row per transaction and rule.

    Bursts need no profile and look at transactions, the other rules at suspects. The two
    sides store their intermediates at the same time, so that neither leaves cores idle.
    """
    with ThreadPoolExecutor(max_workers=1) as other_side:
        burst = other_side.submit(rules.rapid_fire, txns, p)
        others = suspect_alerts(find_suspects(txns, history, p), p)
        return alerts.union_alerts([*others, burst.result()])


def suspect_alerts(found: Suspects, p: RuleParams) -> list[DataFrame]:
    """Alerts of the four rules that hold a transaction against its sender's profile."""
    return [
        rules.unseen_device_drain(found.rows, found.seen_devices, p),
        rules.point_alerts(found.rows, p),
    ]


def detect_for_sender(
    txns: DataFrame, history: DataFrame, p: RuleParams, sender: str
) -> DataFrame:
    """Alerts of one sender. Rules never mix senders, so both inputs are cut down first."""
    return alerts.of_sender(
        detect(alerts_input(txns, sender), alerts_input(history, sender), p), sender
    )


def alerts_input(txns: DataFrame, sender: str) -> DataFrame:
    return txns.filter(txns["sender_upi"] == sender)
