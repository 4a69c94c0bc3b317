"""Transactions derived from an activity log (``events``), row by row.

Gives every transaction field a value that is plain arithmetic on the log's columns, so
the jobs can be run and checked on such a log. Column by column as in ``FIXTURES.md``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.schema import TXN_FIELDS

# The states, bank handles and merchant categories of the event contract.
INDIAN_STATES = [
    "Maharashtra", "Karnataka", "Delhi", "Tamil Nadu", "West Bengal",
    "Gujarat", "Uttar Pradesh", "Telangana", "Rajasthan", "Kerala",
    "Punjab", "Haryana", "Madhya Pradesh", "Bihar", "Odisha",
]
BANK_HANDLES = ["oksbi", "okhdfcbank", "okicici", "okaxis", "ybl", "paytm", "okbizaxis"]
MERCHANT_CATEGORIES = [
    "grocery", "food_delivery", "fuel", "travel", "entertainment",
    "utilities", "ecommerce", "healthcare", "education", "electronics",
    "fashion", "pharmacy",
]

# Payees are a fixed circle of users, whatever the log's size: a rule of the fixture.
PAYEES = 150
MERCHANTS = 80
STRANGERS = 1000


def _pick(values: list[str], index: str) -> str:
    options = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({options}), CAST(({index}) % {len(values)} AS INT) + 1)"


def _padded(number: str, width: int) -> str:
    """At least ``width`` digits; a longer number stays whole."""
    digits = f"CAST({number} AS STRING)"
    return f"lpad({digits}, greatest({width}, length({digits})), '0')"


def _address(prefix: str, number: str, width: int, bank: str) -> str:
    return f"concat('{prefix}', {_padded(number, width)}, '@', {_pick(BANK_HANDLES, bank)})"


_NUMBER = "CAST(get_json_object(props, '$.k') AS INT)"
_PAYEE = f"((user_id + 1 + k) % {PAYEES})"
_USER = _padded("user_id", 4)
_COLUMNS = {
    "kafka_timestamp": "timestampadd(SECOND, if(k = 95, -10800, CAST(event_id % 7 AS INT)), ts)",
    "txn_id": f"concat('txn-', {_padded('event_id', 8)})",
    "sender_upi": _address("user", "user_id", 4, "user_id"),
    "sender_state": _pick(INDIAN_STATES, "(user_id + if(k = 96, 1, 0))"),
    "sender_device_id": f"if(k >= 97, concat('dev', {_USER}, '_', floor(day(ts) / 8.0)), "
    f"concat('user', {_USER}, '_', k % (1 + user_id % 3)))",
    "receiver_upi": f"CASE WHEN k % 5 < 3 THEN "
    f"{_address('merchant', f'event_id % {MERCHANTS}', 3, 'event_id')} "
    f"WHEN k >= 90 THEN {_address('stranger', f'event_id % {STRANGERS}', 4, 'event_id')} "
    f"ELSE {_address('user', _PAYEE, 4, _PAYEE)} END",
    "receiver_type": "if(k % 5 < 3, 'P2M', 'P2P')",
    "receiver_category": f"if(k % 5 < 3, {_pick(MERCHANT_CATEGORIES, 'event_id')}, NULL)",
    "status": "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'REVERSED' "
    "ELSE 'SUCCESS' END",
    "is_fraud": "CAST(NULL AS BOOLEAN)",
    "fraud_pattern": "CAST(NULL AS STRING)",
}


# Fields that are the log's own columns; filters on them reach the scan.
_TAKEN_OVER = {"timestamp": "ts", "amount": "value"}


def transactions_from_events(events: DataFrame) -> DataFrame:
    """``kafka_timestamp`` and the twelve transaction fields, labels null.

    Derived fields come out of one-row generators. As projections they would be merged
    into every filter that looks at them, and computed anew each time.
    """
    numbered = events.selectExpr("*", f"explode(array({_NUMBER})) AS k")
    derived = ", ".join(f"'{name}', {sql}" for name, sql in _COLUMNS.items())
    kept = [f"{column} AS {name}" for name, column in _TAKEN_OVER.items()]
    rows = numbered.selectExpr(*kept, f"inline(array(named_struct({derived})))")
    return rows.select("kafka_timestamp", *TXN_FIELDS)


def rows_of_txn(events: DataFrame, txn_id: str) -> DataFrame:
    """The rows of the log that can have the id. The id is a number of the log's own in fixed form, so the
    look-up reaches the scan as a filter on that, and skips files and row groups."""
    number = re.fullmatch(r"txn-(\d{8,})", txn_id)
    return events.filter(F.col("event_id") == int(number[1])) if number else events.limit(0)


def rows_of_sender(events: DataFrame, sender: str) -> DataFrame:
    """The same for the address of a sender."""
    number = re.fullmatch(r"user(\d{4,})@([a-z]+)", sender)
    if not number or BANK_HANDLES[int(number[1]) % len(BANK_HANDLES)] != number[2]:
        return events.limit(0)
    return events.filter(F.col("user_id") == int(number[1]))


def _id_ends(suffix: str) -> Column:
    return F.col("txn_id").endswith(suffix)


def with_defects(txns: DataFrame) -> DataFrame:
    """Breaks the contract in some rows: amount, sender address, state, category."""
    return txns.withColumns(
        {
            "amount": F.when(_id_ends("07"), -F.col("amount")).otherwise(F.col("amount")),
            "sender_upi": F.when(
                _id_ends("08"), F.replace("sender_upi", F.lit("@"), F.lit(""))
            ).otherwise(F.col("sender_upi")),
            "sender_state": F.when(_id_ends("09"), "").otherwise(F.col("sender_state")),
            "receiver_category": F.when(~_id_ends("4"), F.col("receiver_category")),
        }
    )


def with_repeats(txns: DataFrame) -> DataFrame:
    """Some rows twice, as a producer that retries would send them."""
    return txns.unionByName(txns.filter(_id_ends("50")))


def with_labels(txns: DataFrame) -> DataFrame:
    """Labels for the two shapes the derivation plants: swapped device, moved state."""
    swapped = F.col("sender_device_id").startswith("dev")
    home = F.expr(_pick(INDIAN_STATES, "CAST(regexp_extract(sender_upi, '^user([0-9]+)@', 1) AS BIGINT)"))
    moved = F.col("sender_state") != home
    pattern = F.when(swapped, "unseen_device_drain").when(moved, "location_anomaly")
    return txns.withColumns({"is_fraud": pattern.isNotNull(), "fraud_pattern": pattern}).select(
        "kafka_timestamp", *TXN_FIELDS
    )
