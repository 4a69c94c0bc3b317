"""Small hand-made transactions at the rules' default thresholds."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from txnguard.schema import BRONZE_SCHEMA, TXN_FIELDS

IST = timezone(timedelta(hours=5, minutes=30))
NOON = datetime(2026, 8, 2, 12, 4, 40, tzinfo=IST)

BASE = {
    "txn_id": "3f0c1a52-77d1-4c0e-9b6e-0d5b8a4e6c11",
    "timestamp": NOON + timedelta(milliseconds=3250),
    "sender_upi": "user0731@oksbi",
    "sender_state": "Odisha",
    "sender_device_id": "user0731_0",
    "receiver_upi": "user0226@paytm",
    "receiver_type": "P2P",
    "receiver_category": None,
    "amount": 777.5,
    "status": "SUCCESS",
    "is_fraud": False,
    "fraud_pattern": None,
}


def txn(**changes) -> dict:
    return {**BASE, **changes}


def burst(n, start=NOON, step=4, payees=None, prefix="b", **changes) -> list[dict]:
    return [
        txn(
            txn_id=f"{prefix}{i}",
            timestamp=start + timedelta(seconds=i * step),
            receiver_upi=f"stranger{i % (payees or n):04d}@ybl",
            **{"amount": 100.0, **changes},
        )
        for i in range(n)
    ]


def history(sender="user0731@oksbi", spend=100.0, n=5, **changes) -> list[dict]:
    start = datetime(2026, 7, 1, tzinfo=IST)
    return [
        txn(
            txn_id=f"h-{sender}-{i}", timestamp=start + timedelta(days=i),
            sender_upi=sender, amount=spend, **changes,
        )
        for i in range(n)
    ]


def frame(spark, rows):
    """With the arrival a second after the event, unless given."""
    data = [
        (r.get("kafka_timestamp", r["timestamp"] + timedelta(seconds=1)),
         *[r[f] for f in TXN_FIELDS])
        for r in rows
    ]
    return spark.createDataFrame(data, BRONZE_SCHEMA)
