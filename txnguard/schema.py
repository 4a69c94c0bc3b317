"""Record layouts, fixed values and rule parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Names and order of the transaction fields as they travel on the topic.
TXN_SCHEMA = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("sender_upi", T.StringType()),
        T.StructField("sender_state", T.StringType()),
        T.StructField("sender_device_id", T.StringType()),
        T.StructField("receiver_upi", T.StringType()),
        T.StructField("receiver_type", T.StringType()),
        T.StructField("receiver_category", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("is_fraud", T.BooleanType()),
        T.StructField("fraud_pattern", T.StringType()),
    ]
)
TXN_FIELDS = TXN_SCHEMA.fieldNames()

# Everything but the category and the two label fields has to carry text.
REQUIRED_TEXT = [
    "txn_id",
    "sender_upi",
    "sender_state",
    "sender_device_id",
    "receiver_upi",
    "receiver_type",
    "status",
]

# Bronze keeps the ingestion time of the topic in front of the payload.
BRONZE_SCHEMA = T.StructType(
    [T.StructField("kafka_timestamp", T.TimestampType()), *TXN_SCHEMA.fields]
)

# When a row got into silver: the same for all rows of a micro-batch, later for later ones.
INGESTED_AT = "ingested_at"

# Names of the alert columns and of the reasons. Numbers are wide enough for any valid
# transaction; the database sink narrows them.
ALERT_SCHEMA = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("sender_upi", T.StringType()),
        T.StructField("receiver_upi", T.StringType()),
        T.StructField("amount", T.DecimalType(28, 2)),
        T.StructField("txn_timestamp", T.TimestampType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("fraud_reason", T.StringType()),
        T.StructField("txn_count", T.LongType()),
        T.StructField("total_amount", T.DecimalType(38, 2)),
    ]
)
ALERT_FIELDS = ALERT_SCHEMA.fieldNames()

RAPID_FIRE = "rapid_fire_burst"
ODD_HOUR = "odd_hour_high_value"
AMOUNT = "amount_anomaly"
DEVICE_DRAIN = "unseen_device_drain"
LOCATION = "location_anomaly"

# Which reason is kept when a transaction is hit more than once, strongest first.
REASON_PRIORITY = [DEVICE_DRAIN, RAPID_FIRE, AMOUNT, ODD_HOUR, LOCATION]


@dataclass(frozen=True)
class RuleParams:
    """Thresholds of the five rules. The defaults bracket the known fraud shapes."""

    spend_floor: float = 10.0

    burst_seconds: int = 60
    burst_slide_seconds: int = 10
    burst_min_txns: int = 6
    burst_min_payees: int = 6
    burst_max_amount: float | None = 500.0

    odd_hour_first: int = 1
    odd_hour_last: int = 4
    odd_hour_ratio: float = 8.0

    amount_ratio: float = 20.0

    drain_ratio: float = 5.0
    drain_seconds: int = 60
    drain_slide_seconds: int = 10
    drain_min_txns: int = 3

    def __post_init__(self) -> None:
        for length, slide in (
            (self.burst_seconds, self.burst_slide_seconds),
            (self.drain_seconds, self.drain_slide_seconds),
        ):
            if slide <= 0 or length % slide:
                raise ValueError("a window must be a whole number of slides long")
