"""Alert frames: union, one per transaction, removal, and the dashboard's queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnguard.schema import REASON_PRIORITY


def union_alerts(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def reason_rank() -> Column:
    ranks = F.array(*[F.lit(r) for r in REASON_PRIORITY])
    return F.array_position(ranks, F.col("fraud_reason"))


def one_per_txn(alerts: DataFrame) -> DataFrame:
    """The strongest reason per transaction, of that the earliest window; of several evaluations of a
    window the one with most rows.

    Only the first row of a rank is asked for, so each map task sends one per transaction.
    """
    most = F.col("txn_count").desc()
    order = W.partitionBy("txn_id").orderBy(reason_rank(), "window_start", "window_end", most)
    return alerts.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def not_in(alerts: DataFrame, stored: DataFrame) -> DataFrame:
    """Alerts for transactions the store does not hold yet."""
    return alerts.join(stored.select("txn_id"), "txn_id", "left_anti")


def retract(alerts: DataFrame, keys: DataFrame) -> DataFrame:
    """All alerts but those of the given transactions. Keys may repeat: joined as they are, a hot one is split."""
    return alerts.join(keys.select("txn_id"), "txn_id", "left_anti")


def latest(alerts: DataFrame, n: int) -> DataFrame:
    return alerts.orderBy(F.col("txn_timestamp").desc(), "txn_id").limit(n)


def of_sender(alerts: DataFrame, sender: str) -> DataFrame:
    return alerts.filter(F.col("sender_upi") == sender).orderBy(
        F.col("txn_timestamp").desc(), "txn_id"
    )


def by_reason_and_hour(alerts: DataFrame) -> DataFrame:
    hour = F.window("txn_timestamp", "1 hour")["start"].alias("hour_start")
    return alerts.groupBy("fraud_reason", hour).agg(
        F.count(F.lit(1)).alias("n_alerts"), F.sum("amount").alias("alert_amount")
    )


def rule_quality(alerts: DataFrame, labelled: DataFrame) -> DataFrame:
    """Per pattern: labelled, alerted, both; recall and precision (null without a basis)."""
    truth = labelled.filter("is_fraud").select(
        F.col("txn_id").alias("label_id"), F.col("fraud_pattern").alias("pattern")
    )
    found = alerts.select("txn_id", F.col("fraud_reason").alias("reason")).distinct()
    same = (F.col("label_id") == F.col("txn_id")) & (F.col("pattern") == F.col("reason"))
    n_both = F.count_if(F.col("label_id").isNotNull() & F.col("txn_id").isNotNull())
    return (
        truth.join(found, same, "full")
        .groupBy(F.coalesce("pattern", "reason").alias("fraud_pattern"))
        .agg(
            F.count("label_id").alias("n_labelled"),
            F.count("txn_id").alias("n_alerted"),
            n_both.alias("n_both"),
        )
        .withColumns(
            {
                "recall": F.try_divide(F.col("n_both"), F.col("n_labelled")),
                "precision": F.try_divide(F.col("n_both"), F.col("n_alerted")),
            }
        )
    )
