"""What is known about a sender from history, and joins against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.functions.quantile import grouped_median
from txnguard.session import materialise

SENDER = "sender_upi"
DEVICE = "sender_device_id"
STATE = "sender_state"
PAYEE = "receiver_upi"


def history_before(txns: DataFrame, cutoff: str) -> DataFrame:
    """Settled transactions before the cutoff: later ones must not raise their own baseline."""
    return txns.filter((F.col("status") == "SUCCESS") & (F.col("timestamp") < _time(txns, cutoff)))


def since(txns: DataFrame, cutoff: str) -> DataFrame:
    return txns.filter(F.col("timestamp") >= _time(txns, cutoff))


def _time(df: DataFrame, text: str) -> Column:
    """A literal of the event time's own type, so that the comparison reaches the scan."""
    return F.lit(text).cast(df.schema["timestamp"].dataType)


def seen_pairs(history: DataFrame, attribute: str) -> DataFrame:
    """Distinct (sender, attribute)."""
    return history.select(SENDER, attribute).distinct()


def stored_pairs(history: DataFrame, attribute: str) -> DataFrame:
    """The distinct pairs as a table, ready to be joined with traffic.

    Joined straight from their aggregation they would be partitioned already, and then AQE
    leaves the other side's hot partitions whole: it splits only where both inputs of the
    join come out of a shuffle of its own. From a table they do, or are broadcast if the
    files are small.
    """
    return materialise(seen_pairs(history, attribute))


def unseen(txns: DataFrame, history: DataFrame, attribute: str) -> DataFrame:
    """Transactions whose attribute the sender has not shown before; all, without history."""
    return txns.join(stored_pairs(history, attribute), [SENDER, attribute], "left_anti")


def seen_before(txns: DataFrame, history: DataFrame, attribute: str) -> DataFrame:
    return txns.join(stored_pairs(history, attribute), [SENDER, attribute], "left_semi")


def with_new(txns: DataFrame, seen: DataFrame, attribute: str, name: str) -> DataFrame:
    """Adds whether the sender has not been seen with the attribute. ``seen`` are stored pairs."""
    marked = seen.withColumn("_seen", F.lit(True))
    joined = txns.join(marked, [SENDER, attribute], "left")
    return joined.withColumn(name, F.col("_seen").isNull()).drop("_seen")


def sender_values(history: DataFrame, attributes: list[str]) -> DataFrame:
    """(sender, kind, value, n): every value a sender was seen with, one per row, and how often.

    All attributes share one pass, and repeats vanish before the shuffle.
    """
    named = [F.struct(F.lit(a).alias("kind"), F.col(a).alias("value")) for a in attributes]
    return (
        history.select(SENDER, F.explode(F.array(*named)).alias("item"))
        .groupBy(SENDER, F.col("item.kind").alias("kind"), F.col("item.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def stored_values(history: DataFrame, attributes: list[str]) -> DataFrame:
    """``sender_values`` as a table: one pass over history for all attributes."""
    return materialise(sender_values(history, attributes))


def pairs_of(values: DataFrame, attribute: str) -> DataFrame:
    """The distinct (sender, attribute) in ``sender_values``; nulls are left out."""
    return values.filter((F.col("kind") == attribute) & F.col("value").isNotNull()).select(
        SENDER, F.col("value").alias(attribute)
    )


_SIZE_NAMES = {DEVICE: "n_devices", STATE: "n_states", PAYEE: "n_payees"}
_LIST_NAMES = {DEVICE: "devices", STATE: "states"}


def _sizes() -> list[Column]:
    def of(attribute: str) -> Column:
        return F.when((F.col("kind") == attribute) & F.col("value").isNotNull(), F.col("n"))

    total = F.sum(F.when(F.col("kind") == DEVICE, F.col("n"))).alias("n_txns")
    return [total, *[F.count(of(a)).alias(name) for a, name in _SIZE_NAMES.items()]]


def value_counts(values: DataFrame) -> DataFrame:
    """Per sender: transactions, and how many different devices, states and payees."""
    return values.groupBy(SENDER).agg(*_sizes())


def value_pieces(values: DataFrame) -> DataFrame:
    """Per sender and range of values: ``value_counts``, and the devices and states in order, joined by commas.

    Values are laid out by range, so a sender with very many is spread: what one task sorts is a range, or
    several that AQE merged up to its advisory size.
    """
    laid = values.repartitionByRange(SENDER, "kind", "value").withColumn("_part", F.spark_partition_id())
    joined = "listagg(value, ',') WITHIN GROUP (ORDER BY value) FILTER (WHERE kind = '{}')"
    lists = [F.expr(joined.format(a)).alias(name) for a, name in _LIST_NAMES.items()]
    return laid.groupBy(SENDER, "_part").agg(*_sizes(), *lists)


def value_lists(values: DataFrame) -> DataFrame:
    """``value_counts`` with all devices and states of a sender, in order; empty, where all are null.

    One text per range is put behind the next, for a sender in one task: it holds these texts and the result,
    which has to fit into one value, 2 GB at most. The same values as rows are ``sender_values``.
    """
    sizes = [F.sum(name).alias(name) for name in ("n_txns", *_SIZE_NAMES.values())]
    joined = "coalesce(listagg({0}, ',') WITHIN GROUP (ORDER BY _part), '')"
    lists = [F.expr(joined.format(name)).alias(name) for name in _LIST_NAMES.values()]
    return value_pieces(values).groupBy(SENDER).agg(*sizes, *lists)


def sender_profile(history: DataFrame) -> DataFrame:
    """One row per sender: typical spend, how many transactions, devices, states and payees, and which
    devices and states."""
    values = sender_values(history, list(_SIZE_NAMES))
    return spend_profile(history).join(value_lists(values), SENDER)


def spend_profile(history: DataFrame) -> DataFrame:
    """Typical spend only: what the rules look at, beside the distinct pairs.

    Store it before joining it with traffic, as for ``stored_pairs``.
    """
    return grouped_median(history, SENDER, "amount", "typical_spend")


def enrich(txns: DataFrame, profile: DataFrame, spend_floor: float) -> DataFrame:
    """Adds the profile and ``ratio``, the amount in units of the sender's typical spend.

    A plain left join with a stored profile: the planner broadcasts it while its files are
    small and shuffles by sender beyond, where AQE splits the partition of a hot sender.
    """
    base = F.greatest(F.col("typical_spend"), F.lit(spend_floor))
    return txns.join(profile, SENDER, "left").withColumn(
        "ratio", F.when(F.col("typical_spend").isNotNull(), F.col("amount") / base)
    )
