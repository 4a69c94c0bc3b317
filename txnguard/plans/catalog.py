"""The registered queries: every operator over the given tables.

Each takes (session, folder of tables). Transactions are derived from ``events``; raw text
from ``customer``. The thresholds are lower than the rules' defaults, as the log has at most
two rows of one user in a minute.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.functions import text
from txnguard.functions.time import iso_ist, iso_utc_seconds, utc_wall_clock
from txnguard.operators import alerts, contract, parsing, profile, reports, rules
from txnguard.plans.detection import Suspects, detect, detect_for_sender, find_suspects
from txnguard.schema import AMOUNT, RuleParams
from txnguard.session import materialise
from txnguard.sources import events
from txnguard.sources.tables import read_table
from txnguard.sources.topics import message_frame

HOUR, DAY = 3600, 86400
CUTOFF = "2024-01-16 00:00:00"
LOG_PARAMS = RuleParams(
    burst_seconds=6 * HOUR,
    burst_slide_seconds=HOUR,
    burst_min_txns=2,
    burst_min_payees=2,
    burst_max_amount=200.0,
    odd_hour_ratio=3.0,
    amount_ratio=5.0,
    drain_ratio=0.5,
    drain_seconds=7 * DAY,
    drain_slide_seconds=7 * DAY,
    drain_min_txns=2,
)
SLIDING_PARAMS = replace(LOG_PARAMS, drain_ratio=0.05, drain_slide_seconds=DAY)
SENDER = "user0008@okhdfcbank"
LOOKUP_ID = "txn-00000123"
FEED_ROWS = 50
TOPIC_PARTITIONS = 12
PARTITION_BYTES_PER_SECOND = 10.0
SKEW_SECONDS = 60
VELOCITY_SECONDS = 6 * HOUR

Query = Callable[[SparkSession, str], DataFrame]


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return events.transactions_from_events(read_table(spark, f"{folder}/events.parquet"))


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return contract.keep_valid(transactions(spark, folder))


def history(spark: SparkSession, folder: str) -> DataFrame:
    return profile.history_before(silver(spark, folder), CUTOFF)


def current(spark: SparkSession, folder: str) -> DataFrame:
    return profile.since(silver(spark, folder), CUTOFF)


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions as a topic would hand them over."""
    return message_frame(transactions(spark, folder), arrival="kafka_timestamp")


def broken_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of which some have a naive time, coerced types or cut-off text."""
    txns = transactions(spark, folder)
    value = F.col("value")
    spoiled = (
        F.when(F.col("end") == "05", F.replace(value, F.lit('+05:30"'), F.lit('"')))
        .when(F.col("end") == "06", F.regexp_replace(value, '"amount":([^,]+)', '"amount":"$1"'))
        .when(F.col("end") == "11", F.regexp_replace(value, '"txn-(\\d+)"', "11"))
        .when(F.col("end") == "12", F.rtrim(value, F.lit("}")))
        .when(F.col("end") == "13", F.replace(value, F.lit('"is_fraud":null'), F.lit('"is_fraud":"no"')))
        .otherwise(value)
    )
    id_end = F.substring(F.get_json_object("value", "$.txn_id"), -2, 2)
    return (
        message_frame(txns, arrival="kafka_timestamp")
        .withColumn("end", id_end)
        .select("key", spoiled.alias("value"), "timestamp")
    )


# ---- ingest and contract


def bronze_txn(spark: SparkSession, folder: str) -> DataFrame:
    return transactions(spark, folder)


def bronze_count(spark: SparkSession, folder: str) -> DataFrame:
    return reports.row_count(transactions(spark, folder))


def publish_frame(spark: SparkSession, folder: str) -> DataFrame:
    return message_frame(transactions(spark, folder))


def parse_flatten(spark: SparkSession, folder: str) -> DataFrame:
    flat = parsing.flatten(parsing.parse(parsing.decode(messages(spark, folder))))
    return flat.withColumn("timestamp", utc_wall_clock(flat, "timestamp"))


def json_contract(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parsing.parse(parsing.decode(broken_messages(spark, folder)))
    flat = parsing.flatten(parsing.with_raw_violations(parsed))
    return contract.violation_counts(contract.with_violations(flat))


def unknown_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Messages by the fields that the schema lacks, of producers that send more than was agreed on."""
    txns = transactions(spark, folder)
    value = F.col("value")
    id_end = F.substring(F.get_json_object("value", "$.txn_id"), -1, 1)
    sent = (
        F.when(id_end == "3", F.regexp_replace(value, r"^\{", '{"channel":"app",'))
        .when(id_end == "7", F.regexp_replace(value, r"^\{", '{"note":{"status":"x"},"channel":null,'))
        .otherwise(value)
    )
    seen = parsing.decode(message_frame(txns, arrival="kafka_timestamp").withColumn("value", sent))
    names = F.explode(parsing.unknown_fields()).alias("field")
    return seen.select(names).groupBy("field").agg(F.count(F.lit(1)).alias("n_rows"))


def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    dirty = events.with_defects(transactions(spark, folder))
    return contract.violation_counts(contract.with_violations(dirty))


def contract_split(spark: SparkSession, folder: str) -> DataFrame:
    checked = contract.with_violations(events.with_defects(transactions(spark, folder)))
    reasons = F.array_join("violations", ",").alias("reasons")
    return checked.select("txn_id", "sender_upi", "amount", reasons)


def txn_lookup(spark: SparkSession, folder: str) -> DataFrame:
    log = events.rows_of_txn(read_table(spark, f"{folder}/events.parquet"), LOOKUP_ID)
    found = reports.lookup(events.transactions_from_events(log), LOOKUP_ID)
    return found.select("txn_id", "sender_upi", "receiver_upi", "amount", "status")


def dup_txn(spark: SparkSession, folder: str) -> DataFrame:
    return reports.repeated_ids(events.with_repeats(transactions(spark, folder)))


def txn_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return reports.first_of_each_id(events.with_repeats(transactions(spark, folder)))


def skew_guard(spark: SparkSession, folder: str) -> DataFrame:
    return reports.within_skew(transactions(spark, folder), SKEW_SECONDS)


def iso_time(spark: SparkSession, folder: str) -> DataFrame:
    txns = transactions(spark, folder)
    return txns.select(
        "txn_id",
        iso_ist(txns, "timestamp").alias("iso_ist"),
        iso_utc_seconds(txns, "timestamp").alias("iso_utc"),
    )


def text_normalize(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, f"{folder}/customer.parquet")
    key = F.col("c_custkey")
    grouped = F.when(key % 5 == 4, "n/a").otherwise(
        F.concat(
            F.lit("  "),
            F.floor(key / 1000).cast("string"),
            F.lit(","),
            F.lpad((key % 1000).cast("string"), 3, "0"),
            F.lit(" "),
        )
    )
    name = F.concat(
        F.lit(" \t"), F.replace("c_name", F.lit("#"), F.lit(" o'neil-")), F.lit("x "), "c_mktsegment"
    )
    dot = F.when(key % 4 == 0, "").otherwise(".")
    at = F.when(key % 4 == 1, "").otherwise("@")
    email = F.concat(F.lit(" "), "c_name", at, "c_mktsegment", dot, F.lit("Com "))
    record = (
        F.when(key % 3 == 0, F.concat(F.lit('{"transaction_id":"'), grouped, F.lit('"}')))
        .when(
            key % 3 == 1,
            F.concat(F.lit('{"txn_id":"'), grouped, F.lit('","transaction_id":"x"}')),
        )
        .otherwise(F.concat(F.lit('{"txn_id":"'), grouped, F.lit('"}')))
    )
    raw_id = text.id_from_json(record)
    return customer.select(
        "c_custkey",
        raw_id.alias("raw_id"),
        text.parse_grouped_int(raw_id).alias("id"),
        text.clean_name(name).alias("name"),
        text.email_is_valid(email).alias("email_ok"),
        text.clean_email(email).alias("email"),
    )


# ---- profile and joins


def sender_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.sender_profile(history(spark, folder))


def sender_values(spark: SparkSession, folder: str) -> DataFrame:
    return profile.sender_values(history(spark, folder), [profile.DEVICE, profile.STATE, profile.PAYEE])


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    known = materialise(profile.spend_profile(history(spark, folder)))
    return profile.enrich(current(spark, folder), known, LOG_PARAMS.spend_floor)


def txn_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return _enriched(spark, folder).select(
        "txn_id", "sender_upi", F.round("amount", 2).alias("amount"), "typical_spend", "ratio"
    )


_PAIR_COLUMNS = ["txn_id", "sender_upi", "sender_device_id", "receiver_upi", "timestamp"]


def unseen_device_txn(spark: SparkSession, folder: str) -> DataFrame:
    now, past = current(spark, folder), history(spark, folder)
    return profile.unseen(now, past, profile.DEVICE).select(_PAIR_COLUMNS)


def known_device_txn(spark: SparkSession, folder: str) -> DataFrame:
    now, past = current(spark, folder), history(spark, folder)
    return profile.seen_before(now, past, profile.DEVICE).select(_PAIR_COLUMNS)


def new_payee_txn(spark: SparkSession, folder: str) -> DataFrame:
    now, past = current(spark, folder), history(spark, folder)
    return profile.unseen(now, past, profile.PAYEE).select(_PAIR_COLUMNS)


# ---- rules and alerts


def rule_amount_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    return rules.amount_anomaly(_enriched(spark, folder), LOG_PARAMS)


def rule_odd_hour(spark: SparkSession, folder: str) -> DataFrame:
    return rules.odd_hour(_enriched(spark, folder), LOG_PARAMS)


def _suspects(spark: SparkSession, folder: str) -> Suspects:
    return find_suspects(current(spark, folder), history(spark, folder), LOG_PARAMS)


def rule_location(spark: SparkSession, folder: str) -> DataFrame:
    found = _suspects(spark, folder)
    return rules.location(found.rows, found.seen_states)


def rule_rapid_fire(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rapid_fire(current(spark, folder), LOG_PARAMS)


def rule_unseen_device(spark: SparkSession, folder: str) -> DataFrame:
    found = _suspects(spark, folder)
    return rules.unseen_device_drain(found.rows, found.seen_devices, LOG_PARAMS)


def rule_unseen_device_sliding(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping windows and lower thresholds: each transfer lies in several windows."""
    found = find_suspects(current(spark, folder), history(spark, folder), SLIDING_PARAMS)
    return rules.unseen_device_drain(found.rows, found.seen_devices, SLIDING_PARAMS)


def alerts_all(spark: SparkSession, folder: str) -> DataFrame:
    return detect(current(spark, folder), history(spark, folder), LOG_PARAMS)


def alerts_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.one_per_txn(alerts_all(spark, folder))


def alerts_new(spark: SparkSession, folder: str) -> DataFrame:
    """What is left to store where another run has stored the alerts on amounts."""
    every = materialise(alerts_all(spark, folder))
    stored = every.filter(F.col("fraud_reason") == AMOUNT)
    return alerts.not_in(alerts.one_per_txn(every), stored)


def alerts_retract(spark: SparkSession, folder: str) -> DataFrame:
    reversed_txns = current(spark, folder).filter(F.col("status") == "REVERSED")
    return alerts.retract(alerts_all(spark, folder), reversed_txns)


def alert_feed(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.latest(alerts_dedup(spark, folder), FEED_ROWS)


def alerts_by_sender(spark: SparkSession, folder: str) -> DataFrame:
    log = events.rows_of_sender(read_table(spark, f"{folder}/events.parquet"), SENDER)
    txns = contract.keep_valid(events.transactions_from_events(log))
    past, now = profile.history_before(txns, CUTOFF), profile.since(txns, CUTOFF)
    return detect_for_sender(now, past, LOG_PARAMS, SENDER)


def alerts_by_reason(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.by_reason_and_hour(alerts_dedup(spark, folder))


def rule_quality(spark: SparkSession, folder: str) -> DataFrame:
    labelled = events.with_labels(current(spark, folder))
    return alerts.rule_quality(alerts_all(spark, folder), labelled)


# ---- reports


def sender_window_stats(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sender_window_stats(silver(spark, folder), 12 * HOUR, 4 * HOUR)


def sender_velocity(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sender_velocity(silver(spark, folder), VELOCITY_SECONDS)


def traffic_mix(spark: SparkSession, folder: str) -> DataFrame:
    return reports.traffic_mix(silver(spark, folder))


def traffic_by_status(spark: SparkSession, folder: str) -> DataFrame:
    return reports.traffic_by(silver(spark, folder), "status")


def traffic_by_state(spark: SparkSession, folder: str) -> DataFrame:
    return reports.traffic_by(silver(spark, folder), "sender_state")


def key_skew(spark: SparkSession, folder: str) -> DataFrame:
    return reports.key_skew(transactions(spark, folder), TOPIC_PARTITIONS)


def ingest_rate(spark: SparkSession, folder: str) -> DataFrame:
    return reports.ingest_rate(messages(spark, folder), PARTITION_BYTES_PER_SECOND)


def ingest_peak(spark: SparkSession, folder: str) -> DataFrame:
    return reports.ingest_peak(ingest_rate(spark, folder))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        bronze_txn,
        bronze_count,
        publish_frame,
        parse_flatten,
        json_contract,
        unknown_fields,
        contract_violations,
        contract_split,
        txn_lookup,
        dup_txn,
        txn_dedup,
        skew_guard,
        iso_time,
        text_normalize,
        sender_profile,
        sender_values,
        txn_enriched,
        unseen_device_txn,
        known_device_txn,
        new_payee_txn,
        rule_amount_anomaly,
        rule_odd_hour,
        rule_location,
        rule_rapid_fire,
        rule_unseen_device,
        rule_unseen_device_sliding,
        alerts_all,
        alerts_dedup,
        alerts_new,
        alerts_retract,
        alert_feed,
        alerts_by_sender,
        alerts_by_reason,
        rule_quality,
        sender_window_stats,
        sender_velocity,
        traffic_mix,
        traffic_by_status,
        traffic_by_state,
        key_skew,
        ingest_rate,
        ingest_peak,
    )
}
