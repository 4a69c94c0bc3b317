"""Topic to bronze, bronze to silver and quarantine: three queries, each with its checkpoint.

Bronze holds every message, parsed, with the list of its contract violations, so that the
later queries filter stored columns and never parse text again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from txnguard.operators import contract, parsing, reports
from txnguard.schema import BRONZE_SCHEMA, INGESTED_AT

EVENT_DATE = "event_date"
BRONZE_TABLE_SCHEMA = T.StructType(
    [
        *BRONZE_SCHEMA.fields,
        T.StructField("violations", T.ArrayType(T.StringType())),
        T.StructField("unknown_fields", T.ArrayType(T.StringType())),
        T.StructField("raw_key", T.StringType()),
        T.StructField("raw_value", T.StringType()),
        T.StructField("arrival_date", T.DateType()),
    ]
)
SILVER_SCHEMA = T.StructType(
    [
        *BRONZE_SCHEMA.fields,
        T.StructField(INGESTED_AT, T.TimestampType()),
        T.StructField(EVENT_DATE, T.DateType()),
    ]
)


def bronze_rows(messages: DataFrame) -> DataFrame:
    """Messages as typed rows with their violations; batch or stream.

    What breaks the contract keeps key and text as sent, to be looked at or sent again. So does what has
    fields that the schema lacks: it is accepted, and once the schema has them they can be read from here.
    """
    parsed = parsing.with_raw_violations(parsing.parse(parsing.decode(messages)))
    checked = contract.with_violations(parsing.flatten(parsed, keep=("message_key", "json")))
    checked = checked.withColumn("unknown_fields", parsing.unknown_fields())
    odd = (F.size("violations") > 0) | (F.size("unknown_fields") > 0)
    return checked.select(
        *BRONZE_SCHEMA.fieldNames(),
        "violations",
        "unknown_fields",
        F.when(odd, F.col("message_key")).alias("raw_key"),
        F.when(odd, F.col("json")).alias("raw_value"),
        F.to_date("kafka_timestamp").alias("arrival_date"),
    )


def silver_rows(bronze: DataFrame) -> DataFrame:
    kept = contract.accepted(bronze).drop("arrival_date", "unknown_fields", "raw_key", "raw_value")
    return kept.withColumn(EVENT_DATE, F.to_date("timestamp"))


def without_repeats(silver_stream: DataFrame, within: str = "7 days") -> DataFrame:
    """Drops a message that a producer sent again, and nothing else. Adds ``ingested_at``.

    Known ids are kept in state for so long after they came in. The watermark goes by the time of the
    micro-batch, which is the same for all of its rows and never goes back: so no row can be behind it,
    however long its topic partition has lagged, and ids still leave the state in the end.
    """
    timed = silver_stream.withColumn(INGESTED_AT, F.current_timestamp()).withWatermark(INGESTED_AT, within)
    return timed.dropDuplicatesWithinWatermark(["txn_id"])


def missing_in_silver(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Batch: valid rows of bronze whose id silver lacks, one per id, the first to arrive.

    To be empty, once the silver query has caught up; a check, and the repair after a loss of files.
    Cut both tables to the days in question first.
    """
    late = silver_rows(bronze).join(silver.select("txn_id"), "txn_id", "left_anti")
    first = reports.first_of_each_id(late).withColumn(INGESTED_AT, F.current_timestamp())
    return first.select(SILVER_SCHEMA.fieldNames())


def append(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    name: str | None = None,
) -> DataStreamWriter:
    """An exactly-once append to a table; the checkpoint is where a restart picks up."""
    writer = (
        rows.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if name:
        writer = writer.queryName(name)
    return writer


def bronze_writer(messages: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"):
    return append(bronze_rows(messages), path, checkpoint, fmt, "arrival_date", "bronze")


def silver_writer(bronze_stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"):
    rows = without_repeats(silver_rows(bronze_stream)).select(SILVER_SCHEMA.fieldNames())
    return append(rows, path, checkpoint, fmt, EVENT_DATE, "silver")


def quarantine_writer(bronze_stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"):
    rows = contract.quarantined(bronze_stream)
    return append(rows, path, checkpoint, fmt, "arrival_date", "quarantine")
