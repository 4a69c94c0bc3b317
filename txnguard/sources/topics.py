"""The message topic, as a batch, as a stream, and as a target.

Needs the ``spark-sql-kafka`` package of the running Spark version on the class path.
Frames have the source's columns, of which ``key``, ``value`` and ``timestamp`` are used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from txnguard.functions.time import iso_ist
from txnguard.schema import TXN_FIELDS


@dataclass(frozen=True)
class Topic:
    servers: str
    name: str
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def read_options(self, streaming: bool) -> dict[str, str]:
        """``min_partitions`` splits hot topic partitions over several tasks."""
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.name,
            "startingOffsets": self.starting_offsets,
        }
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        if streaming and self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return {**options, **self.extra}

    def write_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "topic": self.name,
            "kafka.enable.idempotence": "true",
            **self.extra,
        }


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    return spark.read.format("kafka").options(**topic.read_options(streaming=False)).load()


def stream_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    return spark.readStream.format("kafka").options(**topic.read_options(streaming=True)).load()


def message_frame(txns: DataFrame, arrival: str | None = None) -> DataFrame:
    """``(key, value)``: keyed by sender, the value a JSON object with all fields, nulls too.

    With ``arrival``, that column is kept as the topic's ``timestamp``.
    """
    fields = [
        iso_ist(txns, name).alias(name) if name == "timestamp" else F.col(name)
        for name in TXN_FIELDS
    ]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    kept = [F.col(arrival).alias("timestamp")] if arrival else []
    return txns.select(F.col("sender_upi").alias("key"), value.alias("value"), *kept)


def publish(txns: DataFrame, topic: Topic) -> None:
    message_frame(txns).write.format("kafka").options(**topic.write_options()).save()


def publish_stream(txns: DataFrame, topic: Topic, checkpoint: str) -> DataStreamWriter:
    return (
        message_frame(txns)
        .writeStream.format("kafka")
        .options(**topic.write_options())
        .option("checkpointLocation", checkpoint)
    )
