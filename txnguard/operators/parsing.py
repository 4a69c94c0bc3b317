"""Topic messages to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.functions.contract import NO_OFFSET, NOT_STRICT
from txnguard.functions.time import OFFSET_PATTERN
from txnguard.schema import TXN_FIELDS, TXN_SCHEMA

RAW_VIOLATIONS = "raw_violations"
_CORRUPT = "_corrupt"

# The time is read as text first: whether it has an offset can only be seen there.
_WIRE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType)
        for f in TXN_SCHEMA.fields
    ]
    + [T.StructField(_CORRUPT, T.StringType())]
)
_TEXT_FIELDS = [f.name for f in _WIRE_SCHEMA.fields[:-1] if f.dataType == T.StringType()]


def decode(messages: DataFrame) -> DataFrame:
    """Binary key and value as text, with the ingestion time of the topic."""
    return messages.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("json"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def parse(decoded: DataFrame) -> DataFrame:
    """JSON to a struct. Missing fields are null, unknown ones left out (``unknown_fields`` names them),
    broken text all null."""
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    return decoded.withColumn("parsed", F.from_json("json", _WIRE_SCHEMA, options))


def unknown_fields(json: str = "json") -> Column:
    """Names of the fields of a message that the schema does not have, in order; empty for broken text.

    A producer that has been changed ahead of its readers is told by them before its data are lost.
    """
    known = F.array(*[F.lit(name) for name in TXN_FIELDS])
    names = F.array_except(F.json_object_keys(json), known)
    return F.coalesce(F.array_sort(names), F.array().cast("array<string>"))


def flatten(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The payload's own columns, and those of the message in ``keep``; the payload's sender wins over
    the message key.

    Unpacked by a generator rather than a projection: a filter on the fields would be
    merged into a projection, and parse the text anew for every field it looks at.
    """
    kept = [c for c in parsed.columns if c in ("kafka_timestamp", RAW_VIOLATIONS, *keep)]
    rows = parsed.select(*kept, F.inline(F.array("parsed")))
    fields = [
        F.col(name).try_cast("timestamp").alias(name) if name == "timestamp" else F.col(name)
        for name in TXN_FIELDS
    ]
    return rows.select(*kept, *fields)


def _number_in_text_field() -> str:
    """A field that has to be text, but is written as something else.

    One look at the text clears nearly all messages. The others are read again with the
    type of every token kept, as the look may have hit something nested or quoted.
    """
    names = "|".join(_TEXT_FIELDS)
    look = rf"""json RLIKE r'"({names})"\s*:\s*[^"n\s]'"""
    listed = ", ".join(f"'{name}'" for name in _TEXT_FIELDS)
    exact = (
        "exists(map_entries(from_json(json, 'map<string, variant>')), e -> "
        f"e.key IN ({listed}) AND e.value IS NOT NULL "
        "AND schema_of_variant(e.value) NOT IN ('STRING', 'VOID'))"
    )
    return f"({look} AND coalesce({exact}, true))"


def with_raw_violations(parsed: DataFrame) -> DataFrame:
    """Adds what can only be told from the text: coerced types, a time without offset.

    A number would be taken as an id, a naive time as session-local, without complaint.
    """
    not_strict = (
        f"json IS NULL OR parsed IS NULL OR parsed.{_CORRUPT} IS NOT NULL "
        f"OR {_number_in_text_field()}"
    )
    naive = f"NOT coalesce(parsed.timestamp RLIKE r'{OFFSET_PATTERN}', true)"
    found = (
        f"array_compact(array(if({not_strict}, '{NOT_STRICT}', NULL), "
        f"if({naive}, '{NO_OFFSET}', NULL)))"
    )
    return parsed.withColumn(RAW_VIOLATIONS, F.expr(found))
