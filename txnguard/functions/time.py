"""Time expressions.

Batch tables may hold ``TIMESTAMP_NTZ`` (wall clock, taken as UTC), streams need
``TIMESTAMP``. The helpers take the frame to look up which one a column is, so that the
result does not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: event time is reported in India's zone, which has no daylight saving.
IST_OFFSET = "+05:30"
IST_MINUTES = 330

# An ISO time is usable only with an offset; matched on the raw text, before parsing.
OFFSET_PATTERN = r"(Z|[+-]\d\d:?\d\d)\z"


def utc_wall_clock(df: DataFrame, name: str) -> Column:
    """The column as UTC wall clock without zone."""
    if df.schema[name].dataType.typeName() == "timestamp_ntz":
        return F.col(name)
    local = F.col(name).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def ist_wall_clock(df: DataFrame, name: str) -> Column:
    return utc_wall_clock(df, name) + F.expr(f"INTERVAL {IST_MINUTES} MINUTES")


def ist_hour(df: DataFrame, name: str) -> Column:
    return F.hour(ist_wall_clock(df, name))


def iso_ist(df: DataFrame, name: str) -> Column:
    """``2031-02-07T18:45:09.120750+05:30``: the form in which events are published."""
    text = F.date_format(ist_wall_clock(df, name), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(text, F.lit(IST_OFFSET))


def iso_utc_seconds(df: DataFrame, name: str) -> Column:
    return F.date_format(utc_wall_clock(df, name), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def window_spec(length_seconds: int, slide_seconds: int) -> tuple[str, str]:
    return f"{length_seconds} seconds", f"{slide_seconds} seconds"


def pane(column: str, seconds: int) -> Column:
    """Start of the epoch-aligned tumbling pane a row falls in."""
    return F.window(column, f"{seconds} seconds")["start"]
