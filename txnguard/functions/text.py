"""Clean-up of raw text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE_BLANKS = r"(?U)^\s+|\s+$"
# A word begins at a letter that does not follow a letter.
_WORD_START = r"(?<!\p{L})(?=\p{L})"


def strip(text: Column) -> Column:
    """Without blanks of any kind at both ends."""
    return F.regexp_replace(text, _EDGE_BLANKS, "")


def title_case(text: Column) -> Column:
    """Capital after every non-letter, so ``o'neil`` gives ``O'Neil``."""
    pieces = F.split(F.lower(text), _WORD_START)
    capital = F.transform(
        pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))
    )
    return F.array_join(capital, "")


def clean_name(text: Column) -> Column:
    """Stripped and title-cased; null if nothing is left."""
    return title_case(F.nullif(strip(text), F.lit("")))


def email_is_valid(text: Column) -> Column:
    """An ``@``, and a dot somewhere after the last one."""
    domain = F.substring_index(text, "@", -1)
    return F.coalesce(text.contains("@") & domain.contains("."), F.lit(False))


def clean_email(text: Column) -> Column:
    return strip(F.lower(text))


def parse_grouped_int(text: Column) -> Column:
    """``'1,234 '`` to 1234; null if it is no whole number."""
    return F.replace(strip(text), F.lit(","), F.lit("")).try_cast("bigint")


def id_from_json(raw: Column) -> Column:
    """``txn_id`` of a raw record, or the older key ``transaction_id`` if the former is absent."""
    keys = F.json_object_keys(raw)
    renamed = F.array_contains(keys, "transaction_id") & ~F.array_contains(keys, "txn_id")
    return F.when(renamed, F.get_json_object(raw, "$.transaction_id")).otherwise(
        F.get_json_object(raw, "$.txn_id")
    )


def random_id() -> Column:
    """A new id per row, as senders give their transactions. Differs on every evaluation."""
    return F.uuid()
