"""The data contract as SQL predicates: each is true where a row breaks it, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnguard.schema import REQUIRED_TEXT

# Fixed value: shape of a payment address. \z, as $ also matches before a final newline.
UPI_PATTERN = r"^[A-Za-z0-9]+@[A-Za-z]+\z"

MISSING_PREFIX = "missing_"
BAD_SENDER = "bad_sender_upi"
BAD_RECEIVER = "bad_receiver_upi"
BAD_AMOUNT = "bad_amount"
HUGE_AMOUNT = "amount_out_of_range"
NO_CATEGORY = "p2m_without_category"
NO_TIME = "missing_timestamp"
NO_OFFSET = "timestamp_without_offset"
NOT_STRICT = "wrong_json_type"


def _blank(name: str) -> str:
    """Null or empty. Blanks count as text."""
    return f"({name} IS NULL OR {name} = '')"


def _bad_address(name: str) -> str:
    return f"(NOT {_blank(name)} AND NOT {name} RLIKE r'{UPI_PATTERN}')"


# NaN sorts above every number in Spark, so it is named.
_BAD_AMOUNT = "(amount IS NULL OR isnan(amount) OR amount <= 0)"
# What exact sums take: see EXACT_AMOUNT. Infinity is beyond it.
_HUGE_AMOUNT = "(NOT isnan(amount) AND amount >= 1e25D)"

FIELD_CHECKS: dict[str, str] = {
    **{MISSING_PREFIX + name: _blank(name) for name in REQUIRED_TEXT},
    NO_TIME: "timestamp IS NULL",
    BAD_SENDER: _bad_address("sender_upi"),
    BAD_RECEIVER: _bad_address("receiver_upi"),
    BAD_AMOUNT: _BAD_AMOUNT,
    HUGE_AMOUNT: f"coalesce({_HUGE_AMOUNT}, false)",
    NO_CATEGORY: f"(receiver_type <=> 'P2M' AND {_blank('receiver_category')})",
}


def meets_contract() -> Column:
    """True where no check fails; a conjunction, of which a scan takes over what it can."""
    return F.expr(" AND ".join(f"NOT {sql}" for sql in FIELD_CHECKS.values()))
