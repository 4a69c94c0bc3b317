"""The contract: accepted and rejected rows, and what only the text can tell."""

import json
from datetime import datetime

import pytest
from frames import BASE, NOON, frame, txn

from txnguard.operators import contract, parsing

REJECTED = {
    "negative amount": (dict(amount=-5.0), "bad_amount"),
    "zero amount": (dict(amount=0.0), "bad_amount"),
    "amount is no number": (dict(amount=float("nan")), "bad_amount"),
    "no amount": (dict(amount=None), "bad_amount"),
    "endless amount": (dict(amount=float("inf")), "amount_out_of_range"),
    "amount past exact sums": (dict(amount=1e26), "amount_out_of_range"),
    "merchant without category": (
        dict(receiver_type="P2M", receiver_category=None), "p2m_without_category"),
    "merchant with empty category": (
        dict(receiver_type="P2M", receiver_category=""), "p2m_without_category"),
    "address without bank": (dict(sender_upi="user@"), "bad_sender_upi"),
    "address without user": (dict(sender_upi="@bank"), "bad_sender_upi"),
    "address with dot": (dict(receiver_upi="a.b@bank"), "bad_receiver_upi"),
    "bank with digit": (dict(receiver_upi="user@ok1"), "bad_receiver_upi"),
    "address with line end": (dict(receiver_upi="user@bank\n"), "bad_receiver_upi"),
    **{
        f"empty {name}": ({name: ""}, f"missing_{name}")
        for name in ("txn_id", "sender_upi", "sender_state", "sender_device_id", "receiver_upi",
                     "receiver_type", "status")
    },
}
ACCEPTED = {
    "as it is": {},
    "merchant with category": dict(receiver_type="P2M", receiver_category="fuel"),
    "blank text counts as text": dict(sender_state=" "),
}


def test_rows(spark):
    rows = [txn(**{"txn_id": name, **changes}) for name, (changes, _) in REJECTED.items()]
    rows += [txn(txn_id=name, **changes) for name, changes in ACCEPTED.items()]
    checked = contract.with_violations(frame(spark, rows))
    found = {r.txn_id: r.violations for r in checked.collect()}
    for name, (_, violation) in REJECTED.items():
        key = "" if name == "empty txn_id" else name
        assert found[key] == [violation], name
    for name in ACCEPTED:
        assert found[name] == [], name
    kept = {r.txn_id for r in contract.keep_valid(frame(spark, rows)).collect()}
    assert kept == set(ACCEPTED)
    assert {r.txn_id for r in contract.accepted(checked).collect()} == set(ACCEPTED)
    assert contract.quarantined(checked).count() == len(REJECTED)


def parsed(spark, *texts):
    rows = [(b"k", None if t is None else t.encode(), NOON) for t in texts]
    messages = spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp")
    steps = parsing.with_raw_violations(parsing.parse(parsing.decode(messages)))
    return parsing.flatten(steps).coalesce(1).collect()


def text(**changes):
    value = {**BASE, "timestamp": BASE["timestamp"].isoformat(), **changes}
    return json.dumps(value)


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        (text(), []),
        (text(timestamp="2026-08-02T06:34:42+00:00"), []),
        (text(timestamp="2026-08-02T06:34:42Z"), []),
        (text(amount=7), []),
        (text(unknown=1, nested={"txn_id": 5, "amount": "x"}), []),
        (text(sender_state='say "status": 1'), []),
        (text(timestamp="2026-08-02T12:04:42"), ["timestamp_without_offset"]),
        (text(timestamp="2026-08-02"), ["timestamp_without_offset"]),
        (text(amount="7"), ["wrong_json_type"]),
        (text(txn_id=7), ["wrong_json_type"]),
        (text(status=True), ["wrong_json_type"]),
        (text(is_fraud="no"), ["wrong_json_type"]),
        ("{broken", ["wrong_json_type"]),
        (None, ["wrong_json_type"]),
    ],
)
def test_text_checks(spark, value, expected):
    (row,) = parsed(spark, value)
    assert row.raw_violations == expected


def test_parse_keeps_the_moment_and_drops_unknown_fields(spark):
    (row,) = parsed(spark, text(extra=1))
    utc = datetime(2026, 8, 2, 6, 34, 43, 250000)
    local = spark.createDataFrame([(utc,)], "t timestamp_ntz").selectExpr(
        "CAST(t AS timestamp) AS t"
    )
    assert row.timestamp == local.first().t
    assert row.amount == 777.5 and row.receiver_category is None
    assert "extra" not in row.asDict() and "message_key" not in row.asDict()
