"""Each rule at its default thresholds: rows just inside and just outside."""

from datetime import datetime, timedelta

import pytest
from frames import IST, NOON, burst, frame, history, txn

from txnguard.operators import alerts, bursts, profile, rules
from txnguard.plans.detection import detect, detect_for_sender
from txnguard.schema import ALERT_FIELDS, REASON_PRIORITY, RuleParams

P = RuleParams()


def ids(df):
    return sorted(r.txn_id for r in df.collect())


def enriched(spark, rows, past):
    known = profile.spend_profile(frame(spark, past))
    return profile.enrich(frame(spark, rows), known, P.spend_floor)


def test_rapid_fire(spark):
    edge = NOON.replace(second=45)
    rows = [
        *burst(6, prefix="six"),
        *burst(8, start=edge + timedelta(hours=1), prefix="edge"),
        *burst(5, start=NOON + timedelta(hours=2), prefix="five"),
        *burst(6, start=NOON + timedelta(hours=3), payees=1, prefix="one"),
        *burst(6, start=NOON + timedelta(hours=4), step=18, prefix="slow"),
        *burst(6, start=NOON + timedelta(hours=5), prefix="big", amount=501.0),
        *burst(6, start=NOON + timedelta(hours=6), prefix="failed", status="FAILED"),
        *burst(6, start=NOON + timedelta(hours=7), prefix="shop", receiver_type="P2M"),
    ]
    found = rules.rapid_fire(frame(spark, rows), P)
    expected = [f"six{i}" for i in range(6)] + [f"edge{i}" for i in range(8)]
    assert ids(found) == sorted(expected)
    first = found.filter("txn_id = 'six0'").first()
    assert first.txn_count == 6 and float(first.total_amount) == 600.0
    assert first.window_end - first.window_start == timedelta(seconds=60)
    assert found.columns == ALERT_FIELDS


def test_rapid_fire_keeps_devices_apart(spark):
    rows = burst(3, prefix="a") + burst(3, prefix="b", sender_device_id="user0731_1")
    assert ids(rules.rapid_fire(frame(spark, rows), P)) == []


def test_odd_hour(spark):
    def at(name, h, m, s, amount):
        return txn(txn_id=name, timestamp=datetime(2026, 8, 2, h, m, s, tzinfo=IST), amount=amount)

    rows = [
        at("first", 1, 0, 0, 800.0),
        at("last", 4, 59, 59, 800.0),
        at("before", 0, 59, 59, 800.0),
        at("after", 5, 0, 0, 800.0),
        at("low", 2, 0, 0, 799.0),
    ]
    assert ids(rules.odd_hour(enriched(spark, rows, history()), P)) == ["first", "last"]


def test_amount_anomaly(spark):
    rows = [
        txn(txn_id="in", amount=2000.0),
        txn(txn_id="failed", amount=2000.0, status="FAILED"),
        txn(txn_id="out", amount=1999.0),
        txn(txn_id="unknown", amount=9e6, sender_upi="user0001@ybl"),
    ]
    assert ids(rules.amount_anomaly(enriched(spark, rows, history()), P)) == ["failed", "in"]


def test_small_spend_is_raised_to_the_floor(spark):
    rows = [txn(txn_id="in", amount=200.0), txn(txn_id="out", amount=199.0)]
    found = rules.amount_anomaly(enriched(spark, rows, history(spend=1.0)), P)
    assert ids(found) == ["in"]


def test_unseen_device_drain(spark):
    rows = [
        *burst(3, step=10, prefix="in", sender_device_id="abcd0001_1", amount=500.0),
        *burst(2, start=NOON + timedelta(hours=1), prefix="two", sender_device_id="abcd0002_1",
               amount=500.0),
        *burst(3, start=NOON + timedelta(hours=2), prefix="known", amount=500.0),
        *burst(3, start=NOON + timedelta(hours=3), prefix="low", sender_device_id="abcd0003_1",
               amount=499.0),
    ]
    seen = profile.seen_pairs(frame(spark, history()), profile.DEVICE)
    found = rules.unseen_device_drain(enriched(spark, rows, history()), seen, P)
    assert ids(found) == ["in0", "in1", "in2"]


def test_location(spark):
    rows = [
        txn(txn_id="moved", sender_state="Kerala"),
        txn(txn_id="home"),
        txn(txn_id="unknown", sender_state="Kerala", sender_upi="user0001@ybl"),
    ]
    assert ids(rules.location(enriched(spark, rows, history()), profile.seen_pairs(frame(spark, history()), profile.STATE))) == ["moved"]


def test_senders_with_many_devices_and_states(spark):
    past = [
        row
        for i, state in enumerate(("Kerala", "Bihar", "Punjab"))
        for row in history(n=2, sender_state=state, sender_device_id=f"dev{i}")
    ]
    short = history("user0001@ybl", n=2, sender_state="Delhi")
    rows = [
        txn(txn_id="new", sender_state="Goa"),
        txn(txn_id="old", sender_state="Punjab"),
        txn(txn_id="short", sender_state="Goa", sender_upi="user0001@ybl"),
        *burst(3, prefix="drain", sender_device_id="dev9", amount=500.0, sender_state="Bihar"),
        *burst(3, start=NOON + timedelta(hours=1), prefix="known", sender_device_id="dev2",
               amount=500.0, sender_state="Bihar"),
    ]
    many = [r for i in range(70) for r in history(n=1, sender_device_id=f"dev{i}")]
    (row,) = profile.sender_profile(frame(spark, many)).collect()
    values = profile.sender_values(frame(spark, many), [profile.DEVICE])
    assert row.n_devices == values.count() == 70
    past += many
    rows = [{**r, "sender_device_id": "dev99"} if r["sender_device_id"] == "dev9" else r for r in rows]
    found = detect(frame(spark, rows), frame(spark, past + short), P)
    by_reason = {(r.txn_id, r.fraud_reason) for r in found.collect()}
    assert by_reason == {
        ("new", "location_anomaly"),
        ("short", "location_anomaly"),
        *((f"drain{i}", "unseen_device_drain") for i in range(3)),
    }


def test_strongest_reason_is_kept(spark):
    rows = burst(6, prefix="x", sender_device_id="abcd0001_1", amount=500.0)
    night = datetime(2026, 8, 2, 2, 0, tzinfo=IST)
    rows += [txn(txn_id="big", timestamp=night, amount=5000.0, sender_state="Kerala")]
    every = detect(frame(spark, rows), frame(spark, history()), P)
    assert {r.fraud_reason for r in every.collect()} == set(REASON_PRIORITY)
    best = {r.txn_id: r.fraud_reason for r in alerts.one_per_txn(every).collect()}
    assert best["x0"] == "unseen_device_drain" and best["big"] == "amount_anomaly"
    one = detect_for_sender(frame(spark, rows), frame(spark, history()), P, "user0731@oksbi")
    assert one.count() == every.count()
    quality = alerts.rule_quality(
        every, frame(spark, [txn(txn_id="big", is_fraud=True, fraud_pattern="amount_anomaly"),
                             txn(txn_id="missed", is_fraud=True, fraud_pattern="other")])
    )
    found = {r.fraud_pattern: r for r in quality.collect()}
    assert found["amount_anomaly"].recall == 1.0 and found["amount_anomaly"].precision == 1.0
    assert found["other"].recall == 0.0 and found["other"].precision is None


def test_a_large_amount_stays_in_the_alert(spark):
    rows = [txn(txn_id="huge", amount=1e12)]
    (alert,) = rules.amount_anomaly(enriched(spark, rows, history()), P).collect()
    assert alert.amount == 10**12 and alert.txn_id == "huge"


@pytest.mark.parametrize("min_txns", [2, 3, 5])
def test_crowded_loses_no_window(spark, min_txns):
    """One sender with a third of all rows among many: same windows with and without."""
    rows = burst(40, step=7, prefix="hot", payees=9)
    for u in range(20):
        rows += burst(4, step=13 * (1 + u % 5), prefix=f"u{u}-", sender_upi=f"u{u}@ybl")
    df = frame(spark, rows)
    near = bursts.crowded(df, 60, 10, min_txns)
    key = lambda x: sorted(map(tuple, bursts.windows(x, 60, 10, min_txns, 2).collect()))
    assert key(near) == key(df) and key(df)
