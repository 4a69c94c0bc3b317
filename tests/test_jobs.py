"""The jobs, from messages to alerts, as they would be submitted."""

from datetime import timedelta

import pytest
from frames import NOON, burst, history, txn
from test_streaming import FLUSH, FLUSH_AGAIN, add_messages, message

from txnguard import jobs


def test_from_messages_to_alerts(spark, tmp_path):
    lake, topic = str(tmp_path / "lake"), str(tmp_path / "topic")

    def job(name, *more):
        jobs.main([name, "--lake", lake, *more], spark)

    add_messages(spark, topic, [message(r) for r in history()])
    job("ingest", "--files", topic, "--once")
    job("profile", "--before", "2026-08-01 00:00:00")
    add_messages(spark, topic, [message(r) for r in burst(5, payees=9)] + [message(txn(txn_id="big", amount=5000.0))])
    job("ingest", "--files", topic, "--once")
    add_messages(spark, topic, [message(r, at=NOON + timedelta(hours=1)) for r in FLUSH + FLUSH_AGAIN])
    job("ingest", "--files", topic, "--once")
    job("detect", "--once")
    alerts = jobs.AlertTable(spark, f"{lake}/alerts")
    assert {r.txn_id for r in alerts.read().collect()} == {"big"}
    late = [message({**r, "txn_id": f"late{i}"}, at=NOON + timedelta(hours=2)) for i, r in enumerate(burst(8))][5:]
    add_messages(spark, topic, late)
    job("ingest", "--files", topic, "--once")
    job("detect", "--once")
    job("late")
    job("compact")
    found = {r.txn_id for r in alerts.read().collect()}
    assert found == {"big", *[f"b{i}" for i in range(5)], "late5", "late6", "late7"}
    assert len(alerts.ledger.entries()) == 1


def test_a_source_has_to_be_named(spark, tmp_path):
    with pytest.raises(SystemExit):
        jobs.main(["ingest", "--lake", str(tmp_path)], spark)
    with pytest.raises(SystemExit):
        jobs.main(["unknown"], spark)
