"""The whole profile of a sender: how many devices and states, and which."""

import pytest

from txnguard.operators import profile

COLUMNS = "sender_upi string, sender_device_id string, sender_state string, receiver_upi string, amount double"


def test_devices_and_states_are_listed(spark):
    rows = [("a", "d2", "Goa", "p", 1.0)] * 2 + [("a", "d10", "Delhi", "p", 3.0)] * 3
    rows += [("a", d, "Goa", None, 5.0) for d in ("D3", "é", "", None, "d2")]
    rows += [("bare", None, None, None, 7.0), (None, "d1", "Goa", "p", 1.0), ("free", "d1", "Goa", "p", None)]
    found = profile.sender_profile(spark.createDataFrame(rows, COLUMNS))
    assert {r.sender_upi: r[1:] for r in found.collect()} == {
        "a": (4.0, 10, 5, 2, 1, ",D3,d10,d2,é", "Delhi,Goa"),
        "bare": (7.0, 1, 0, 0, 0, "", ""),
    }
    assert found.columns[1:] == ["typical_spend", "n_txns", "n_devices", "n_states", "n_payees", "devices", "states"]


@pytest.fixture
def small_tasks(spark):
    """Ranges stay as they are cut, as with large tables."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_lists_of_a_hot_sender_come_from_several_ranges(small_tasks):
    spark = small_tasks
    rows = [("hot", f"d{i}", f"s{i % 300}", f"p{i}", 1.0) for i in range(9_000)]
    rows += [(f"u{i % 70}", f"d{i}", "Goa", "p", 2.0) for i in range(3_000)]
    history = spark.createDataFrame(rows, COLUMNS).repartition(6)
    values = profile.stored_values(history, [profile.DEVICE, profile.STATE, profile.PAYEE])
    pieces = profile.value_pieces(values).filter("sender_upi = 'hot'").select("n_devices").collect()
    assert len(pieces) > 1 and max(r.n_devices for r in pieces) < 9_000
    found = {r.sender_upi: r for r in profile.sender_profile(history).collect()}
    assert len(found) == 71
    for sender in ("hot", "u0", "u69"):
        own = [r for r in rows if r[0] == sender]
        devices, states = (sorted({r[k] for r in own}) for k in (1, 2))
        got = found[sender]
        assert got.devices.split(",") == devices and got.states.split(",") == states
        assert (got.n_txns, got.n_devices, got.n_states) == (len(own), len(devices), len(states))
    sizes = ["sender_upi", "n_txns", "n_devices", "n_states", "n_payees"]
    counted = {tuple(r) for r in profile.value_counts(values).select(sizes).collect()}
    assert counted == {tuple(r[c] for c in sizes) for r in found.values()}
