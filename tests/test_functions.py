"""Column functions and operators against plain Python on small fixtures."""

import statistics
from datetime import datetime, timedelta

import pytest
from frames import NOON, burst, frame, history, txn
from hypothesis import given, settings
from hypothesis import strategies as st

from txnguard.functions import text
from txnguard.functions.quantile import grouped_median
from txnguard.operators import profile, reports
from txnguard.schema import RuleParams
from txnguard.sources import database, topics
from txnguard.sources.tables import overwrite_table, read_table, rows_to_frame
from pyspark.sql import functions as F

amounts = st.one_of(
    st.integers(-10_000, 10_000).map(lambda n: n / 100),
    st.floats(-1e12, 1e12, allow_nan=False).map(lambda x: x + 0.0),
)


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from("abc"), st.lists(amounts, min_size=1, max_size=60), min_size=1))
def test_median_is_exact(spark, groups):
    rows = [(k, v) for k, values in groups.items() for v in values]
    rows += [("a", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r.k: r.m for r in grouped_median(df, "k", "v", "m").collect()}
    for key, values in groups.items():
        assert found[key] == pytest.approx(statistics.median(values), rel=1e-12, abs=1e-12)
    assert None not in found


def test_median_of_a_hot_key(spark):
    """A third of all rows in one key, most of them equal."""
    df = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 1000)) AS k",
        "if(id % 3 = 0 AND id % 10 < 8, 499.0D, CAST(id % 977 AS DOUBLE)) AS v",
    )
    exact = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert {r.k: r.m for r in grouped_median(df, "k", "v", "m").collect()} == exact


@given(start=st.integers(0, 10**6), gaps=st.lists(st.integers(0, 10), min_size=5, max_size=5))
def test_a_burst_lies_in_one_sliding_window(start, gaps):
    """Any six rows within 50 s lie together in one of the 60 s windows that slide by 10 s."""
    times = [start]
    for gap in gaps:
        times.append(times[-1] + gap)
    first = times[-1] // 10 * 10 - 50
    assert first <= times[0] and times[-1] < first + 60


def test_text(spark):
    df = spark.createDataFrame(
        [(" \t o'brien anna-lee a1b ÉCOLE\n", " Mira.Guru@Gmail.Com ", ' 1,234 '),
         ("   ", "mira@gmail", "12x"), (None, "mira.gmail.com", None), ("mira", "a.b@c@d.e", "-7")],
        "name string, email string, n string",
    )
    rows = df.select(
        text.clean_name(F.col("name")).alias("name"),
        text.email_is_valid(F.col("email")).alias("ok"),
        text.clean_email(F.col("email")).alias("email"),
        text.parse_grouped_int(F.col("n")).alias("n"),
    ).collect()
    assert [r.name for r in rows] == ["O'Brien Anna-Lee A1B École", None, None, "Mira"]
    assert [r.ok for r in rows] == [True, False, False, True]
    assert rows[0].email == "mira.guru@gmail.com"
    assert [r.n for r in rows] == [1234, None, None, -7]


def test_id_from_json(spark):
    cases = {
        '{"transaction_id": "a"}': "a",
        '{"txn_id": "b", "transaction_id": "a"}': "b",
        '{"txn_id": null, "transaction_id": "a"}': None,
        '{"txn_id": "b"}': "b",
        "{}": None,
    }
    df = spark.createDataFrame([(j,) for j in cases], "j string")
    found = {r.j: r.id for r in df.select("j", text.id_from_json(F.col("j")).alias("id")).collect()}
    assert found == cases


def test_random_ids_differ(spark):
    ids = spark.range(100).select(text.random_id().alias("id"))
    assert ids.distinct().count() == 100


def test_large_amounts_are_in_the_sums(spark):
    rows = [txn(txn_id="a", amount=1e17), txn(txn_id="b", amount=2.0)]
    (stats,) = reports.sender_window_stats(frame(spark, rows), 60, 60).collect()
    assert stats.txn_count == 2 and stats.total_amount == 10**17 + 2


def test_trailing_sums_across_chunks(spark):
    rows = [
        txn(txn_id=f"t{i}", timestamp=NOON + timedelta(seconds=37 * i), amount=float(i + 1),
            sender_upi=f"u{i % 2}@ybl")
        for i in range(60)
    ]
    df = frame(spark, rows)
    found = {
        r.txn_id: (r.recent_count, float(r.recent_amount))
        for r in reports.sender_velocity(df, 300, chunk=1).collect()
    }
    assert len(found) == 60
    for row in rows:
        near = [
            o["amount"] for o in rows
            if o["sender_upi"] == row["sender_upi"]
            and timedelta(0) <= row["timestamp"] - o["timestamp"] <= timedelta(seconds=300)
        ]
        assert found[row["txn_id"]] == (len(near), sum(near))


def test_history_joins(spark):
    past = frame(spark, history())
    now = frame(spark, [
        txn(txn_id="known"), txn(txn_id="device", sender_device_id="x_1"),
        txn(txn_id="payee", receiver_upi="new@ybl"), txn(txn_id="sender", sender_upi="a@b"),
    ])
    ids = lambda df: {r.txn_id for r in df.collect()}
    assert ids(profile.unseen(now, past, profile.DEVICE)) == {"device", "sender"}
    assert ids(profile.seen_before(now, past, profile.DEVICE)) == {"known", "payee"}
    assert ids(profile.unseen(now, past, profile.PAYEE)) == {"payee", "sender"}
    cut = profile.history_before(past, "2026-07-03 00:00:00")
    assert cut.count() + profile.since(past, "2026-07-03 00:00:00").count() == 5


def test_profile_lists(spark):
    past = history() + history(n=2, sender_device_id="user0731_9", sender_state="Delhi")
    (row,) = profile.sender_profile(frame(spark, past)).collect()
    assert row.n_states == 2
    assert (row.n_txns, row.n_devices, row.n_payees, row.typical_spend) == (7, 2, 1, 100.0)


def test_first_of_each_id_keeps_the_first_to_arrive(spark):
    early = txn(kafka_timestamp=NOON, amount=1.0)
    late = txn(kafka_timestamp=NOON + timedelta(seconds=5), amount=2.0)
    (row,) = reports.first_of_each_id(frame(spark, [late, early, late])).collect()
    assert row.amount == 1.0


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "mohan"), (2, "Ram"), (3, "Vijay")]
    overwrite_table(rows_to_frame(spark, rows, "id int, name string"), path)
    overwrite_table(rows_to_frame(spark, rows[:2], ["id", "name"]), path)
    assert sorted(map(tuple, read_table(spark, path).collect())) == rows[:2]


def test_source_options():
    topic = topics.Topic("host:9092", "payments", max_offsets_per_trigger=100, min_partitions=64)
    read = topic.read_options(streaming=True)
    assert read["subscribe"] == "payments" and read["startingOffsets"] == "earliest"
    assert read["maxOffsetsPerTrigger"] == "100" and read["minPartitions"] == "64"
    assert "maxOffsetsPerTrigger" not in topic.read_options(streaming=False)
    assert topic.write_options()["topic"] == "payments"
    db = database.Database("jdbc:postgresql://host/db", properties={"user": "u", "password": "x"})
    assert db.options("fraud_alerts")["dbtable"] == "fraud_alerts"
    assert "password" not in repr(db)
    ranges = database.range_options("txn_timestamp", "2024-01-01", "2024-02-01", 31)
    assert ranges["numPartitions"] == "31"
    statement = database.merge_statement("staging", "fraud_alerts")
    assert statement.endswith("ON CONFLICT (txn_id) DO NOTHING")


def test_window_has_to_be_whole_slides():
    with pytest.raises(ValueError):
        RuleParams(burst_seconds=60, burst_slide_seconds=7)


def test_message_round_trip(spark):
    rows = frame(spark, burst(2) + [txn(timestamp=datetime.fromisoformat("2026-08-02T12:00:00+00:00"))])
    (m,) = topics.message_frame(rows).filter("value LIKE '%17:30:00%'").collect()
    assert m.key == "user0731@oksbi"
    assert '"timestamp":"2026-08-02T17:30:00.000000+05:30"' in m.value
    assert '"receiver_category":null' in m.value


def test_long_numbers_stay_whole(spark):
    from txnguard.sources import events

    rows = [
        (3_000_000_000 + i, datetime(2024, 1, 1) + timedelta(seconds=i), 9_990 + i * 50_000, "click", 1.0, f'{{"k": {i % 100}}}')
        for i in range(40)
    ]
    log = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    txns = events.transactions_from_events(log)
    assert txns.select("txn_id").distinct().count() == txns.select("sender_upi").distinct().count() == 40
    assert events.with_labels(txns).filter("fraud_pattern = 'location_anomaly'").isEmpty()
