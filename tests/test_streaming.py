"""Ingest, detection and alert table as streams, over files."""

import json
import time
from datetime import timedelta

import pytest
from frames import NOON, burst, frame, history, txn
from pyspark.sql import functions as F

from txnguard.operators import profile
from txnguard.operators.alerts import one_per_txn
from txnguard.plans.detection import detect
from txnguard.schema import ALERT_FIELDS, ALERT_SCHEMA, TXN_FIELDS, RuleParams
from txnguard.streaming import ingest, monitor
from txnguard.sources.database import Database
from txnguard.sources.tables import stream_table
from txnguard.streaming.alert_table import AlertTable, AllSinks, DatabaseAlerts, delta_merge
from txnguard.streaming.detection import alert_writers
from txnguard.streaming.known import Known, KnownTables
from txnguard.streaming.late import late_pass, uncounted, watermarks

MESSAGES = "key binary, value binary, timestamp timestamp"


def message(row, at=None):
    value = {k: v for k, v in row.items() if k in TXN_FIELDS}
    value["timestamp"] = row["timestamp"].isoformat()
    at = at or row["timestamp"] + timedelta(seconds=1)
    return (row["sender_upi"].encode(), json.dumps(value).encode(), at)


def add_messages(spark, path, rows):
    spark.createDataFrame(rows, MESSAGES).coalesce(1).write.mode("append").parquet(path)


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None
    return query


class Lake:
    """The folders of one test, and the three ingest queries over them."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.ingested = NOON + timedelta(days=1)

    def at(self, name):
        return f"{self.root}/{name}"

    def ingest(self):
        spark = self.spark
        messages = spark.readStream.schema(MESSAGES).parquet(self.at("topic"))
        run(ingest.bronze_writer(messages, self.at("bronze"), self.at("cp_bronze")))
        for name, writer in (
            ("silver", ingest.silver_writer),
            ("quarantine", ingest.quarantine_writer),
        ):
            bronze = stream_table(spark, self.at("bronze"), ingest.BRONZE_TABLE_SCHEMA)
            run(writer(bronze, self.at(name), self.at(f"cp_{name}")))

    def silver_from(self, *batches):
        """One file per list of rows; the stream takes one file per micro-batch."""
        for rows in batches:
            self.ingested += timedelta(seconds=1)
            silver = frame(self.spark, rows).withColumns(
                {"ingested_at": F.lit(self.ingested), "event_date": F.to_date("timestamp")}
            )
            silver.coalesce(1).write.mode("append").partitionBy("event_date").parquet(
                self.at("silver")
            )

    def detect(self, known, params=RuleParams(), table="alerts", checkpoint="cp_alerts", files=2):
        stream = stream_table(
            self.spark, self.at("silver"), ingest.SILVER_SCHEMA, max_files_per_trigger=files
        )
        alerts = AlertTable(self.spark, self.at(table))
        writers = alert_writers(
            self.spark, stream, self.at("silver"), known, params, alerts, self.at(checkpoint)
        )
        return alerts, [run(writer) for writer in writers][-1]


@pytest.fixture
def lake(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")  # stores of state to open and commit in each batch
    yield Lake(spark, tmp_path)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def known_from(spark, rows):
    past = frame(spark, rows)
    return Known(
        profile.spend_profile(past),
        profile.stored_pairs(past, profile.DEVICE),
        profile.stored_pairs(past, profile.STATE),
    )


def test_ingest_keeps_valid_rows_and_sets_the_rest_aside(spark, lake):
    smoke = {"txn_id": "s", "sender_upi": "a@b", "receiver_upi": "c@d", "amount": 5.0}
    naive = txn(txn_id="naive", timestamp=NOON.replace(tzinfo=None))
    more = message(txn(txn_id="more"))[1][:-1] + b', "channel": "app"}'
    add_messages(
        spark,
        lake.at("topic"),
        [
            message(txn()),
            message(txn()),  # sent again by the producer
            (b"a@b", json.dumps(smoke).encode(), NOON),
            message(naive, at=NOON),
            (b"x", b"{broken", NOON),
            (b"y", more, NOON),
        ],
    )
    lake.ingest()
    silver = spark.read.parquet(lake.at("silver"))
    assert {r.txn_id for r in silver.collect()} == {txn()["txn_id"], "more"} and silver.count() == 2
    assert spark.read.parquet(lake.at("bronze")).count() == 6
    aside = {r.txn_id: r.violations for r in spark.read.parquet(lake.at("quarantine")).collect()}
    assert aside["naive"] == ["timestamp_without_offset"]
    assert "missing_sender_state" in aside["s"] and "missing_timestamp" in aside["s"]
    assert "wrong_json_type" in aside[None]
    raw = {(r.raw_key, r.raw_value) for r in spark.read.parquet(lake.at("quarantine")).collect()}
    assert ("x", "{broken") in raw
    grown = spark.read.parquet(lake.at("bronze")).filter("size(violations) = 0 AND raw_value IS NOT NULL").collect()
    assert [(r.txn_id, r.unknown_fields, r.raw_value.encode()) for r in grown] == [("more", ["channel"], more)]


def test_restart_reads_only_what_is_new(spark, lake):
    add_messages(spark, lake.at("topic"), [message(r) for r in burst(4)])
    lake.ingest()
    add_messages(spark, lake.at("topic"), [message(r) for r in burst(3, prefix="c")])
    lake.ingest()
    lake.ingest()
    for table, n in (("bronze", 7), ("silver", 7)):
        ids = spark.read.parquet(lake.at(table))
        assert ids.count() == n
        assert ids.groupBy("txn_id").count().filter("count > 1").count() == 0


def test_a_lagging_partition_loses_nothing_and_repeats_give_one(spark, lake):
    """One partition of the topic lags by hours, and a message is sent again an hour later."""
    ahead = [message(txn(txn_id=f"a{i}"), at=NOON + timedelta(hours=1 + i)) for i in range(2)]
    again = message(txn(txn_id="a0"), at=NOON + timedelta(hours=2))
    for rows in (ahead, [message(txn(txn_id="lagging")), again], [message(txn(txn_id="lagging"))]):
        add_messages(spark, lake.at("topic"), rows)
        lake.ingest()
    bronze = spark.read.parquet(lake.at("bronze"))
    silver = spark.read.parquet(lake.at("silver"))
    assert sorted(r.txn_id for r in silver.collect()) == ["a0", "a1", "lagging"]
    assert silver.filter("ingested_at IS NULL").isEmpty() and silver.select("ingested_at").distinct().count() == 2
    assert ingest.missing_in_silver(bronze, silver).isEmpty()
    lost = ingest.missing_in_silver(bronze, silver.filter("txn_id = 'a1'"))
    assert lost.schema.names == ingest.SILVER_SCHEMA.names
    assert sorted(r.txn_id for r in lost.collect()) == ["a0", "lagging"]


FLUSH = [txn(txn_id="flush", timestamp=NOON + timedelta(minutes=30), amount=100.0)]
FLUSH_AGAIN = [txn(txn_id="flush2", timestamp=NOON + timedelta(minutes=60), amount=100.0)]


def fraud_day():
    sender2 = "user0001@oksbi"
    drain = burst(
        4, step=5, prefix="d", sender_upi=sender2, sender_device_id="new1_1", amount=700.0,
        start=NOON + timedelta(minutes=5),
    )
    return [
        burst(8, prefix="b"),
        [
            *drain,
            txn(txn_id="big", timestamp=NOON + timedelta(minutes=6), amount=2000.0,
                receiver_type="P2M", receiver_category="fuel"),
            txn(txn_id="moved", timestamp=NOON + timedelta(minutes=7), amount=90.0,
                sender_state="Kerala", status="FAILED"),
        ],
    ]


def fraud_history():
    return [
        *history(),
        *history("user0001@oksbi", sender_device_id="user0001_0"),
    ]


def test_stream_finds_what_the_batch_finds(spark, lake):
    past = fraud_history()
    batches = [*fraud_day(), FLUSH, FLUSH_AGAIN]
    lake.silver_from(*batches)
    table, _ = lake.detect(known_from(spark, past))
    found = {r.txn_id: r for r in table.read().collect()}
    assert {i for i in found if i.startswith("b") and i != "big"} == {f"b{i}" for i in range(8)}
    assert {i for i in found if i.startswith("d")} == {f"d{i}" for i in range(4)}
    assert found["big"].fraud_reason == "amount_anomaly"
    assert found["moved"].fraud_reason == "location_anomaly"

    rows = [r for batch in batches for r in batch]
    batch = one_per_txn(detect(frame(spark, rows), frame(spark, past), RuleParams()))
    key = lambda r: tuple(r[f] for f in ALERT_FIELDS)
    assert {key(r) for r in found.values()} == {key(r) for r in batch.collect()}
    assert found["d0"].txn_count == 4


def test_restart_and_replay_add_nothing(spark, lake):
    lake.silver_from(*fraud_day(), FLUSH, FLUSH_AGAIN)
    known = known_from(spark, fraud_history())
    table, _ = lake.detect(known)
    before = sorted(map(tuple, table.read().select(ALERT_FIELDS).collect()), key=repr)
    lake.detect(known)  # same checkpoint: nothing to do
    lake.detect(known, checkpoint="cp_lost", files=9)  # checkpoint lost: all is evaluated again
    after = sorted(map(tuple, table.read().select(ALERT_FIELDS).collect()), key=repr)
    assert after == before


class FailingOnce(AlertTable):
    """Dies at its first batch with alerts: before it counts, or after, but before the query knows."""

    failed = False

    def __init__(self, spark, path, before=False):
        super().__init__(spark, path)
        self.before, self.failed = before, False

    def write_batch(self, found, batch_id, query_id):
        first = not self.failed and not found.isEmpty()
        if first and self.before:
            self.stage(found, "lost")
        else:
            super().write_batch(found, batch_id, query_id)
        if first:
            self.failed = True
            raise RuntimeError("executor of the sink is gone")


def writers_of(spark, lake, known, sink, files=2):
    stream = stream_table(spark, lake.at("silver"), ingest.SILVER_SCHEMA, max_files_per_trigger=files)
    return alert_writers(spark, stream, lake.at("silver"), known, RuleParams(), sink, lake.at("cp_alerts"))


@pytest.mark.parametrize("before", [True, False])
def test_crash_at_the_sink_loses_and_repeats_nothing(spark, lake, before):
    lake.silver_from(*fraud_day(), FLUSH, FLUSH_AGAIN)
    known = known_from(spark, fraud_history())
    failing = [FailingOnce(spark, lake.at("alerts"), before) for _ in range(2)]
    for k, sink in enumerate(failing):
        query = writers_of(spark, lake, known, sink)[k].trigger(availableNow=True).start()
        with pytest.raises(Exception, match="gone"):
            query.awaitTermination()
        assert "gone" in monitor.health(query)["exception"]
    table, _ = lake.detect(known)
    found = [r.txn_id for r in table.read().collect()]
    assert sorted(found) == sorted(
        [f"b{i}" for i in range(8)] + [f"d{i}" for i in range(4)] + ["big", "moved"]
    )


def test_a_batch_run_again_sees_what_it_saw_before(spark, lake):
    """Between crash and restart more rows of the same window land in silver."""
    lake.silver_from(*fraud_day(), FLUSH, FLUSH_AGAIN)
    known = known_from(spark, fraud_history())
    sink = FailingOnce(spark, lake.at("alerts"), before=True)
    with pytest.raises(Exception, match="gone"):
        run(writers_of(spark, lake, known, sink)[1])
    lake.silver_from(burst(3, prefix="late"))
    run(writers_of(spark, lake, known, sink)[1])
    found = {r.txn_id: r.txn_count for r in sink.read().collect()}
    assert found == {**{f"b{i}": 8 for i in range(8)}, **{f"d{i}": 4 for i in range(4)}}


def test_same_batch_written_again_leaves_the_table(spark, tmp_path):
    rows = findings_of(spark, "b")
    table = AlertTable(spark, str(tmp_path / "alerts"))
    assert table.read() is None
    table.write_batch(rows, 0)
    table.write_batch(rows, 1)  # all known
    table.write_batch(rows, 0)  # replay of the batch that wrote them
    assert table.read().count() == 8
    table.retract(table.read().filter("txn_id = 'b3'"))
    assert {r.txn_id for r in table.read().collect()} == {f"b{i}" for i in range(8)} - {"b3"}


def test_another_checkpoint_replaces_nothing(spark, tmp_path):
    table = AlertTable(spark, str(tmp_path / "alerts"))
    for prefix, query_id in (("b", "one"), ("c", "two")):
        table.write_batch(findings_of(spark, prefix), 0, query_id)
    assert table.read().count() == 16


def test_bursts_around_midnight_whatever_the_clock_of_the_driver(spark, lake, monkeypatch):
    midnight = NOON.replace(hour=5, minute=30, second=0)
    batches = [burst(8, prefix="x", start=midnight - timedelta(seconds=90)), burst(8, prefix="y", start=midnight + timedelta(minutes=2)), FLUSH, FLUSH_AGAIN]
    lake.silver_from(*batches)
    monkeypatch.setenv("TZ", "Asia/Kolkata")
    time.tzset()
    try:
        table, _ = lake.detect(known_from(spark, history()))
        assert {r.txn_id for r in table.read().collect()} == {f"{p}{i}" for p in "xy" for i in range(8)}
    finally:
        monkeypatch.undo()
        time.tzset()


def test_late_rows_are_dropped_and_counted(spark, lake):
    late = burst(7, prefix="late", start=NOON)
    last = [txn(txn_id="z", timestamp=NOON + timedelta(hours=2), amount=100.0)]
    lake.silver_from(FLUSH, FLUSH_AGAIN, late, last)
    progress = monitor.ProgressLog()
    spark.streams.addListener(progress)
    try:
        table, query = lake.detect(known_from(spark, history()), files=1)
        state = monitor.health(query)
        assert not state["active"] and state["exception"] is None
        assert state["last_progress"] is not None
        assert table.read() is None
        dropped = sum(
            s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]
        )
        assert dropped > 0
    finally:
        spark.streams.removeListener(progress)


def test_a_row_from_the_future_does_not_hide_a_burst(spark, lake):
    ahead = txn(
        txn_id="ahead", timestamp=NOON + timedelta(hours=4), kafka_timestamp=NOON, amount=100.0
    )
    start = NOON + timedelta(minutes=1)
    lake.silver_from([ahead], burst(8, start=start), FLUSH, FLUSH_AGAIN)
    table, _ = lake.detect(known_from(spark, history()))
    assert {r.txn_id for r in table.read().collect()} == {f"b{i}" for i in range(8)}


# ---- late rows


def alert_rows(df):
    return sorted((tuple(r[f] for f in ALERT_FIELDS) for r in df.collect()), key=repr)


def as_batch(spark, batches, past):
    rows = [r for batch in batches for r in batch]
    return alert_rows(one_per_txn(detect(frame(spark, rows), frame(spark, past), RuleParams())))


LAST = [txn(txn_id="last", timestamp=NOON + timedelta(minutes=90), amount=100.0)]


def test_stream_and_late_passes_find_what_the_batch_finds(spark, lake):
    """Late rows complete a burst, enlarge another, shift its first window and complete a drain; rows
    stamped ahead of their arrival make one more. Passes run at any time, on compacted tables too."""
    past = fraud_history()
    day = fraud_day()
    few = burst(4, prefix="few", start=NOON + timedelta(minutes=10))
    drain = burst(2, prefix="dl", start=NOON + timedelta(minutes=12), sender_upi="user0001@oksbi", sender_device_id="new2", amount=900.0)
    early = [*day, few + drain, FLUSH, FLUSH_AGAIN]
    late = [
        [{**r, "receiver_upi": f"other{r['txn_id']}@ybl"} for r in burst(3, prefix="few_late", start=NOON + timedelta(minutes=10, seconds=17))],
        burst(2, prefix="b_late", start=NOON - timedelta(seconds=8)),
        burst(1, prefix="dl_late", start=NOON + timedelta(minutes=12, seconds=20), sender_upi="user0001@oksbi", sender_device_id="new2", amount=900.0),
    ]
    ahead = [[{**r, "kafka_timestamp": NOON} for r in burst(7, prefix="ahead", start=NOON + timedelta(minutes=70))]]
    known = known_from(spark, past)
    lake.silver_from(*early, *ahead)
    table, _ = lake.detect(known)
    late_pass(spark, lake.at("silver"), known, RuleParams(), table)
    assert not any(r[0].startswith("ahead") for r in alert_rows(table.read()))  # its windows are open
    lake.silver_from(late[0])
    lake.detect(known)
    assert alert_rows(table.read()) != as_batch(spark, [*early, late[0]], past)
    late_pass(spark, lake.at("silver"), known, RuleParams(), table)
    assert alert_rows(table.read()) == as_batch(spark, [*early, late[0]], past)
    table.compact()
    lake.silver_from(*late[1:], LAST)
    lake.detect(known)
    for _ in range(2):
        late_pass(spark, lake.at("silver"), known, RuleParams(), table)
        assert alert_rows(table.read()) == as_batch(spark, [*early, *ahead, *late, LAST], past)
        table.compact()
    silver = spark.read.parquet(lake.at("silver"))
    side = uncounted(silver, watermarks(silver))
    expected = {r["txn_id"] for batch in (*late, *ahead) for r in batch}
    assert {r.txn_id for r in side.collect()} == expected


# ---- profile versions


def micros(time):
    return int(time.timestamp() * 1_000_000)


def test_a_profile_renewed_while_the_stream_runs_is_used(spark, lake):
    sender = "user0731@oksbi"
    known = KnownTables(spark, lake.at("known"))
    known.publish(frame(spark, history(sender, spend=100.0)), valid_from=micros(lake.ingested))
    big = [txn(txn_id=f"big{i}", timestamp=NOON + timedelta(minutes=i), amount=2500.0, receiver_type="P2M", receiver_category="fuel")
           for i in range(3)]
    lake.silver_from([big[0]])
    sink = AlertTable(spark, lake.at("alerts"))
    stream = stream_table(spark, lake.at("silver"), ingest.SILVER_SCHEMA, max_files_per_trigger=1)
    writer = alert_writers(spark, stream, lake.at("silver"), known, RuleParams(), sink, lake.at("cp"))[0]
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
        lake.ingested += timedelta(minutes=1)
        known.publish(frame(spark, history(sender, spend=1000.0)), valid_from=micros(lake.ingested))
        lake.silver_from([big[1]])
        query.processAllAvailable()
    finally:
        query.stop()
    assert [r.txn_id for r in sink.read().collect()] == ["big0"]
    assert known.as_of(micros(NOON)).profile.first().typical_spend == 100.0
    assert known.as_of(None).profile.first().typical_spend == 1000.0
    with pytest.raises(LookupError):
        KnownTables(spark, lake.at("none")).as_of(None)


# ---- sinks


def findings_of(spark, prefix):
    """The alerts of a burst, as detection gives them."""
    if "found" not in _kept:
        _kept["found"] = alert_rows(detect(frame(spark, burst(8)), frame(spark, history()), RuleParams()))
    named = [(prefix + r[0][1:], *r[1:]) for r in _kept["found"]]
    return spark.createDataFrame(named, ALERT_SCHEMA)


_kept = {}


def test_compaction_changes_nothing_that_is_read(spark, tmp_path):
    table = AlertTable(spark, str(tmp_path / "alerts"))
    for k, prefix in enumerate("bcbd"):
        table.write_batch(findings_of(spark, prefix), k, "one")
    table.write_batch(findings_of(spark, "b").limit(0), 4, "one")  # no rows, no entry
    table.retract(table.read().filter("txn_id IN ('b3', 'c1')"))
    before = sorted(map(tuple, table.read().drop("created_at").collect()))
    assert len(before) == 22 and len(table.ledger.entries()) == 4

    class Dying(AlertTable):
        def _write(self, rows, name):
            super()._write(rows, name)
            raise RuntimeError("gone between writing and commit")

    with pytest.raises(RuntimeError):
        Dying(spark, table.path).compact()
    assert sorted(map(tuple, table.read().drop("created_at").collect())) == before
    held = table.read()  # a reader from before
    table.compact()
    assert sorted(map(tuple, table.read().drop("created_at").collect())) == before
    assert sorted(map(tuple, held.drop("created_at").collect())) == before
    assert len(table.ledger.entries()) == 1
    table.write_batch(findings_of(spark, "x"), 3, "one")  # a batch from before the compaction, run again
    assert len(table.ledger.entries()) == 1
    table.write_batch(findings_of(spark, "x"), 5, "one")
    table.write_batch(findings_of(spark, "y"), 0, "two")
    table.compact()
    assert table.read().count() == 22 + 16 and table.ledger.done() == {"one": 5, "two": 0}


def test_later_evaluations_of_a_window_win_in_any_order(spark, tmp_path):
    small, large = findings_of(spark, "b").withColumn("txn_count", F.lit(6).cast("long")), findings_of(spark, "b")
    for k, order in enumerate(([small, large], [large, small])):
        table = AlertTable(spark, str(tmp_path / f"alerts{k}"))
        for n, found in enumerate(order):
            table.write_batch(found, n)
        assert {r.txn_count for r in table.read().collect()} == {8}


def test_database_sink_stages_and_merges_once_per_batch(spark, tmp_path):
    done = []

    def stage(rows, database, staging):
        done.append(("stage", staging, dict(rows.dtypes)["amount"], rows.count()))

    def merge(spark, database, statement):
        done.append(("merge", statement))

    sink = DatabaseAlerts(Database("jdbc:x"), "fraud_alerts", stage, merge)
    table = AlertTable(spark, str(tmp_path / "alerts"))
    both = AllSinks(sink, table)
    twice = findings_of(spark, "b").unionByName(findings_of(spark, "b"))
    for _ in range(2):
        both.write_batch(twice, 0, "q-1")
    staged = ("stage", "fraud_alerts_staging_q_1", "decimal(12,2)", 8)
    assert done[:2] == [staged, done[1]] and done[2:] == done[:2]
    assert "FROM fraud_alerts_staging_q_1 ON CONFLICT (txn_id) DO NOTHING" in done[1][1]
    assert table.read().count() == 8


def test_delta_statement():
    text = delta_merge("/lake/alerts", "fresh")
    assert text.startswith("MERGE INTO delta.`/lake/alerts` t USING fresh s ON t.txn_id = s.txn_id WHEN NOT MATCHED THEN INSERT (txn_id, ")
    assert "s.created_at)" in text and "UPDATE" not in text
