"""One sender holds a third of all rows; joins shuffle and split, as on a cluster."""

import importlib
import statistics
import struct

import duckdb
import pytest
from compare import TABLES, canonical, spark_rows
from pyspark.sql import functions as F

from txnguard.functions import quantile
from txnguard.operators import profile, reports
from txnguard.plans import catalog
from txnguard.session import materialise
from txnguard.sources import events
from txnguard.sources.tables import write_keyed
from txnguard.streaming.detection import alerts_of_rows
from txnguard.streaming.known import Known

SOURCE = "/root/testdata/sf0.01"
SQL = importlib.import_module("__spark_entry__").oracle_sql()
CLUSTER_LIKE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("hot")
    duckdb.sql(
        f"COPY (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 8 ELSE user_id END AS user_id) "
        f"FROM '{SOURCE}/events.parquet') TO '{path}/events.parquet' (ROW_GROUP_SIZE 2048)"
    )
    return str(path)


@pytest.fixture(scope="module")
def cluster_like(spark):
    for key, value in CLUSTER_LIKE.items():
        spark.conf.set(key, value)
    yield spark
    for key in CLUSTER_LIKE:
        spark.conf.unset(key)


def duck(sql, folder):
    db = duckdb.connect()
    for table in TABLES:
        place = folder if table == "events" else SOURCE
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{place}/{table}.parquet'")
    result = db.sql(sql)
    return canonical(result.columns, result.fetchall())


@pytest.mark.parametrize(
    "key",
    [
        "sender_profile",
        "txn_enriched",
        "unseen_device_txn",
        "known_device_txn",
        "new_payee_txn",
        "rule_rapid_fire",
        "alerts_dedup",
        "sender_window_stats",
        "sender_velocity",
        "key_skew",
    ],
)
def test_hot_sender(cluster_like, folder, key):
    assert spark_rows(catalog.QUERIES[key](cluster_like, folder)) == duck(SQL[key], folder)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["txn_enriched", "unseen_device_txn", "known_device_txn"])
def test_hot_join_partition_is_split(cluster_like, folder, key):
    small_reads = {"spark.sql.files.maxPartitionBytes": "40KB",
                   "spark.sql.files.openCostInBytes": "1KB"}
    for name, value in small_reads.items():
        cluster_like.conf.set(name, value)
    try:
        df = catalog.QUERIES[key](cluster_like, folder)
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for name in small_reads:
            cluster_like.conf.unset(name)


def test_hot_sender_of_a_micro_batch_is_split(cluster_like, folder, tmp_path):
    """The profile is joined inside the batch, where its plan adapts; not in the plan of the stream."""
    spark, path = cluster_like, str(tmp_path / "silver")
    now, past = catalog.current(spark, folder), catalog.history(spark, folder)
    now.withColumns({c: F.col(c).cast("timestamp") for c in ("timestamp", "kafka_timestamp")}).repartition(8).write.parquet(path)
    values = profile.stored_values(past, [profile.DEVICE, profile.STATE])
    known = Known(materialise(profile.spend_profile(past)), profile.pairs_of(values, profile.DEVICE), profile.pairs_of(values, profile.STATE))
    plans = []

    def write(rows, batch_id):
        found = alerts_of_rows(rows, known, catalog.LOG_PARAMS)
        found.collect()
        plans.append(plan_of(found))

    schema = spark.read.parquet(path).schema
    spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    assert len(plans) == 1 and "skew=true" in plans[0]


def test_copies_of_one_row_are_reduced_before_the_shuffle(spark, folder):
    copies = catalog.transactions(spark, folder)
    plan = plan_of(reports.first_of_each_id(copies))
    before_shuffle = plan[plan.index("Exchange hashpartitioning(txn_id") :]
    assert "WindowGroupLimit" in before_shuffle


def test_history_is_read_once_per_statistic(spark, folder):
    """One scan for the median, whose two branches share an exchange, and one for all values together."""
    df = catalog.sender_profile(spark, folder)
    df.collect()
    plan = plan_of(df).split("Initial Plan")[0]
    assert plan.count("FileScan") == 2
    assert plan.count("ReusedExchange") == 1
    assert plan.count("collect_list") == plan.count("collect_set") == 0


# ---- a hot key spread over tasks


def largest_tasks(spark, df, order):
    """Rows per partition of a frame laid out by range."""
    laid = df.repartitionByRange(8, *order)
    return [r["count"] for r in laid.groupBy(F.spark_partition_id().alias("p")).count().collect()]


@pytest.fixture(scope="module")
def hot_day(spark, tmp_path_factory):
    """One sender with a third of the rows, all within a day, amounts in full precision of one magnitude."""
    path = str(tmp_path_factory.mktemp("hot_day") / "txns")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.when(F.col("id") % 3 == 0, F.pmod(F.xxhash64("id"), F.lit(86_400))).otherwise(F.pmod(F.xxhash64("id"), F.lit(30 * 86_400))))
    rows = spark.range(30_000).select(
        F.concat(F.lit("t"), F.col("id")).alias("txn_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("sender_upi"),
        at.alias("timestamp"),
        (F.lit(100.0) + F.pmod(F.xxhash64(F.col("id") * 7), F.lit(1 << 40)) / F.lit(float(1 << 41))).alias("amount"),
        F.concat(F.lit("d"), F.col("id")).alias("sender_device_id"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_median_of_a_hot_sender_within_one_bin(spark, hot_day, monkeypatch):
    sizes = []
    narrowed = quantile._narrowed

    def watched(rows, key, value):
        found = narrowed(rows, key, value)
        sizes.extend(r["_size"] for r in found.collect())
        return found

    monkeypatch.setattr(quantile, "_narrowed", watched)
    got = {r[0]: r[1] for r in quantile.grouped_median(hot_day, "sender_upi", "amount", "m", most=50).collect()}
    amounts = {}
    for r in hot_day.collect():
        amounts.setdefault(r.sender_upi, []).append(r.amount)
    assert got == {k: statistics.median(v) for k, v in amounts.items()}
    assert max(sizes) > 5_000, "the hot sender's amounts lie in one bin"
    assert min(sizes) <= 50, "what is sorted in the end is small"


def test_median_of_values_that_hardly_differ(spark):
    base = [struct.unpack("<d", struct.pack("<q", (1 << 62) + k))[0] for k in range(201)]
    odd = [-float("inf"), -3.5, -0.0, 0.0, 1e-300, 5e-324, 1e308, float("inf")]
    rows = [("near", v) for v in base] + [("odd", v) for v in odd * 3] + [("none", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r[0]: r[1] for r in quantile.grouped_median(df, "k", "v", "m", most=2).collect()}
    assert got == {"near": base[100], "odd": statistics.median(sorted(odd * 3))}


def test_velocity_of_a_hot_sender_within_one_day(spark, hot_day):
    """Running totals by range give what windows give, and no range has more than its share."""
    by_totals = reports.sender_velocity(hot_day, 3600, most=100)
    by_window = reports.sender_velocity(hot_day, 3600)
    assert spark_rows(by_totals) == spark_rows(by_window)
    sizes = largest_tasks(spark, hot_day, ["sender_upi", "timestamp"])
    assert max(sizes) < 2 * 30_000 / 8


def test_a_sender_with_very_many_devices(spark, hot_day):
    """Rows, one per value, and counts: no list anywhere."""
    txns = hot_day.withColumns({"sender_state": F.lit("Goa"), "receiver_upi": F.lit(None).cast("string")})
    values = profile.stored_values(txns, [profile.DEVICE, profile.STATE, profile.PAYEE])
    hot = values.filter("sender_upi = 'hot'")
    assert hot.filter("kind = 'sender_device_id'").count() == 10_000
    counts = profile.value_counts(values).filter("sender_upi = 'hot'").first()
    assert (counts.n_txns, counts.n_devices, counts.n_states, counts.n_payees) == (10_000, 10_000, 1, 0)
    assert profile.pairs_of(values, profile.DEVICE).filter("sender_upi = 'hot'").count() == 10_000
    assert profile.pairs_of(values, profile.PAYEE).isEmpty()


# ---- look-ups


def rows_read(df):
    """Rows that the scan has handed on, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while "Scan" not in plan.nodeName():
        plan = plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.children().apply(0)
    return plan.metrics().apply("numOutputRows").value()


def test_look_ups_skip_row_groups(spark, hot_day, tmp_path):
    path = str(tmp_path / "keyed")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(64 << 10))
    try:
        write_keyed(hot_day, path, ["sender_upi", "timestamp"], {"txn_id": 1000})
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    keyed = spark.read.parquet(path)
    for condition, n in (("txn_id = 't4711'", 1), ("sender_upi = 's77'", 40), ("txn_id = 'not there'", 0)):
        found = keyed.filter(condition)
        assert "PushedFilters: [IsNotNull" in plan_of(found)
        assert found.count() == n == hot_day.filter(condition).count()
        assert rows_read(found) < 30_000 / 3


@pytest.mark.parametrize("key, pushed", [("txn_lookup", "EqualTo(event_id,123)"), ("alerts_by_sender", "EqualTo(user_id,8)")])
def test_keys_of_look_ups_reach_the_log(spark, folder, key, pushed):
    log = spark.read.parquet(f"{folder}/events.parquet")
    narrowed = events.rows_of_txn(log, catalog.LOOKUP_ID) if key == "txn_lookup" else events.rows_of_sender(log, catalog.SENDER)
    assert pushed in plan_of(narrowed)
    if key == "txn_lookup":
        df = catalog.txn_lookup(spark, folder)
        assert pushed in plan_of(df) and rows_read(df) < log.count()
    assert events.rows_of_txn(log, "x").isEmpty() and events.rows_of_sender(log, "user0008@ybl").isEmpty()


def test_filters_and_columns_reach_the_scan(spark, folder):
    plan = plan_of(catalog.current(spark, folder).select("txn_id"))
    assert "GreaterThanOrEqual(ts,2024-01-16T00:00" in plan
    assert "GreaterThan(value,0.0)" in plan
