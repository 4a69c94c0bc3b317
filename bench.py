"""Times the registered queries and prints one JSON line.

BENCH_SF_DIR    folder of tables            (default /root/testdata/sf0.1)
BENCH_CPUS      cores of the local session  (default 8)
BENCH_QUERIES   comma-separated keys        (default: all)
BENCH_TEXT_SECONDS  time for the queries on text, one run each  (default 180)
BENCH_RUNS      timed runs after a warm-up  (default 3, the median counts; 1 if it is slow)
"""

from __future__ import annotations

import importlib
import json
import os
import shutil
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

from txnguard.operators import profile
from txnguard.plans import catalog
from txnguard.session import build_session, materialise
from txnguard.sources.tables import stream_table
from txnguard.streaming.alert_table import AlertTable
from txnguard.streaming.detection import alert_writers
from txnguard.streaming.ingest import SILVER_SCHEMA
from txnguard.streaming.known import Known


SLOW = 5.0
# No text query is begun after this time.
TEXT_SECONDS = float(os.environ.get("BENCH_TEXT_SECONDS", "180"))
entry_points = importlib.import_module("__spark_entry__")


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(query, spark, folder) -> float:
    start = time.perf_counter()
    consume(query(spark, folder))
    return time.perf_counter() - start


def stream_seconds(spark, folder) -> float:
    """Silver table to alert table as a stream, in one run over all that is there."""
    lake = tempfile.mkdtemp(prefix="txnguard-bench-")
    silver = catalog.silver(spark, folder).withColumns(
        {
            "timestamp": F.col("timestamp").cast("timestamp"),
            "kafka_timestamp": F.col("kafka_timestamp").cast("timestamp"),
            "ingested_at": F.current_timestamp(),
            "event_date": F.to_date("timestamp"),
        }
    )
    silver.write.partitionBy("event_date").parquet(f"{lake}/silver")
    past = profile.history_before(silver, catalog.CUTOFF)
    known = Known(
        materialise(profile.spend_profile(past)),
        profile.stored_pairs(past, profile.DEVICE),
        profile.stored_pairs(past, profile.STATE),
    )
    start = time.perf_counter()
    writers = alert_writers(
        spark,
        stream_table(spark, f"{lake}/silver", SILVER_SCHEMA),
        f"{lake}/silver",
        known,
        catalog.LOG_PARAMS,
        AlertTable(spark, f"{lake}/alerts"),
        f"{lake}/checkpoint",
    )
    for query in [writer.trigger(availableNow=True).start() for writer in writers]:
        query.awaitTermination()
    taken = time.perf_counter() - start
    shutil.rmtree(lake, ignore_errors=True)
    return taken


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    keys = chosen.split(",") if chosen else list(catalog.QUERIES)
    spark = build_session(
        "txnguard-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for key in keys:
        query = catalog.QUERIES[key]
        warm_up = seconds(query, spark, folder)
        timed = [seconds(query, spark, folder) for _ in range(runs if warm_up < SLOW else 1)]
        times[key] = round(statistics.median(timed), 3)
        print(f"{key} {times[key]}", file=sys.stderr, flush=True)
    text, begun = {}, time.perf_counter()
    if not chosen:
        for key in sorted(set(entry_points.queries()) - set(catalog.QUERIES)):
            if time.perf_counter() - begun > TEXT_SECONDS:
                break
            text[key] = round(seconds(entry_points.queries()[key], spark, folder), 3)
            print(f"{key} {text[key]}", file=sys.stderr, flush=True)
    streaming = None if chosen else round(stream_seconds(spark, folder), 3)
    n_events = spark.read.parquet(f"{folder}/events.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "events": n_events,
                "detection_events_per_sec": (
                    round(n_events / times["alerts_all"]) if "alerts_all" in times else None
                ),
                "text_queries": text,  # one run each, not in the sum
                "stream_alerts_sec": streaming,
                "stream_events_per_sec": round(n_events / streaming) if streaming else None,
            }
        )
    )


if __name__ == "__main__":
    main()
