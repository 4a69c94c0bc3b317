"""Session defaults, and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "txnguard", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` wins over the defaults.

    Shuffle partitions are left to AQE: it starts from
    ``coalescePartitions.initialPartitionNum`` and merges what turns out small, and splits
    hot join partitions, so the same job fits a laptop and a large cluster.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        # Call sites for error messages cost a round trip to the JVM per expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution."
        "streaming.state.RocksDBStateStoreProvider",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary one, removed at exit.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="txnguard-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, as a table in the shared folder.

    For a small intermediate that several branches read: without it each branch repeats
    the scan and joins beneath. The copy outlives executors, and its size in files is what
    the planner goes by when it decides whether to broadcast it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
