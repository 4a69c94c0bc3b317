"""Which folders of a table count: a commit per micro-batch, and per compaction.

A commit is one row in one file, which Spark's writer lets appear whole or not at all. Data lie in a
folder of their own that is complete before the commit names it, so a reader sees all of a batch or
nothing. Entries are never changed. A compaction names the entries that its folder replaces: readers see
the old folders before its entry and the new one after, never both.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "name string, folder string, replaces array<string>, done map<string, bigint>, at bigint"


def load_or_none(spark: SparkSession, *paths: str, schema: str | None = None) -> DataFrame | None:
    """Files of the folders, None where there are none yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


@dataclass(frozen=True)
class Entry:
    """``folder`` is null where a batch had no rows; ``done`` has the last batch of each query in it."""

    name: str
    folder: str | None
    replaces: list[str] = field(default_factory=list)
    done: dict[str, int] = field(default_factory=dict)
    at: int = 0  # microseconds


class Ledger:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def entries(self) -> list[Entry]:
        """Those that count, oldest first: one per batch since the last compaction."""
        stored = load_or_none(self.spark, self.path, schema=_SCHEMA)
        if stored is None:
            return []
        rows = [Entry(r["name"], r["folder"], r["replaces"] or [], r["done"] or {}, r["at"]) for r in stored.collect()]
        gone = {name for row in rows for name in row.replaces}
        return sorted((row for row in rows if row.name not in gone), key=lambda row: (row.at, row.name))

    def done(self) -> dict[str, int]:
        """The last batch that each query has committed."""
        last: dict[str, int] = {}
        for entry in self.entries():
            for query, batch in entry.done.items():
                last[query] = max(batch, last.get(query, batch))
        return last

    def commit(
        self, name: str, folder: str | None, done: dict[str, int], replaces: Iterable[str] = (), at: int | None = None
    ) -> None:
        row = [(name, folder, list(replaces), done, at)]
        frame = self.spark.createDataFrame(row, _SCHEMA).withColumn("at", F.coalesce("at", F.unix_micros(F.current_timestamp())))
        frame.coalesce(1).write.mode("append").parquet(self.path)
