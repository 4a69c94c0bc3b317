"""Progress of running queries: a log line and a metrics row per micro-batch."""

from __future__ import annotations

import json
import logging
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)

METRICS_SCHEMA = (
    "query string, batch_id bigint, n_rows bigint, rows_per_second double, "
    "late_rows_dropped bigint, offsets_behind double"
)


class ProgressLog(StreamingQueryListener):
    """Keeps the last ``keep`` metrics rows, no more; every one goes to the log as a line of JSON."""

    def __init__(self, keep: int = 1000) -> None:
        super().__init__()
        self.rows: deque[tuple] = deque(maxlen=keep)
        self.ended: deque[tuple] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - names are given by Spark
        log.info(json.dumps({"event": "start", "query": str(event.id)}))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        behind = [s.metrics["avgOffsetsBehindLatest"] for s in p.sources
                  if "avgOffsetsBehindLatest" in (s.metrics or {})]
        lag = max(map(float, behind)) if behind else None
        self.rows.append((p.name, p.batchId, p.numInputRows, p.inputRowsPerSecond, late, lag))
        names = [part.split()[0] for part in METRICS_SCHEMA.split(", ")]
        log.info(json.dumps(dict(zip(names, self.rows[-1], strict=True))))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        log.debug(json.dumps({"event": "idle", "query": str(event.id)}))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.append((str(event.id), event.exception))
        log.info(json.dumps({"event": "end", "query": str(event.id), "error": event.exception}))

    def metrics(self, spark: SparkSession) -> DataFrame:
        """The last ``keep`` rows."""
        return spark.createDataFrame(list(self.rows), METRICS_SCHEMA)


def health(query: StreamingQuery) -> dict:
    """What the handle tells: activity, last progress, and why it ended."""
    failure = query.exception()
    return {
        "active": query.isActive,
        "status": query.status,
        "last_progress": query.lastProgress,
        "exception": None if failure is None else str(failure),
    }


def await_all(queries: list[StreamingQuery]) -> None:
    """Blocks until every query has ended; a failed one raises."""
    for query in queries:
        query.awaitTermination()
