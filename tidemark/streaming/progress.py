"""Live progress and health of streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

STATUS_SCHEMA = "mapping string, status string, error string"
PROGRESS_SCHEMA = (
    "mapping string, batch_id bigint, at string, input_rows bigint, input_per_second double, processed_per_second double"
)


def statuses(spark: SparkSession, queries: dict[str, StreamingQuery]) -> DataFrame:
    """One row per mapping: ``running``, ``stopped`` or ``failed`` with the error that ended it.

    Input of ``health_rollup``. A query that failed is never reported as running.
    """
    rows = []
    for mapping, query in queries.items():
        error = query.exception()
        status = "running" if query.isActive else "failed" if error else "stopped"
        rows.append((mapping, status, str(error) if error else None))
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def recent_progress(spark: SparkSession, queries: dict[str, StreamingQuery]) -> DataFrame:
    """Rows and rates of the latest micro-batches, as many as Spark keeps."""
    rows = [
        (m, p["batchId"], p["timestamp"], p["numInputRows"], p.get("inputRowsPerSecond"), p.get("processedRowsPerSecond"))
        for m, q in queries.items()
        for p in q.recentProgress
    ]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


class LatestProgress(StreamingQueryListener):
    """Keeps the newest progress of each named query and how the ended ones ended.

    One entry per name, so it grows with the mappings and not with their batches. ``forget`` drops
    a mapping that was given up.
    """

    def __init__(self):
        self.progress: dict[str, dict] = {}
        self.ended: dict[str, str | None] = {}
        self._names: dict[str, str] = {}

    def forget(self, name: str) -> None:
        self.progress.pop(name, None)
        self.ended.pop(name, None)

    def onQueryStarted(self, event) -> None:
        self._names[str(event.id)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        facts = {"batch_id": p.batchId, "input_rows": p.numInputRows, "processed_per_second": p.processedRowsPerSecond}
        self.progress[p.name or str(p.id)] = facts

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[self._names.pop(str(event.id), None) or str(event.id)] = event.exception
