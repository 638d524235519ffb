"""Counts of streams that outlive the process: query progress written to a table.

``FlushMetrics`` is a listener of streaming queries. Each micro-batch that
read something leaves one row, in a folder named after the run and the
batch, so an event delivered twice leaves one row. It holds the events of
the flush and the observed counts of the cleansing.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "run_id string, query_id string, name string, batch_id long, started string, events long, seconds double, "
    "observed string")


class FlushMetrics(StreamingQueryListener):
    """Writes progress under ``path``; ``finished`` waits until a run's last event was written."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        observed = {name: row.asDict() for name, row in p.observedMetrics.items()}
        seconds = p.durationMs.get("triggerExecution", 0) / 1000
        row = (str(p.runId), str(p.id), p.name, p.batchId, p.timestamp, p.numInputRows, seconds, json.dumps(observed))
        self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/run={p.runId}/batch={p.batchId:012d}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def finished(self, run_id, timeout_s: float = 60.0) -> None:
        if not self._end(run_id).wait(timeout_s):
            raise TimeoutError(f"no end of run {run_id} in {timeout_s} s")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All rows that ``FlushMetrics`` wrote, one a run and micro-batch."""
    return spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").parquet(path)
