"""Streaming lanes: topic -> raw zone, and raw -> curated zone.

Both are Structured Streaming queries with their own checkpoint, so a
restart resumes from the last committed offsets and the file sinks' commit
logs keep the output free of duplicates. The transforms are the batch ones
(``parse_messages``, ``cleanse``, ``curate``); only the source and the sink
differ. No watermark: late visits are appended whatever their date, and the
report rescans the whole table.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from threading import Event

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vigil.config import VALID_CODES, LakeConfig
from vigil.operators.curation import curate
from vigil.operators.rules import Codes, cleanse_observed_stream
from vigil.sources.files import STREAM
from vigil.sources.messages import parse_messages

QUALITY_METRICS = "cleanse_quality"


@dataclass(frozen=True)
class Trigger:
    """How often a micro-batch runs.

    ``available_now`` drains what is there and stops (the final flush);
    ``processing_time`` is the time-based flush of a long-running query.
    """

    available_now: bool = False
    processing_time: str | None = None

    def apply(self, writer):
        if self.available_now:
            return writer.trigger(availableNow=True)
        if self.processing_time:
            return writer.trigger(processingTime=self.processing_time)
        return writer

    @classmethod
    def from_config(cls, cfg: LakeConfig) -> Trigger:
        """For sources without offset bounds (files): a batch every ``flush_seconds``
        when time flushing is on, otherwise as soon as data is there. The topic
        source implements the flush rule itself (``topic_options``) and runs on
        the default trigger."""
        return cls(processing_time=f"{cfg.flush_seconds} seconds") if cfg.flush_by_time else cls()


DRAIN = Trigger(available_now=True)


def stream_raw(messages: DataFrame, raw_path: str, checkpoint: str, trigger: Trigger = DRAIN,
               name: str | None = None) -> StreamingQuery:
    """Every message, valid or not, appended to the raw zone as one text line."""
    writer = (
        messages.select("value")
        .writeStream.format("text")
        .option("path", raw_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if name:
        writer = writer.queryName(name)
    return trigger.apply(writer).start()


def curated_stream(messages: DataFrame, codes: Codes = VALID_CODES) -> DataFrame:
    """Messages -> visits -> cleansed -> curated, with quality and invalid-message counts observed.

    The rows are rebalanced by ``visit_date`` before the sink, as in the
    batch write: adaptive execution, which stateless streams have, writes a
    few files a date and splits a date that holds a large share of a
    micro-batch over several tasks.
    """
    visits = parse_messages(messages, mark_invalid=True)
    return curate(cleanse_observed_stream(visits, codes, name=QUALITY_METRICS)).hint("rebalance", "visit_date")


def stream_curate(messages: DataFrame, curated_path: str, checkpoint: str, trigger: Trigger = DRAIN,
                  name: str | None = None, codes: Codes = VALID_CODES) -> StreamingQuery:
    """Append curated visits to the curated zone's stream folder, Parquet partitioned by ``visit_date``.

    Per micro-batch the before / after / removed counts and the number of
    invalid messages are in
    ``query.lastProgress['observedMetrics']['cleanse_quality']`` and the
    message count in ``numInputRows``.
    """
    writer = (
        curated_stream(messages, codes)
        .writeStream.format("parquet")
        .option("path", f"{curated_path.rstrip('/')}/{STREAM}")
        .option("checkpointLocation", checkpoint)
        .partitionBy("visit_date")
        .outputMode("append")
    )
    if name:
        writer = writer.queryName(name)
    return trigger.apply(writer).start()


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to drain; re-raise its failure."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise query.exception()
    return query


def run_until_stopped(start: Callable[[bool], StreamingQuery], stop: Event, poll_s: float = 0.5,
                      border_s: float = 60.0) -> StreamingQuery:
    """A long-running query with a last flush: runs until ``stop`` is set, then drains what is waiting.

    ``start(drain)`` starts the query on its checkpoint. A micro-batch that
    is running when ``stop`` is set is given ``border_s`` seconds to end; one
    that takes longer is cut off and done again by the drain, which its sink
    allows.
    """
    query = start(False)
    while query.isActive and not stop.wait(poll_s):
        pass
    waited = 0.0
    while query.isActive and query.status["isTriggerActive"] and waited < border_s:
        time.sleep(0.05)
        waited += 0.05
    query.stop()
    if query.exception() is not None:
        raise query.exception()
    return run_to_end(start(True))
