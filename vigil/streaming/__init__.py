"""Structured Streaming lanes sharing the batch transforms."""

from vigil.streaming.ingest import (
    DRAIN,
    Trigger,
    curated_stream,
    run_to_end,
    run_until_stopped,
    stream_curate,
    stream_raw,
)
from vigil.streaming.metrics import FlushMetrics, read_metrics
from vigil.streaming.staged import Zones, stream_staged

__all__ = [
    "DRAIN",
    "FlushMetrics",
    "Trigger",
    "Zones",
    "curated_stream",
    "read_metrics",
    "run_to_end",
    "run_until_stopped",
    "stream_curate",
    "stream_raw",
    "stream_staged",
]
