"""Sinks: zone files, curated Parquet, dated report CSV, topic."""

from vigil.sinks.files import (
    encode_json,
    report_path,
    write_csv,
    write_curated,
    write_jsonl,
    write_lines,
    write_report_csv,
)
from vigil.sinks.topic import write_topic

__all__ = [
    "encode_json",
    "report_path",
    "write_csv",
    "write_curated",
    "write_jsonl",
    "write_lines",
    "write_report_csv",
    "write_topic",
]
