"""Sources: zone files, JSON messages, the topic, the catalog table, the events-derived fixture."""

from vigil.sources.catalog import (
    create_schema,
    list_catalogs,
    list_databases,
    list_tables,
    refresh_table,
    register_table,
    scan_table,
)
from vigil.sources.files import EmptyZoneError, read_cleansed_csv, read_csv, read_curated, read_jsonl, read_outcomes, require_files
from vigil.sources.fixture import load_raw_visits, load_visit_messages, raw_visits, visit_messages
from vigil.sources.messages import message_quality, parse_messages, valid_messages
from vigil.sources.topic import read_message_files, read_raw_stream, read_topic, topic_options

__all__ = [
    "EmptyZoneError",
    "create_schema",
    "list_catalogs",
    "list_databases",
    "list_tables",
    "load_raw_visits",
    "load_visit_messages",
    "message_quality",
    "parse_messages",
    "raw_visits",
    "read_cleansed_csv",
    "read_csv",
    "read_curated",
    "read_jsonl",
    "read_message_files",
    "read_outcomes",
    "read_raw_stream",
    "read_topic",
    "refresh_table",
    "register_table",
    "require_files",
    "scan_table",
    "topic_options",
    "valid_messages",
    "visit_messages",
]
