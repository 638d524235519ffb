"""Explicit schemas: raw text in, typed visits out. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampType

from vigil.config import PREFERRED_COLUMNS

# Marks the row that stands for a message that is not valid JSON.
INVALID_MESSAGE = "_invalid_message"
# The text of a message that is not valid JSON.
MESSAGE_TEXT = "_message"
# Keys that the row's file (or micro-batch) lacks altogether, whose rules do not apply: a bit a required column.
ABSENT_KEYS = "_absent_keys"


def _visit(date_type, time_type) -> StructType:
    """The visit columns in their fixed order, text except the two typed ones."""
    typed = {"visit_date": date_type, "event_time_utc": time_type}
    return StructType([StructField(c, typed.get(c, StringType())) for c in PREFERRED_COLUMNS])


# Raw visit as it arrives in CSV files or JSON messages: all text, canonical
# order; the one optional column (event_time_utc) is last, so 6-column CSV
# files read positionally next to 7-column ones get null there.
VISIT_RAW = _visit(StringType(), StringType())

# Cleansed visit: dates parsed, the event time still the text it arrived as.
VISIT_CLEANSED = _visit(DateType(), StringType())

# Curated visit (the external table): event time as an instant.
VISIT = _visit(DateType(), TimestampType())

REPORT = StructType([
    StructField("county", StringType()),
    StructField("disease", StringType()),
    StructField("visit_date", DateType()),
    StructField("cases_last_7_days", LongType()),
])


def ddl(schema: StructType) -> str:
    """Column list for CREATE TABLE."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
