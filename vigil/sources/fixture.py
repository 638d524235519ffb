"""Raw visit records derived from the driver's ``events`` table.

A deterministic, row-for-row mapping (see FIXTURES.md section 2): every
event becomes one raw visit; most early Mombasa malaria rows are moved to
another county, which creates an onset. Dirty values (padding, blanks, bad
dates, lower case codes, nulls) are planted by ``event_id % 20``. A narrow
projection only: it scales with ``events``, drops no row and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from vigil.functions import json_text
from vigil.schema import VISIT_RAW

# --- fixed values of the fixture ------------------------------------------
# county by user_id % 5
COUNTIES = ("Nairobi", "Mombasa", "Kisumu", "Nakuru", "Eldoret")
# (disease, diagnosis code) by event_type
DISEASES = {
    "click": ("Malaria", "B50"),
    "view": ("Influenza", "J10"),
    "purchase": ("Cholera", "A00"),
    "signup": ("Typhoid", "A01"),
    "error": ("Measles", "B05"),
}
# hospital suffix by user_id % 4
HOSPITAL_SUFFIXES = (" North Ward", " South Ward", " Dispensary", " Day Clinic")
# Onset: Mombasa malaria before this date stays there only where event_id % 10 == 1, else it is elsewhere.
ONSET_COUNTY, ONSET_DISEASE, ONSET_DATE, ELSEWHERE = "Mombasa", "Malaria", "2024-01-15", "Kilifi"
# Extra messages, planted by event_id % 50, next to every visit's own: six that are no visit, and the visit again in an array.
EXTRA_MESSAGES = {5: "trailing", 11: "truncated", 23: "number", 29: "double", 37: "blank", 41: "array", 47: "null"}
# ---------------------------------------------------------------------------


def _sql_text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _lookup(keys_values, key_sql: str) -> str:
    """``try_element_at`` on a literal map: null for a key outside the map (like a CASE)."""
    pairs = ", ".join(f"{k if isinstance(k, int) else _sql_text(k)}, {v}" for k, v in keys_values)
    return f"try_element_at(map({pairs}), {key_sql})"


_COUNTY = _lookup([(i, _sql_text(c)) for i, c in enumerate(COUNTIES)], "user_id % 5")
_SUFFIX = _lookup([(i, _sql_text(h)) for i, h in enumerate(HOSPITAL_SUFFIXES)], "user_id % 4")
_DISEASE = _lookup(
    [(k, f"named_struct('name', {_sql_text(d)}, 'code', {_sql_text(c)})") for k, (d, c) in DISEASES.items()],
    "event_type",
)


def raw_visits(events: DataFrame, keep_event_id: bool = False) -> DataFrame:
    """Raw visits (all text, canonical column order) from ``events``.

    Lookups are literal maps and each derived value is computed once, which
    keeps the generated code small enough for the JIT even after Catalyst
    inlines it into the cleansing filters.
    """
    base = events.selectExpr(
        "event_id",
        "event_id % 20 AS _m",
        f"{_COUNTY} AS _home",
        f"{_DISEASE} AS _dc",
        f"{_SUFFIX} AS _suffix",
        "CAST(CAST(ts AS DATE) AS STRING) AS _d",
        "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00') AS event_time_utc",
    ).withColumn("_county", F.expr(
        f"CASE WHEN _m = 12 THEN NULL WHEN _home = {_sql_text(ONSET_COUNTY)} AND _dc.name = {_sql_text(ONSET_DISEASE)} "
        f"AND _d < {_sql_text(ONSET_DATE)} AND event_id % 10 <> 1 THEN {_sql_text(ELSEWHERE)} ELSE _home END"
    ))
    cols = [
        "CASE _m WHEN 0 THEN NULL WHEN 5 THEN '' "
        "ELSE concat('pt', CAST(event_id AS STRING)) END AS patient_id",
        "concat(_county, _suffix) AS hospital",
        "CASE _m WHEN 8 THEN concat('  ', _county, ' ') ELSE _county END AS county",
        "CASE _m WHEN 2 THEN 'not-a-date' WHEN 4 THEN NULL WHEN 7 THEN concat(' ', _d, ' ') "
        "WHEN 9 THEN '2024-1-5' ELSE _d END AS visit_date",
        "CASE _m WHEN 3 THEN NULL ELSE _dc.name END AS disease",
        "CASE _m WHEN 1 THEN concat(' ', _dc.code, '  ') WHEN 6 THEN lower(_dc.code) ELSE _dc.code END "
        "AS diagnosis_code",
        "event_time_utc",
    ]
    return base.selectExpr(*(["event_id"] if keep_event_id else []), *cols)


_EXTRA_SQL = {
    "trailing": "concat(_valid, ' x')",
    "double": "concat(_valid, ' ', _valid)",
    "truncated": "substring(_valid, 1, length(_valid) - 1)",
    "number": "CAST(event_id AS STRING)",
    "blank": "''",
    "array": "concat('[', _valid, ']')",
    "null": "'null'",
}


def visit_messages(events: DataFrame) -> DataFrame:
    """Topic stand-in: one JSON message (``value``) per raw visit, plus extra ones.

    Every raw visit is encoded; in addition, rows picked by
    ``event_id % 50`` emit one more message each: an object with text after
    it or with another one, a truncated one, a bare number, a blank,
    ``null``, or an array that holds the visit again. One
    scan, one ``explode``, no shuffle.
    """
    raw = raw_visits(events, keep_event_id=True)
    valid = json_text(*[F.col(f.name) for f in VISIT_RAW.fields])
    whens = " ".join(f"WHEN {k} THEN {_EXTRA_SQL[kind]}" for k, kind in EXTRA_MESSAGES.items())
    return (
        raw.select("event_id", valid.alias("_valid"))
        .selectExpr(f"explode(array(_valid, CASE event_id % 50 {whens} END)) AS value")
        .filter("value IS NOT NULL")
    )


# The events columns the fixture reads (an explicit read schema: no footer
# inference on the driver, and only these columns are decoded).
EVENTS_READ = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
])


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_READ).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def load_raw_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_visits(read_events(spark, sf_dir))


def load_visit_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visit_messages(read_events(spark, sf_dir))
