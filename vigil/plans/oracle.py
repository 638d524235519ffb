"""DuckDB SQL that states, independently of Spark, what each query must return.

Built from CTE fragments over the pre-registered ``events`` view. DuckDB
differs from Spark in three places, handled here: its date cast accepts
``2024-1-5`` (guarded with a full-match pattern), it rejects a window nested
in ``LAG`` (two steps), and ``SUM`` of bigint is HUGEINT (cast back).
"""

from __future__ import annotations

# --- fixed values repeated in SQL (same as vigil.sources.fixture / config) --
_RAW_VISITS = """
fx_base AS (
    SELECT
        event_id,
        CASE WHEN event_id % 20 = 12 THEN NULL
             WHEN user_id % 5 = 1 AND event_type = 'click' AND CAST(CAST(ts AS DATE) AS VARCHAR) < '2024-01-15'
                  AND event_id % 10 <> 1 THEN 'Kilifi'
             ELSE CASE user_id % 5 WHEN 0 THEN 'Nairobi' WHEN 1 THEN 'Mombasa' WHEN 2 THEN 'Kisumu'
                         WHEN 3 THEN 'Nakuru' WHEN 4 THEN 'Eldoret' END END AS b_county,
        CASE event_type WHEN 'click' THEN 'Malaria' WHEN 'view' THEN 'Influenza' WHEN 'purchase' THEN 'Cholera'
                        WHEN 'signup' THEN 'Typhoid' WHEN 'error' THEN 'Measles' END AS b_disease,
        CASE event_type WHEN 'click' THEN 'B50' WHEN 'view' THEN 'J10' WHEN 'purchase' THEN 'A00'
                        WHEN 'signup' THEN 'A01' WHEN 'error' THEN 'B05' END AS b_code,
        CASE user_id % 4 WHEN 0 THEN ' North Ward' WHEN 1 THEN ' South Ward' WHEN 2 THEN ' Dispensary'
                         WHEN 3 THEN ' Day Clinic' END AS b_suffix,
        CAST(CAST(ts AS DATE) AS VARCHAR) AS d,
        event_id % 20 AS m,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time_utc
    FROM events
),
raw_visits_id AS (
    SELECT
        event_id,
        CASE WHEN m = 0 THEN NULL WHEN m = 5 THEN ''
             ELSE 'pt' || CAST(event_id AS VARCHAR) END AS patient_id,
        b_county || b_suffix AS hospital,
        CASE WHEN m = 8 THEN '  ' || b_county || ' ' ELSE b_county END AS county,
        CASE WHEN m = 2 THEN 'not-a-date' WHEN m = 4 THEN NULL WHEN m = 7 THEN ' ' || d || ' '
             WHEN m = 9 THEN '2024-1-5' ELSE d END AS visit_date,
        CASE WHEN m = 3 THEN NULL ELSE b_disease END AS disease,
        CASE WHEN m = 1 THEN ' ' || b_code || '  ' WHEN m = 6 THEN lower(b_code) ELSE b_code END AS diagnosis_code,
        event_time_utc
    FROM fx_base
)"""

_COLS = "patient_id, hospital, county, visit_date, disease, diagnosis_code, event_time_utc"
_EACH = f"raw_visits AS (SELECT {_COLS} FROM raw_visits_id)"
# The visits of all valid messages: every visit's own, and those that come again in an array.
_IN_MESSAGES = f"""
raw_visits AS (
    SELECT {_COLS} FROM raw_visits_id UNION ALL SELECT {_COLS} FROM raw_visits_id WHERE event_id % 50 = 41
)"""
# Visits by lane: a CSV hop turns '' into null (before cleansing, and after it), the others keep it.
_LANES = """
raw_visits AS (
    SELECT CASE WHEN event_id % 4 = 0 THEN NULLIF(patient_id, '') ELSE patient_id END AS patient_id,
           hospital, county, visit_date, disease, diagnosis_code, event_time_utc, event_id % 4 AS lane
    FROM raw_visits_id
)"""

_MESSAGES = """
msg_valid AS (
    SELECT event_id,
           CAST(to_json(struct_pack(patient_id := patient_id, hospital := hospital, county := county,
                                    visit_date := visit_date, disease := disease, diagnosis_code := diagnosis_code,
                                    event_time_utc := event_time_utc)) AS VARCHAR) AS v
    FROM raw_visits_id
),
messages AS (
    SELECT v AS value FROM msg_valid
    UNION ALL
    SELECT CASE event_id % 50
               WHEN 5 THEN v || ' x'
               WHEN 11 THEN substr(v, 1, length(v) - 1)
               WHEN 23 THEN CAST(event_id AS VARCHAR)
               WHEN 29 THEN v || ' ' || v
               WHEN 37 THEN ''
               WHEN 41 THEN '[' || v || ']'
               WHEN 47 THEN 'null' END AS value
    FROM msg_valid
    WHERE event_id % 50 IN (5, 11, 23, 29, 37, 41, 47)
)"""

_DATE = "CASE WHEN regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST({v} AS DATE) END"
_CODES = "('B50', 'A00', 'J10', 'A01', 'A90')"

_CLEANSE = f"""
trimmed AS (
    SELECT trim(patient_id) AS patient_id, trim(hospital) AS hospital, trim(county) AS county,
           trim(visit_date) AS visit_date, trim(disease) AS disease, trim(diagnosis_code) AS diagnosis_code,
           event_time_utc
    FROM raw_visits
),
present AS (
    SELECT * FROM trimmed
    WHERE patient_id IS NOT NULL AND disease IS NOT NULL AND diagnosis_code IS NOT NULL AND visit_date IS NOT NULL
),
dated AS (
    SELECT patient_id, hospital, county, {_DATE.format(v='visit_date')} AS visit_date,
           disease, diagnosis_code, event_time_utc
    FROM present
),
parsed AS (SELECT * FROM dated WHERE visit_date IS NOT NULL),
cleansed AS (SELECT * FROM parsed WHERE diagnosis_code IN {_CODES})"""

_REPORT = """
daily AS (
    SELECT county, disease, visit_date, COUNT(*) AS cases FROM cleansed GROUP BY county, disease, visit_date
),
rolled AS (
    SELECT county, disease, visit_date, cases,
           CAST(SUM(cases) OVER (PARTITION BY county, disease ORDER BY visit_date
                                 ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS cases_last_7_days
    FROM daily
),
lagged AS (
    SELECT *, LAG(cases_last_7_days) OVER (PARTITION BY county, disease ORDER BY visit_date) AS prev_7_day
    FROM rolled
),
report AS (
    SELECT county, disease, visit_date, cases_last_7_days FROM lagged
    WHERE prev_7_day IS NOT NULL AND cases_last_7_days > prev_7_day * 1.5
)"""
# ---------------------------------------------------------------------------

_CURATED_COLS = ("patient_id, hospital, county, visit_date, disease, diagnosis_code, "
                 "CAST(event_time_utc AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS event_time_utc")
# Lane 1 has its CSV hop after cleansing.
_LANE_ID = "CASE WHEN lane = 1 THEN NULLIF(patient_id, '') ELSE patient_id END AS patient_id"
_LANE_KEPT = "CASE WHEN lane = 0 THEN NULLIF(patient_id, '') ELSE patient_id END AS patient_id"
# The first two thirds come as CSV files, where '' is null, the rest as JSON lines.
_BLANK_CSV = f"""
raw_visits AS (
    SELECT {_COLS.replace('patient_id', "CASE WHEN event_id % 3 < 2 THEN NULLIF(patient_id, '') ELSE patient_id END AS patient_id", 1)}
    FROM raw_visits_id
)"""
_EVEN_TIMES = """
raw_visits AS (
    SELECT patient_id, hospital, county, visit_date, disease, diagnosis_code,
           CASE WHEN event_id % 2 = 0 THEN event_time_utc END AS event_time_utc
    FROM raw_visits_id
)"""
# Files that lack a key, by event_id % 4: CSV without the code, CSV without the date, JSON without the disease, whole JSON.
_GUARDED = f"""
given AS (
    SELECT event_id % 4 AS k, CASE WHEN event_id % 4 < 2 THEN NULLIF(trim(patient_id), '') ELSE trim(patient_id) END AS patient_id,
           trim(hospital) AS hospital, trim(county) AS county, {_DATE.format(v='trim(visit_date)')} AS visit_date,
           trim(disease) AS disease, trim(diagnosis_code) AS diagnosis_code, event_time_utc
    FROM raw_visits_id
),
guarded AS (
    SELECT NULLIF(patient_id, '') AS patient_id, hospital, county, CASE WHEN k <> 1 THEN visit_date END AS visit_date,
           CASE WHEN k <> 2 THEN disease END AS disease, CASE WHEN k <> 0 THEN diagnosis_code END AS diagnosis_code,
           event_time_utc
    FROM given
    WHERE patient_id IS NOT NULL AND (k = 1 OR visit_date IS NOT NULL) AND (k = 2 OR disease IS NOT NULL)
      AND (k = 0 OR diagnosis_code IN {_CODES})
)"""
_REPORT_ORDER = "ORDER BY visit_date NULLS LAST, county NULLS LAST, disease NULLS LAST"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_REASON = f"""
CASE WHEN patient_id IS NULL OR disease IS NULL OR diagnosis_code IS NULL OR visit_date IS NULL THEN 'missing_required'
     WHEN {_DATE.format(v='trim(visit_date)')} IS NULL THEN 'bad_date'
     WHEN trim(diagnosis_code) NOT IN {_CODES} THEN 'invalid_code' END"""

_NULLIF = ("NULLIF(patient_id, '') AS patient_id, NULLIF(hospital, '') AS hospital, NULLIF(county, '') AS county, "
           "NULLIF(visit_date, '') AS visit_date, NULLIF(disease, '') AS disease, "
           "NULLIF(diagnosis_code, '') AS diagnosis_code, NULLIF(event_time_utc, '') AS event_time_utc")


def oracle_sql() -> dict[str, str]:
    base = _with(_RAW_VISITS, _EACH, _CLEANSE)
    report = _with(_RAW_VISITS, _EACH, _CLEANSE, _REPORT)
    from_messages = _with(_RAW_VISITS, _IN_MESSAGES, _CLEANSE)
    lanes = _with(_RAW_VISITS, _LANES, _CLEANSE.replace("event_time_utc\n", "event_time_utc, lane\n"))
    msgs = _with(_RAW_VISITS, _MESSAGES)
    reasons = f"reasons AS (SELECT *, {_REASON} AS reason FROM raw_visits)"
    curated_blank = _CURATED_COLS.replace("patient_id", "NULLIF(patient_id, '') AS patient_id", 1)
    content = ("concat_ws('|', coalesce(NULLIF(patient_id, ''), ''), coalesce(county, ''), CAST(visit_date AS VARCHAR), disease, "
               "diagnosis_code)")
    valid_msgs = "CASE WHEN json_valid(value) THEN json_type(value) IN ('OBJECT', 'ARRAY') ELSE false END"
    return {
        "outbreak_report": f"{report} SELECT * FROM report {_REPORT_ORDER}",
        "trim_fields": f"{base} SELECT * FROM trimmed",
        "drop_missing": f"{base} SELECT * FROM present",
        "parse_visit_date": f"{base} SELECT * FROM parsed",
        "valid_code_filter": f"{base} SELECT * FROM cleansed",
        "conform_columns": (
            f"{base} SELECT patient_id, CAST(NULL AS VARCHAR) AS hospital, county, visit_date, disease, "
            "diagnosis_code, event_time_utc FROM cleansed"
        ),
        "daily_case_counts": f"{report} SELECT * FROM daily",
        "rolling_cases": f"{report} SELECT county, disease, visit_date, cases, cases_last_7_days FROM rolled",
        "lag_rolling_cases": f"{report} SELECT * FROM lagged",
        "cleanse_quality": (
            f"{_with(_RAW_VISITS, _EACH)}, reasons AS (SELECT trim(county) AS source, {_REASON} AS reason FROM raw_visits) "
            "SELECT source, COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE reason IS NULL) AS rows_after, "
            "COUNT(*) FILTER (WHERE reason IS NOT NULL) AS rows_removed, "
            "COUNT(*) FILTER (WHERE reason = 'missing_required') AS missing_required, "
            "COUNT(*) FILTER (WHERE reason = 'bad_date') AS bad_date, "
            "COUNT(*) FILTER (WHERE reason = 'invalid_code') AS invalid_code "
            "FROM reasons GROUP BY source"
        ),
        "csv_scan": (
            f"{base} SELECT NULLIF(patient_id, '') AS patient_id, hospital, county, visit_date, disease, "
            "diagnosis_code, event_time_utc FROM cleansed"
        ),
        "zone_scan": f"{base} SELECT {_NULLIF} FROM raw_visits",
        "jsonl_scan": f"{from_messages} SELECT * FROM raw_visits",
        "valid_json_filter": f"{msgs} SELECT value FROM messages WHERE {valid_msgs}",
        "publish_json": f"{msgs} SELECT v AS value FROM msg_valid",
        "curate_parquet": f"{base} SELECT {_CURATED_COLS} FROM cleansed",
        "report_csv": f"{report} SELECT * FROM report {_REPORT_ORDER}",
        "table_outbreak_report": f"{report} SELECT * FROM report {_REPORT_ORDER}",
        "external_table_scan": (
            f"{base} SELECT {_CURATED_COLS} FROM cleansed "
            "ORDER BY patient_id, event_time_utc, hospital NULLS FIRST LIMIT 10"
        ),
        "catalog_listing": (
            f"{base}, counted AS (SELECT COUNT(*) AS row_count, COUNT(DISTINCT visit_date) AS date_count, "
            "COUNT(DISTINCT county) AS county_count FROM cleansed) "
            "SELECT 'catalog' AS kind, 'spark_catalog' AS name, NULL AS row_count, NULL AS date_count, "
            "NULL AS county_count "
            "UNION ALL SELECT 'database', 'of this run', NULL, NULL, NULL "
            "UNION ALL SELECT 'table', 'patient_visits', row_count, date_count, county_count FROM counted "
            "UNION ALL SELECT 'table', 'patient_visits_batch', NULL, NULL, NULL"
        ),
        "code_table_filter": f"{base} SELECT * FROM cleansed",
        "csv_by_header": (
            f"{_with(_RAW_VISITS, _EVEN_TIMES)} SELECT {_NULLIF} FROM raw_visits"
        ),
        "message_quality": (
            f"{msgs} SELECT COUNT(*) AS messages, COUNT(*) FILTER (WHERE {valid_msgs}) AS valid_messages, "
            f"COUNT(*) FILTER (WHERE NOT {valid_msgs}) AS invalid_messages, "
            f"COUNT(*) FILTER (WHERE {valid_msgs}) AS visits FROM messages"
        ),
        "mixed_lanes_scan": (
            f"{lanes} SELECT {_CURATED_COLS.replace('patient_id', _LANE_ID, 1)} FROM cleansed"
        ),
        "per_file_guard": f"{_with(_RAW_VISITS, _GUARDED)} SELECT {_CURATED_COLS} FROM guarded",
        "lanes_count_once": f"{from_messages} SELECT {curated_blank} FROM cleansed",
        "replaced_load": (
            f"{lanes} SELECT {_CURATED_COLS.replace('patient_id', _LANE_KEPT, 1)} FROM cleansed WHERE lane <> 3"
        ),
        "rejects_zone": (
            f"{_with(_RAW_VISITS, _IN_MESSAGES, _MESSAGES, reasons)} "
            f"SELECT {_NULLIF}, NULL AS message, reason AS outcome FROM reasons WHERE reason IS NOT NULL "
            "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, value, 'invalid_message' FROM messages "
            f"WHERE NOT ({valid_msgs}) AND trim(value) <> ''"
        ),
        "stream_staged": (
            f"{_with(_RAW_VISITS, _IN_MESSAGES, _CLEANSE, _MESSAGES)} SELECT 'raw' AS zone, value AS content FROM messages "
            f"UNION ALL SELECT 'cleansed', {content} FROM cleansed UNION ALL SELECT 'curated', {content} FROM cleansed"
        ),
        "stream_flush_metrics": (
            f"{_with(_RAW_VISITS, _IN_MESSAGES, _MESSAGES, reasons)}, "
            f"dropped AS (SELECT COUNT(*) AS n FROM messages WHERE NOT ({valid_msgs})), "
            "sent AS (SELECT COUNT(*) AS n FROM messages) "
            "SELECT any_value(sent.n) AS events, COUNT(*) + any_value(dropped.n) AS rows_before, "
            "COUNT(*) FILTER (WHERE reason IS NULL) AS rows_after, "
            "COUNT(*) FILTER (WHERE reason = 'missing_required') + any_value(dropped.n) AS missing_required, "
            "COUNT(*) FILTER (WHERE reason = 'bad_date') AS bad_date, "
            "COUNT(*) FILTER (WHERE reason = 'invalid_code') AS invalid_code, any_value(dropped.n) AS invalid_messages "
            "FROM reasons, dropped, sent"
        ),
        "incremental_lanes": (
            f"{_with(_RAW_VISITS, _BLANK_CSV, _CLEANSE)} SELECT {curated_blank} FROM cleansed"
        ),
        "incremental_report": f"{report} SELECT * FROM report {_REPORT_ORDER}",
        "stream_raw_sink": (
            f"{msgs} SELECT value FROM messages "
            "UNION ALL SELECT 'null' AS value FROM raw_visits_id WHERE event_id % 50 = 47"
        ),
        "stream_curate": f"{from_messages} SELECT {_CURATED_COLS} FROM cleansed",
    }
