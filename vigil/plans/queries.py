"""Registered queries: ``(spark, sf_dir) -> DataFrame``, one per inventory item.

Every query starts from the whole ``events`` table of ``sf_dir`` (through
the fixture mapping), so its work grows with the data. Write-then-read
queries use a fresh folder under the session's shared work root.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vigil.config import VALID_CODES
from vigil.operators import (
    cleanse,
    daily_counts,
    drop_missing,
    keep_valid_codes,
    lag_rolling_cases,
    outbreaks,
    parse_visit_date,
    quality,
    rolling_cases,
    trim_fields,
)
from vigil.plans.batch import cleanse_csv_zone, cleanse_jsonl_zone, curate_zone, load_direct
from vigil.plans.incremental_report import refresh_report
from vigil.schema import MESSAGE_TEXT, REPORT, VISIT_CLEANSED, VISIT_RAW
from vigil.session import work_dir
from vigil.sinks.files import encode_json, write_csv, write_curated, write_lines, write_report_csv
from vigil.sources.catalog import (
    create_schema,
    list_catalogs,
    list_databases,
    list_tables,
    register_table,
    scan_table,
)
from vigil.sources.files import read_cleansed_csv, read_csv, read_curated, read_jsonl, read_outcomes
from vigil.sources.fixture import raw_visits, read_events, visit_messages
from vigil.sources.messages import message_quality, valid_messages
from vigil.sources.topic import read_message_files, read_raw_stream
from vigil.streaming.incremental import incremental_csv, incremental_jsonl
from vigil.streaming.ingest import QUALITY_METRICS, run_to_end, stream_curate, stream_raw
from vigil.streaming.metrics import FlushMetrics, read_metrics
from vigil.streaming.staged import (
    Zones,
    lane_of,
    read_staged_cleansed,
    read_staged_raw,
    stage_batch,
    stream_staged,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed report date for the dated report folder of the report_csv query.
REPORT_DATE = _dt.date(2024, 1, 31)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, sf_dir)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_visits(_events(spark, sf_dir))


def _cleansed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(_raw(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visit_messages(_events(spark, sf_dir))


# --- report ----------------------------------------------------------------

def outbreak_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbreaks(_cleansed(spark, sf_dir))


def daily_case_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_counts(_cleansed(spark, sf_dir))


def rolling_cases_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_cases(daily_counts(_cleansed(spark, sf_dir)))


def lag_rolling_cases_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag_rolling_cases(rolling_cases(daily_counts(_cleansed(spark, sf_dir))))


# --- cleansing rules ---------------------------------------------------------

def trim_fields_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_fields(_raw(spark, sf_dir))


def drop_missing_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_missing(trim_fields(_raw(spark, sf_dir)))


def parse_visit_date_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_visit_date(drop_missing(trim_fields(_raw(spark, sf_dir))))


def valid_code_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid_codes(parse_visit_date(drop_missing(trim_fields(_raw(spark, sf_dir)))))


def conform_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits arriving without a ``hospital`` column: conform adds it as null."""
    return cleanse(_raw(spark, sf_dir).drop("hospital"))


def cleanse_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before / after / removed per source; the trimmed county stands in for the file."""
    return quality(_raw(spark, sf_dir), by=F.trim(F.col("county")))


# --- sources and sinks -------------------------------------------------------

def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleansed visits through a CSV round trip (``''`` comes back as null)."""
    path = f"{work_dir(spark, 'csv_scan')}/cleansed"
    write_csv(_cleansed(spark, sf_dir), path)
    return read_cleansed_csv(spark, path)


def zone_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat ``*.csv`` listing of a raw zone that also holds other files and a sub folder."""
    zone = f"{work_dir(spark, 'zone_scan')}/raw"
    raw = _raw(spark, sf_dir)
    write_csv(raw, zone, keep_padding=True)
    counts = quality(raw, by="county")  # other files, which the listing must leave out
    write_csv(counts, f"{zone}/archive")  # in a sub folder
    write_lines(encode_json(counts), zone, mode="append")  # .txt
    return read_csv(spark, zone, suffixes=("csv",), recursive=False)


def csv_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone with files of three layouts, read by their own headers: canonical, reversed, and 72 columns wide with
    names in upper case."""
    zone = f"{work_dir(spark, 'csv_by_header')}/raw"
    raw = raw_visits(_events(spark, sf_dir), keep_event_id=True)
    names = [f.name for f in VISIT_RAW]
    write_csv(raw.filter("event_id % 2 = 0").select(*names), zone, keep_padding=True)
    write_csv(raw.filter("event_id % 4 = 1").select(*names[-2::-1]), zone, mode="append", keep_padding=True)
    fill = [F.lit("0").alias(f"note_{i}") for i in range(66)]
    write_csv(raw.filter("event_id % 4 = 3").select(*fill, *[F.col(n).alias(n.upper()) for n in names[:-1]]), zone,
              mode="append", keep_padding=True)
    return read_csv(spark, zone, by_header=True)


def per_file_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that lack a key (CSV without codes, CSV without dates, JSON without diseases) through cleanse and curate."""
    work = work_dir(spark, "per_file_guard")
    visits = raw_visits(_events(spark, sf_dir), keep_event_id=True)
    no_code, no_date, no_disease, whole = [visits.filter(F.col("event_id") % 4 == k).drop("event_id") for k in range(4)]
    write_csv(no_code.drop("diagnosis_code"), f"{work}/raw", keep_padding=True)
    write_csv(no_date.drop("visit_date"), f"{work}/raw", mode="append", keep_padding=True)
    write_lines(encode_json(no_disease.drop("disease")), f"{work}/raw/lines")
    write_lines(encode_json(whole), f"{work}/raw/lines", mode="append")
    cleanse_csv_zone(spark, f"{work}/raw", f"{work}/cleansed")
    cleanse_jsonl_zone(spark, f"{work}/raw", f"{work}/cleansed", suffixes=("txt",))
    curate_zone(spark, f"{work}/cleansed", f"{work}/curated")
    return read_curated(spark, f"{work}/curated")


def rejects_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cleansing removed: the rows as they came, or the message text, with the reason."""
    work = work_dir(spark, "rejects_zone")
    write_lines(_messages(spark, sf_dir), f"{work}/raw")
    cleanse_jsonl_zone(spark, f"{work}/raw", f"{work}/cleansed", suffixes=("txt",))
    rows = read_outcomes(spark, f"{work}/cleansed/jsonl").filter("outcome <> 'kept'")
    return rows.withColumnRenamed(MESSAGE_TEXT, "message").drop("source")


def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines (objects, arrays and broken ones) in nested folders, read recursively."""
    zone = f"{work_dir(spark, 'jsonl_scan')}/raw"
    write_lines(_messages(spark, sf_dir), f"{zone}/2024/01")
    return read_jsonl(spark, zone, suffixes=None, recursive=True)


def message_quality_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages received, valid and invalid, and the visits in the valid ones."""
    return message_quality(_messages(spark, sf_dir))


def code_table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleansing against a code table (with repeated and null codes) instead of a list."""
    table = spark.createDataFrame([(c,) for c in (*VALID_CODES, VALID_CODES[0], None)], "code string")
    return cleanse(_raw(spark, sf_dir), table)


def valid_json_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_messages(_messages(spark, sf_dir)).select("value")


def publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message each raw visit is published as."""
    return encode_json(_raw(spark, sf_dir))


def curate_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark, 'curate_parquet')}/curated"
    write_curated(_cleansed(spark, sf_dir), path, "all")
    return read_curated(spark, path)


def mixed_lanes_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One curated zone fed by every lane: CSV, JSON lines, the stream and a late batch load, none losing another's rows."""
    work = work_dir(spark, "mixed_lanes_scan")
    raw, cleansed, curated = f"{work}/raw", f"{work}/cleansed", f"{work}/curated"
    visits = raw_visits(_events(spark, sf_dir), keep_event_id=True)
    by_lane = [visits.filter(F.col("event_id") % 4 == k).drop("event_id") for k in range(4)]
    run_to_end(stream_curate(_landed(spark, encode_json(by_lane[2]), f"{work}/landing"), curated, f"{work}/_checkpoint"))
    write_csv(by_lane[0], f"{raw}/csv", keep_padding=True)
    cleanse_csv_zone(spark, f"{raw}/csv", cleansed)
    write_lines(encode_json(by_lane[1]), f"{raw}/lines")
    cleanse_jsonl_zone(spark, f"{raw}/lines", cleansed, suffixes=("txt",))
    curate_zone(spark, cleansed, curated)
    load_direct(by_lane[3], curated, "late")
    curate_zone(spark, cleansed, curated)  # a repeated run replaces its own load only
    load_direct(by_lane[3], curated, "late")
    return read_curated(spark, curated)


def lanes_count_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that a stream landed, offered to the batch lane and to the curate stream: one of them takes each file."""
    work = work_dir(spark, "lanes_count_once")
    raw, cleansed, curated, checkpoints = f"{work}/raw", f"{work}/cleansed", f"{work}/curated", f"{work}/_checkpoints"
    run_to_end(stream_raw(_landed(spark, _messages(spark, sf_dir), f"{work}/landing"), f"{raw}/stream", f"{checkpoints}/raw"))
    for _ in range(2):
        cleanse_jsonl_zone(spark, raw, cleansed)
        curate_zone(spark, cleansed, curated)
        run_to_end(stream_curate(read_raw_stream(spark, raw, f"{checkpoints}/curate"), curated, f"{checkpoints}/curate"))
    return read_curated(spark, curated)


def replaced_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that are replaced as units: one by other rows, one by a run that fails inside its write and leaves it."""
    work = work_dir(spark, "replaced_load")
    visits = raw_visits(_events(spark, sf_dir), keep_event_id=True)
    by_lane = [visits.filter(F.col("event_id") % 4 == k).drop("event_id") for k in range(4)]
    write_csv(by_lane[0], f"{work}/raw", keep_padding=True)
    cleanse_csv_zone(spark, f"{work}/raw", f"{work}/cleansed")
    curate_zone(spark, f"{work}/cleansed", f"{work}/curated")
    load_direct(by_lane[3], f"{work}/curated", "daily")
    load_direct(by_lane[1], f"{work}/curated", "daily")
    load_direct(by_lane[2], f"{work}/curated", "kept")
    broken = by_lane[1].withColumn("county", F.raise_error(F.lit("a planted failure")).cast("string"))
    try:
        load_direct(broken, f"{work}/curated", "kept")
    except SparkRuntimeException as e:
        if "a planted failure" not in str(e):
            raise
    return read_curated(spark, f"{work}/curated")


def incremental_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of CSV files and one of JSON lines, each taken once by lanes that are run after every delivery."""
    work = work_dir(spark, "incremental_lanes")
    raw, cleansed, curated, checkpoints = f"{work}/raw", f"{work}/cleansed", f"{work}/curated", f"{work}/_checkpoints"
    visits = raw_visits(_events(spark, sf_dir), keep_event_id=True)
    by_delivery = [visits.filter(F.col("event_id") % 3 == k).drop("event_id") for k in range(3)]
    for delivery in (0, 1):
        write_csv(by_delivery[delivery], raw, mode="append", keep_padding=True)
        if delivery:
            write_lines(encode_json(by_delivery[2]), f"{raw}/lines")
        run_to_end(incremental_csv(spark, raw, cleansed, curated, f"{checkpoints}/csv"))
        run_to_end(incremental_jsonl(spark, raw, cleansed, curated, f"{checkpoints}/jsonl", suffixes=("txt",)))
    return read_curated(spark, curated)


def incremental_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report brought up to date after each of three loads."""
    work = work_dir(spark, "incremental_report")
    visits = cleanse(raw_visits(_events(spark, sf_dir), keep_event_id=True).withColumnRenamed("event_id", "source"),
                     schema=StructType([*VISIT_CLEANSED.fields, StructField("source", LongType())]))
    for k in range(3):
        write_curated(visits.filter(F.col("source") % 3 == k).drop("source"), f"{work}/curated", f"load{k}")
        report = refresh_report(spark, f"{work}/curated", f"{work}/state")
    return report


def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"{work_dir(spark, 'report_csv')}/reports"
    path = write_report_csv(outbreaks(_cleansed(spark, sf_dir)), base, REPORT_DATE)
    return spark.read.schema(REPORT).option("header", "true").csv(path)


def _curated_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    work = work_dir(spark, name)
    write_curated(_cleansed(spark, sf_dir), f"{work}/curated", "all")
    # A database of the run's own, in the work folder: no table that a job uses is ever touched.
    database = f"vigil_query_{work.rsplit('-', 1)[1]}"
    create_schema(spark, database, f"{work}/warehouse")
    return register_table(spark, f"{work}/curated", database)


def external_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT * ... LIMIT 10`` on the table, sorted so it has one answer."""
    table = _curated_table(spark, sf_dir, "external_table_scan")
    return scan_table(spark, table).orderBy("patient_id", "event_time_utc", "hospital").limit(10)


def table_outbreak_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as the report job runs it: over the table of the curated zone."""
    table = _curated_table(spark, sf_dir, "table_outbreak_report")
    return outbreaks(scan_table(spark, table))


def catalog_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the listing calls show (catalogs, the run's database, its tables), and what the table holds."""
    table = _curated_table(spark, sf_dir, "catalog_listing")
    database, name = table.replace("`", "").split(".")
    listed = [("catalog", c) for c in list_catalogs(spark)]
    listed += [("database", "of this run") for d in list_databases(spark) if d == database]
    listed += [("table", t) for t in list_tables(spark, database)]
    # Few rows (one a date and county) are left before the two distinct counts.
    few = spark.table(table).groupBy("visit_date", "county").agg(F.count(F.lit(1)).alias("n"))
    counts = few.agg(F.sum("n").alias("row_count"), F.size(F.collect_set("visit_date")).cast("long").alias("date_count"),
                     F.size(F.collect_set("county")).cast("long").alias("county_count")).withColumn("_of", F.lit(name))
    rows = spark.createDataFrame(listed, "kind string, name string")
    return rows.join(counts, (F.col("kind") == "table") & (F.col("name") == F.col("_of")), "left").drop("_of")


# --- streaming -----------------------------------------------------------------

def _landed(spark: SparkSession, messages: DataFrame, landing: str) -> DataFrame:
    """The topic stand-in: at least four files, taken two at a time (so two micro-batches or more)."""
    write_lines(messages.repartition(4), landing)
    return read_message_files(spark, landing, max_files_per_trigger=2)


def _stream_to_raw(spark: SparkSession, sf_dir: str, work: str) -> str:
    """The raw zone that the first link of the chain writes; its last micro-batch holds invalid messages only."""
    messages = _messages(spark, sf_dir)
    landing, raw, checkpoint = f"{work}/landing", f"{work}/raw", f"{work}/_checkpoints/raw"
    run_to_end(stream_raw(_landed(spark, messages, landing), raw, checkpoint))
    write_lines(messages.filter("value = 'null'").coalesce(1), landing, mode="append")
    run_to_end(stream_raw(read_message_files(spark, landing), raw, checkpoint))
    return raw


def stream_raw_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message, valid or not, lands in the raw zone exactly once."""
    raw = _stream_to_raw(spark, sf_dir, work_dir(spark, "stream_raw_sink"))
    return spark.read.text(raw)


def stream_curate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw zone -> parse -> cleanse -> curated Parquet as a stream; equals the batch result."""
    work = work_dir(spark, "stream_curate")
    raw = _stream_to_raw(spark, sf_dir, work)
    curated = f"{work}/curated"
    query = stream_curate(read_message_files(spark, raw, max_files_per_trigger=2), curated,
                          f"{work}/_checkpoints/curated")
    run_to_end(query)
    return read_curated(spark, curated)


def stream_staged_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every zone of the staged stream, with a micro-batch staged again in between, which adds nothing."""
    work = work_dir(spark, "stream_staged")
    zones = Zones(f"{work}/raw", f"{work}/cleansed", f"{work}/curated", f"{work}/flushes")
    checkpoint = f"{work}/_checkpoint"
    run_to_end(stream_staged(_landed(spark, _messages(spark, sf_dir), f"{work}/landing"), zones, checkpoint))
    lane = lane_of(checkpoint)
    spark.read.text(zones.batch(zones.raw, lane, 0)).write.text(f"{work}/replay")
    stage_batch(spark.read.text(f"{work}/replay"), 0, zones, lane)

    def content(df: DataFrame, zone: str) -> DataFrame:
        empty = [F.coalesce(F.col(c), F.lit("")) for c in ("patient_id", "county")]
        return df.select(F.lit(zone).alias("zone"), F.concat_ws(
            "|", *empty, F.col("visit_date").cast("string"), "disease", "diagnosis_code").alias("content"))

    raw = read_staged_raw(spark, zones.raw).select(F.lit("raw").alias("zone"), F.col("value").alias("content"))
    return raw.union(content(read_staged_cleansed(spark, zones.cleansed), "cleansed")).union(
        content(read_curated(spark, zones.curated), "curated"))


def stream_flush_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and cleansing counts of a stream, summed over the rows that its listener left for each flush."""
    work = work_dir(spark, "stream_flush_metrics")
    metrics = FlushMetrics(spark, f"{work}/metrics")
    spark.streams.addListener(metrics)
    try:
        source = _landed(spark, _messages(spark, sf_dir), f"{work}/landing")
        query = run_to_end(stream_curate(source, f"{work}/curated", f"{work}/_checkpoint"))
        metrics.finished(query.runId)
    finally:
        spark.streams.removeListener(metrics)
    counts = ("rows_before", "rows_after", "missing_required", "bad_date", "invalid_code", "invalid_messages")
    told = F.from_json("observed", f"{QUALITY_METRICS} struct<{', '.join(f'{c}: long' for c in counts)}>")
    return read_metrics(spark, f"{work}/metrics").select("events", told[QUALITY_METRICS].alias("q")).agg(
        F.sum("events").alias("events"), *[F.sum(f"q.{c}").alias(c) for c in counts])


QUERIES: dict[str, Query] = {
    "outbreak_report": outbreak_report,
    "trim_fields": trim_fields_q,
    "drop_missing": drop_missing_q,
    "parse_visit_date": parse_visit_date_q,
    "valid_code_filter": valid_code_filter,
    "conform_columns": conform_columns,
    "daily_case_counts": daily_case_counts,
    "rolling_cases": rolling_cases_q,
    "lag_rolling_cases": lag_rolling_cases_q,
    "cleanse_quality": cleanse_quality,
    "code_table_filter": code_table_filter,
    "csv_scan": csv_scan,
    "csv_by_header": csv_by_header,
    "per_file_guard": per_file_guard,
    "rejects_zone": rejects_zone,
    "zone_scan": zone_scan,
    "jsonl_scan": jsonl_scan,
    "valid_json_filter": valid_json_filter,
    "message_quality": message_quality_q,
    "publish_json": publish_json,
    "curate_parquet": curate_parquet,
    "mixed_lanes_scan": mixed_lanes_scan,
    "lanes_count_once": lanes_count_once,
    "replaced_load": replaced_load,
    "incremental_lanes": incremental_lanes,
    "incremental_report": incremental_report,
    "report_csv": report_csv,
    "external_table_scan": external_table_scan,
    "table_outbreak_report": table_outbreak_report,
    "catalog_listing": catalog_listing,
    "stream_raw_sink": stream_raw_sink,
    "stream_curate": stream_curate_q,
    "stream_staged": stream_staged_q,
    "stream_flush_metrics": stream_flush_metrics,
}
