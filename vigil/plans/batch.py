"""Batch lanes, each one Spark job over a whole zone.

* cleanse: raw zone (CSV flat, or JSON lines recursive) -> cleansed CSV and quarantined rows, a folder a lane
* curate: every lane's cleansed CSV -> one load of the curated zone -> table refresh
* direct: raw -> a curated load in one pass (no CSV hop, keeps ``''`` values)
* report: table -> outbreak report -> dated CSV

Counts before / after / removed come from observed metrics of the same
pass that writes, not from extra ``count()`` scans. That pass writes every
row with its outcome and source, so counts per file, where asked for, are
read from what was written (and so hold whatever tasks were retried); the
raw zone is not read again for them.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vigil.config import VALID_CODES, LakeConfig
from vigil.functions import suffix_glob
from vigil.operators.report import outbreaks
from vigil.operators.rules import Codes, cleanse_observed, outcomes
from vigil.schema import MESSAGE_TEXT
from vigil.session import holds_file, path_exists
from vigil.sinks.files import write_csv, write_curated, write_outcomes, write_report_csv
from vigil.sources.catalog import refresh_table, register_table, scan_table
from vigil.sources.files import (
    STREAM,
    outcome_quality,
    read_csv,
    read_jsonl,
    read_kept,
    read_outcomes,
    require_files,
)
from vigil.sources.ledger import claim_for_batch


# Folders of the cleansed zone, by lane, and the load that the curate job replaces.
CSV_LANE, JSONL_LANE, CURATE_LOAD = "csv", "jsonl", "cleansed-zone"


@dataclass(frozen=True)
class LoadResult:
    path: str
    rows_before: int
    rows_after: int
    rows_removed: int
    missing_required: int
    bad_date: int
    invalid_code: int
    invalid_messages: int = 0


def _cleanse_and_write(raw: DataFrame, out: str, write, codes: Codes = VALID_CODES) -> LoadResult:
    cleansed, obs = cleanse_observed(raw, codes)
    write(cleansed, out)
    m = obs.get
    return LoadResult(out, m["rows_before"], m["rows_after"], m["rows_removed"], m["missing_required"],
                      m["bad_date"], m["invalid_code"], m.get("invalid_messages", 0))


def _lane(path: str, lane: str) -> str:
    return f"{path.rstrip('/')}/{lane}"


def cleanse_lane(raw: DataFrame, out: str, codes: Codes = VALID_CODES, quality_path: str | None = None) -> LoadResult:
    """One lane: rows (with their source) -> kept and quarantined rows, a folder an outcome; counts per file if asked for."""
    spark = raw.sparkSession
    if MESSAGE_TEXT not in raw.columns:
        raw = raw.withColumn(MESSAGE_TEXT, F.lit(None).cast("string"))
    obs = Observation("cleanse_quality")
    columns = [*[c for c in raw.columns if c not in ("source", MESSAGE_TEXT)], "source", MESSAGE_TEXT]
    write_outcomes(outcomes(raw.select(*columns), codes, obs), out)
    m = obs.get
    if quality_path:
        write_csv(outcome_quality(read_outcomes(spark, out)), quality_path)
    return LoadResult(out, m["rows_before"], m["rows_after"], m["rows_removed"], m["missing_required"],
                      m["bad_date"], m["invalid_code"], m.get("invalid_messages", 0))


def cleanse_csv_zone(spark: SparkSession, raw_path: str, cleansed_path: str, codes: Codes = VALID_CODES,
                     quality_path: str | None = None, csv_options: dict[str, str] | None = None) -> LoadResult:
    """Flat ``*.csv`` (any case) in the raw zone -> the cleansed zone's CSV lane.

    Columns are matched by the names in each file's own header; the rules of
    keys that a file's header lacks do not apply to its rows.
    """
    require_files(spark, raw_path, ("csv",), False)
    raw = read_csv(spark, raw_path, suffixes=("csv",), by_header=True, options=csv_options, keep_source=True,
                   mark_absent=True)
    return cleanse_lane(raw, _lane(cleansed_path, CSV_LANE), codes, quality_path and _lane(quality_path, CSV_LANE))


def cleanse_jsonl_zone(spark: SparkSession, raw_path: str, cleansed_path: str,
                       suffixes=("jsonl",), codes: Codes = VALID_CODES,
                       quality_path: str | None = None) -> LoadResult:
    """Every ``*.jsonl`` below the raw zone, and the lines that ``stream_raw`` wrote there -> the JSON lane.

    The stream's folder is read plainly, which Spark serves from the sink's
    commit log, so files of a failed micro-batch are never read; of its
    files only those that this lane owns (``vigil.sources.ledger``). Rows
    before count the visits of valid messages, and one for each that is not.
    The rules of keys that no message of a file has do not apply to its rows.
    """
    streamed = _lane(raw_path, STREAM)
    options = {"keep_source": True, "mark_invalid": True, "mark_absent": True, "keep_message": True}
    parts = []
    if path_exists(spark, f"{streamed}/_spark_metadata"):
        owned = claim_for_batch(spark, raw_path, streamed)
        parts.append(read_jsonl(spark, streamed, suffixes=None, recursive=False, **options, only=(
            spark.createDataFrame([], "file string") if owned is None else owned)))
    if not parts or holds_file(spark, raw_path, suffix_glob(*suffixes) if suffixes else None, True):
        require_files(spark, raw_path, suffixes, True)
        parts.append(read_jsonl(spark, raw_path, suffixes=suffixes, **options))
    raw = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    return cleanse_lane(raw, _lane(cleansed_path, JSONL_LANE), codes, quality_path and _lane(quality_path, JSONL_LANE))


def curate_zone(spark: SparkSession, cleansed_path: str, curated_path: str, table: str | None = None) -> str:
    """The batch lanes of the cleansed zone -> one load of the curated zone; refresh the table if named.

    The load is the same each time, so a repeated run replaces what the last
    one wrote, and nothing else. Lanes that curate their own batches (the
    staged stream, the incremental lanes) are not read.
    """
    require_files(spark, cleansed_path, ("csv",), True)
    kept = read_kept(spark, [_lane(cleansed_path, lane) for lane in (CSV_LANE, JSONL_LANE)])
    write_curated(kept, curated_path, CURATE_LOAD)
    if table:
        refresh_table(spark, table)
    return curated_path


def load_direct(raw: DataFrame, curated_path: str, load: str | None = None, codes: Codes = VALID_CODES) -> LoadResult:
    """Raw visits -> cleansed -> curated Parquet in one pass, as a load of its own.

    A load named again is replaced as a unit; without a name it is a new one,
    so late visits are added to their dates.
    """
    name = load or uuid.uuid4().hex
    return _cleanse_and_write(raw, curated_path, lambda df, path: write_curated(df, path, name), codes)


def daily_report(spark: SparkSession, cfg: LakeConfig, out_base: str,
                 report_date: _dt.date | None = None) -> str:
    """Outbreak report over the whole table, written as a dated CSV folder."""
    register_table(spark, cfg.curated_path, cfg.database, cfg.table)
    report = outbreaks(scan_table(spark, cfg.table_name), cfg.window_rows, cfg.growth_factor)
    return write_report_csv(report, out_base, report_date)
