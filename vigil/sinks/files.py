"""File sinks for the zones.

No ``coalesce(1)``: every task writes its own part file, so a write scales
with the cluster. The curated zone is partitioned by ``visit_date`` and
rebalanced first: AQE splits a date that holds a large share of the rows
into several tasks and merges small dates, so each date gets a few files of
the advisory size instead of one file per task and date.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import json_text
from vigil.operators.curation import curate
from vigil.session import path_exists
from vigil.loads import new_version, switch, version_path
from vigil.sources.files import BATCH


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", keep_padding: bool = False) -> str:
    """CSV with a header row. ``keep_padding`` keeps leading/trailing spaces (raw data).

    Note: CSV cannot tell ``''`` from null; both read back as null.
    """
    writer = df.write.mode(mode).option("header", "true")
    if keep_padding:
        writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    writer.csv(path)
    return path


def write_outcomes(df: DataFrame, path: str) -> str:
    """Rows with their ``outcome`` (see ``operators.rules.outcomes``) as CSV, a folder an outcome, in one pass."""
    df.write.mode("overwrite").partitionBy("outcome").option("header", "true").option(
        "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return path


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One JSON object per line, nulls written as ``null``; files end in ``.json``."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def write_lines(df: DataFrame, path: str, column: str = "value", mode: str = "overwrite") -> str:
    """Raw messages, one per line, as they arrived."""
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)
    return path


def write_curated(df: DataFrame, path: str, load: str, rebalance: bool = True) -> str:
    """Curated Parquet partitioned by ``visit_date``, as one load of the zone's batch folder.

    A load written again is replaced as a unit, by a switch after its new
    version is whole (``vigil.loads``): a run that fails leaves the
    earlier rows. No other load, nor the stream's output, is touched. Late
    visits are a new load, whatever their dates. A folder that a stream
    writes to is refused.
    """
    spark = df.sparkSession
    root = f"{path.rstrip('/')}/{BATCH}"
    for owned in (path.rstrip("/"), root):
        if path_exists(spark, f"{owned}/_spark_metadata"):
            raise ValueError(f"{owned} holds a stream's output; a batch load must not write there")
    out = curate(df)
    if rebalance:
        out = out.hint("rebalance", "visit_date")
    version = new_version(load)
    out.write.mode("errorifexists").partitionBy("visit_date").parquet(version_path(root, load, version))
    switch(spark, root, load, version)
    return path


def report_path(base: str, report_date: _dt.date | None = None) -> str:
    """Dated report folder: ``<base>/report_date=YYYYMMDD``."""
    day = report_date or _dt.datetime.now(_dt.timezone.utc).date()
    return f"{base.rstrip('/')}/report_date={day.strftime('%Y%m%d')}"


def write_report_csv(report: DataFrame, base: str, report_date: _dt.date | None = None) -> str:
    """The outbreak report as CSV with a header, one folder per report date."""
    path = report_path(base, report_date)
    report.write.mode("overwrite").option("header", "true").csv(path)
    return path


def encode_json(df: DataFrame) -> DataFrame:
    """Rows as JSON text (``value``), every column kept, nulls written as ``null``."""
    return df.select(json_text(*df.columns).alias("value"))
