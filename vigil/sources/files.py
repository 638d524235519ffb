"""File sources for the zones: CSV, JSON lines and curated Parquet.

One job reads a whole directory; Spark lists the files, splits them into
tasks and keeps the source file per row in ``_metadata.file_path``. Schemas
are always explicit: nothing is inferred per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from vigil.functions import suffix_glob
from vigil.operators.rules import BAD_DATE, INVALID_CODE, KEPT, MISSING_REQUIRED, NOT_JSON, absent_mask, conform
from vigil.schema import ABSENT_KEYS, MESSAGE_TEXT, VISIT, VISIT_CLEANSED, VISIT_RAW
from vigil.session import holds_file, path_exists
from vigil.loads import current_versions, version_path
from vigil.sources.headers import layouts, scan_layout, zone_reader
from vigil.sources.ledger import file_key
from vigil.sources.messages import mark_absent_keys, parse_messages


class EmptyZoneError(RuntimeError):
    """Raised when a zone holds no matching file."""


BATCH, STREAM = "batch", "stream"  # folders of the curated zone, by writer


def _load(what: str, load):
    try:
        return load()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            raise EmptyZoneError(f"no matching file in {what}") from e
        raise


def require_files(spark: SparkSession, path: str, suffixes: Sequence[str] | None, recursive: bool) -> None:
    """Fail fast on a zone without a matching file (files without rows are fine); stops at the first hit."""
    if not holds_file(spark, path, suffix_glob(*suffixes) if suffixes else None, recursive):
        raise EmptyZoneError(f"no matching file in {path}")


def _by_header(spark: SparkSession, path, suffixes, recursive: bool, options: dict[str, str], schema: StructType,
               keep_source: bool, mark_absent: bool) -> DataFrame:
    """Files of any column order and width: one scan a layout, see ``vigil.sources.headers``."""
    names = [f.name for f in schema.fields]
    out = None
    for layout in layouts(spark, path, suffixes, recursive, options, names):
        extra = [F.col("_metadata.file_path").alias("source")] if keep_source else []
        rows = scan_layout(spark, layout, options, schema, extra)
        if mark_absent:
            rows = rows.withColumn(ABSENT_KEYS, F.lit(absent_mask(n for n in names if n not in layout.places)))
        out = rows if out is None else out.union(rows)
    if out is not None:
        return out
    fields = [StructField("source", StringType())] if keep_source else []
    fields += [*schema.fields, *([StructField(ABSENT_KEYS, IntegerType())] if mark_absent else [])]
    return spark.createDataFrame([], StructType(fields))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema=VISIT_RAW,
    suffixes: Sequence[str] | None = ("csv",),
    recursive: bool = False,
    by_header: bool = False,
    options: dict[str, str] | None = None,
    keep_source: bool = False,
    mark_absent: bool = False,
) -> DataFrame:
    """CSV with a header row.

    By default columns are matched by *position* (for files that this
    library wrote: the canonical order puts the one optional column last, so
    6- and 7-column files mix). With ``by_header=True`` every file is read by
    the names in its own header, whatever their order, number and case, as
    text in the schema's columns; ``keep_source`` adds the file's path, and
    ``mark_absent`` the keys that the row's file lacks, which switches their
    rules off. ``options`` go to the CSV reader, e.g. ``{"escape": '"'}`` for
    files that double quotes inside quoted fields (RFC 4180) rather than
    Spark's backslash.
    """
    if by_header:
        return _load(str(path), lambda: _by_header(spark, path, suffixes, recursive, options or {}, schema,
                                                   keep_source, mark_absent))
    reader, paths = zone_reader(spark, path, suffixes, recursive)
    reader = reader.option("header", "true").options(**(options or {}))
    return _load(str(path), lambda: reader.schema(schema).csv(paths))


def read_cleansed_csv(spark: SparkSession, path: str, **kw) -> DataFrame:
    """The cleansed zone: typed visit date, event time still text."""
    return read_csv(spark, path, schema=VISIT_CLEANSED, **kw)


_OUTCOME = StructType([StructField("source", StringType()), StructField(MESSAGE_TEXT, StringType())])


def read_kept(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The cleansed visits of lanes written by ``write_outcomes``; only their ``kept`` folders are listed and read."""
    kept = [f"{p}/outcome={KEPT}" for p in paths if path_exists(spark, f"{p}/outcome={KEPT}")]
    if not kept:
        return spark.createDataFrame([], VISIT_CLEANSED)
    schema = StructType([*VISIT_CLEANSED.fields, *_OUTCOME.fields])
    return spark.read.option("header", "true").schema(schema).csv(kept).select(*VISIT_CLEANSED.fieldNames())


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """A lane written by ``write_outcomes``: all rows as text, with ``source``, the message text and ``outcome``.

    ``outcome`` is a partition column: a filter on it lists and reads the
    folders it needs only. ``outcome <> 'kept'`` is the quarantine.
    """
    schema = StructType([*VISIT_RAW.fields, *_OUTCOME.fields, StructField("outcome", StringType())])
    if not holds_file(spark, path, suffix_glob("csv"), True):
        return spark.createDataFrame([], schema)
    return spark.read.option("header", "true").schema(schema).csv(path)


def outcome_quality(rows: DataFrame) -> DataFrame:
    """Before / after / removed counts per source of rows with an outcome, as ``quality`` gives them from raw rows."""
    def count(*names: str):
        return F.count_if(F.col("outcome").isin(*names))

    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows_before"), count(KEPT).alias("rows_after"),
        F.count_if(F.col("outcome") != KEPT).alias("rows_removed"),
        # A message that is no JSON lacks what is required.
        count(MISSING_REQUIRED, NOT_JSON).alias(MISSING_REQUIRED), count(BAD_DATE).alias(BAD_DATE),
        count(INVALID_CODE).alias(INVALID_CODE))


def read_jsonl(
    spark: SparkSession,
    path: str | Sequence[str],
    suffixes: Sequence[str] | None = ("jsonl", "json"),
    recursive: bool = True,
    keep_source: bool = False,
    mark_invalid: bool = False,
    mark_absent: bool = False,
    keep_message: bool = False,
    only: DataFrame | None = None,
) -> DataFrame:
    """JSON-lines visits: one message per line, blank lines skipped; see ``parse_messages``.

    Read as text and parsed with ``from_json`` against the raw schema, the
    same parse the stream uses, so batch and stream keep the same rows.
    ``mark_absent`` adds the keys that no message of the row's file has,
    which switches their rules off; it costs one more scan of the lines.
    ``only`` (one column, ``file``) restricts the files.
    """
    reader, paths = zone_reader(spark, path, suffixes, recursive)
    lines = _load(str(path), lambda: reader.text(paths))
    lines = lines.select("value", lines["_metadata.file_path"].alias("source")).filter(F.trim("value") != "")
    if only is not None:
        lines = lines.join(only, file_key(F.col("source")) == only["file"], "left_semi")
    kept = ["source"] if keep_source else []
    if mark_absent:
        lines, kept = mark_absent_keys(lines, "source"), [*kept, ABSENT_KEYS]
    return parse_messages(lines, keep=kept, mark_invalid=mark_invalid, keep_message=keep_message)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """The curated zone (Parquet, partitioned by ``visit_date``) in canonical order: batch loads and stream output.

    The stream's folder is read through its sink's commit log, the batch
    folder by the current version of each load. Filters on ``visit_date``
    prune partitions; other filters are pushed to the Parquet reader.
    """
    root = path.rstrip("/")
    parts = []
    versions = current_versions(spark, f"{root}/{BATCH}")
    if versions:
        paths = [version_path(f"{root}/{BATCH}", load, version) for load, version in versions.items()]
        parts.append(spark.read.schema(VISIT).option("basePath", f"{root}/{BATCH}").parquet(*paths))
    if path_exists(spark, f"{root}/{STREAM}"):
        parts.append(spark.read.schema(VISIT).parquet(f"{root}/{STREAM}"))
    if not parts:
        raise EmptyZoneError(f"nothing curated in {path}")
    parts = [conform(p, VISIT) for p in parts]
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])
