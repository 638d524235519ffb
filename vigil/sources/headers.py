"""Layouts of headed CSV files: which file has its columns where.

An index of header lines comes first. Small files are read through (they
cost their opening anyway) and only their first line is kept; a larger file
is one task that reads its first lines and stops, so the index costs a task a
large file whatever its size. Files with the same columns in the same places
are one layout, and each layout is one scan with its own header as schema:
no limit of width, no join of rows with headers.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vigil.functions import suffix_glob

SMALL_FILE_BYTES = 32 << 20  # files up to this size are read through to index them
_WHOLE = str(1 << 50)  # split size and opening cost that make every file one task of its own


@dataclass
class Layout:
    """Files whose headers have the same width and the wanted names in the same places."""

    width: int
    places: dict[str, int]
    files: list[str] = field(default_factory=list)


def zone_reader(spark: SparkSession, path: str | Sequence[str], suffixes: Sequence[str] | None, recursive: bool):
    """Reader and paths for a zone listing.

    Flat (the top folder only): the suffix becomes a path glob, so sub
    folders are not even listed. Recursive: every file below the folder,
    filtered by name with ``pathGlobFilter``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
        if suffixes:
            reader = reader.option("pathGlobFilter", suffix_glob(*suffixes))
    elif suffixes:
        paths = [f"{p.rstrip('/')}/{suffix_glob(*suffixes)}" for p in paths]
    return reader, paths


def _first_lines(batches: Iterator) -> Iterator:
    """The first line that is not blank of the one file of a task; the rest is not read."""
    import pyarrow as pa

    for batch in batches:
        for value, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if value.strip():
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([value])], names=["file", "line"])
                return


def header_lines(spark: SparkSession, path: str | Sequence[str], suffixes: Sequence[str] | None,
                 recursive: bool, small: int = SMALL_FILE_BYTES) -> DataFrame:
    """(file, line): the first line of every file that has one."""
    own = spark.newSession()  # the settings below are for this index only
    for key, value in {"spark.sql.files.openCostInBytes": _WHOLE, "spark.sql.files.maxPartitionBytes": _WHOLE,
                       "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}.items():
        own.conf.set(key, value)

    def lines(session: SparkSession) -> DataFrame:
        reader, paths = zone_reader(session, path, suffixes, recursive)
        return reader.text(paths).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_size").alias("bytes"))

    large = lines(own).filter(F.col("bytes") > small).select("value", "file").mapInArrow(
        _first_lines, "file string, line string")
    # A small file is one split, so its lines have ascending ids; the least of them is a partial aggregate.
    first = lines(spark).filter((F.col("bytes") <= small) & (F.trim("value") != "")).select(
        "file", "value", F.monotonically_increasing_id().alias("at"))
    return first.groupBy("file").agg(F.min_by("value", "at").alias("line")).union(large)


def _cells(line: str, options: dict[str, str]) -> list[str]:
    quote, escape = options.get("quote", '"'), options.get("escape", "\\")
    reader = csv.reader([line.lstrip("﻿")], delimiter=options.get("sep", options.get("delimiter", ",")),
                        quotechar=quote or None, escapechar=None if escape == quote else escape, doublequote=True)
    return [cell.strip().lower() for cell in next(reader)]


def layouts(spark: SparkSession, path: str | Sequence[str], suffixes: Sequence[str] | None, recursive: bool,
            options: dict[str, str], names: Sequence[str]) -> list[Layout]:
    """The layouts of a zone's files; names are compared without case and padding, the first of equal ones counts.

    The driver gets one row a distinct header line, with the paths of its
    files (which Spark's own listing holds there too). A file whose first
    line has none of ``names`` has no header: an error, never a guess.
    """
    rows = header_lines(spark, path, suffixes, recursive).groupBy("line").agg(F.collect_list("file").alias("files"))
    found: dict[tuple, Layout] = {}
    for line, files in rows.collect():
        cells = _cells(line, options)
        places = {n: cells.index(n.lower()) for n in names if n.lower() in cells}
        if not places:
            raise ValueError(f"no header in {min(files)}")
        layout = found.setdefault((len(cells), *places.items()), Layout(len(cells), places))
        layout.files.extend(files)
    return [found[k] for k in sorted(found, key=str)]


def as_path(file: str) -> str:
    """A reader's path of exactly the file that ``_metadata.file_path`` names: decoded, glob characters escaped."""
    return "".join(f"\\{c}" if c in r"\*?[]{}" else c for c in unquote(file))


def scan_layout(spark: SparkSession, layout: Layout, options: dict[str, str], schema: StructType,
                extra: Sequence[Column] = ()) -> DataFrame:
    """One layout's rows in the schema's columns; absent ones are null."""
    cells = StructType([StructField(f"_c{i}", StringType()) for i in range(layout.width)])
    reader = spark.read.options(**{**options, "header": "true"}).schema(cells)
    columns = [
        (F.col(f"_c{layout.places[f.name]}") if f.name in layout.places else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields]
    return reader.csv([as_path(f) for f in layout.files]).select(*extra, *columns)
