"""Lanes that take new files only.

A stream over the *names* of a zone's files (the binary file source, whose
content column is never read) with a checkpoint: each run is given the files
that no run before it was given. A micro-batch of names goes through the
batch code, as a folder of the cleansed zone and a load of the curated zone
named after its id, so a batch that runs again replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vigil.config import VALID_CODES
from vigil.functions import suffix_glob
from vigil.operators.rules import Codes
from vigil.plans.batch import cleanse_lane
from vigil.sinks.files import write_curated
from vigil.sources.files import read_csv, read_jsonl, read_kept
from vigil.sources.headers import as_path
from vigil.streaming.ingest import DRAIN, Trigger

FILES_PER_BATCH = 10_000  # names that the driver holds at once
_FILES = "path string, modificationTime timestamp, length long, content binary"
INCREMENTAL = "incremental"


def new_files(spark: SparkSession, path: str, suffixes: Sequence[str], recursive: bool,
              files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Streaming frame of the paths (``path``) of files that land in a zone, however old they are."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", suffix_glob(*suffixes))
    reader = reader.option("maxFilesPerTrigger", str(files_per_batch)).option("maxFileAge", "36500d")
    if recursive:
        return reader.option("recursiveFileLookup", "true").load(path).select("path")
    return reader.load(f"{path.rstrip('/')}/{suffix_glob(*suffixes)}").select("path")


def _lane(files: DataFrame, read: Callable[[SparkSession, list[str]], DataFrame], lane: str, cleansed: str,
          curated: str, checkpoint: str, trigger: Trigger, codes: Codes) -> StreamingQuery:
    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        paths = [as_path(r.path) for r in batch.collect()]  # at most FILES_PER_BATCH names
        if not paths:
            return
        out = f"{cleansed.rstrip('/')}/{INCREMENTAL}/{lane}/batch={batch_id:012d}"
        cleanse_lane(read(spark, paths), out, codes)
        write_curated(read_kept(spark, [out]), curated, f"{INCREMENTAL}-{lane}-{batch_id:012d}")

    return trigger.apply(files.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take)).start()


def incremental_csv(spark: SparkSession, raw: str, cleansed: str, curated: str, checkpoint: str,
                    trigger: Trigger = DRAIN, codes: Codes = VALID_CODES, csv_options: dict[str, str] | None = None,
                    files_per_batch: int = FILES_PER_BATCH) -> StreamingQuery:
    """Flat ``*.csv`` of the raw zone that no earlier run took -> cleansed and curated, by each file's header."""
    def read(session: SparkSession, paths: list[str]) -> DataFrame:
        return read_csv(session, paths, suffixes=None, by_header=True, options=csv_options, keep_source=True,
                        mark_absent=True)

    return _lane(new_files(spark, raw, ("csv",), False, files_per_batch), read, "csv", cleansed, curated, checkpoint,
                 trigger, codes)


def incremental_jsonl(spark: SparkSession, raw: str, cleansed: str, curated: str, checkpoint: str,
                      trigger: Trigger = DRAIN, codes: Codes = VALID_CODES, suffixes: Sequence[str] = ("jsonl",),
                      files_per_batch: int = FILES_PER_BATCH) -> StreamingQuery:
    """Every ``*.jsonl`` below the raw zone that no earlier run took -> cleansed and curated."""
    def read(session: SparkSession, paths: list[str]) -> DataFrame:
        return read_jsonl(session, paths, suffixes=None, recursive=False, keep_source=True, mark_invalid=True,
                          mark_absent=True, keep_message=True)

    return _lane(new_files(spark, raw, suffixes, True, files_per_batch), read, "jsonl", cleansed, curated, checkpoint,
                 trigger, codes)
