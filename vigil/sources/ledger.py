"""Who owns a raw message that several lanes could take: one lane a file.

The raw stream folder can be read by the batch lane and by the curate
stream. The batch lane owns the files it listed here before its first read;
once the curate stream has started on the folder, all others are the
stream's, and the batch lane takes no new ones. So each file is taken by one
lane whatever the order of the runs, a lane can be run again, and the list
that the stream checks is final before its first micro-batch. The two lanes'
very first runs must not overlap.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import path_exists, touch

_FOLDER = "_ledger"


def _root(raw_path: str) -> str:
    return f"{raw_path.rstrip('/')}/{_FOLDER}"


def file_key(file: Column) -> Column:
    """A file's path with one slash after its scheme, however it was written."""
    return F.regexp_replace(file, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def start_stream(spark: SparkSession, raw_path: str, checkpoint: str) -> None:
    """Notes that a curate stream follows the raw stream folder from now on."""
    touch(spark, f"{_root(raw_path)}/stream/{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}")


def stream_started(spark: SparkSession, raw_path: str) -> bool:
    return path_exists(spark, f"{_root(raw_path)}/stream")


def batch_files(spark: SparkSession, raw_path: str) -> DataFrame | None:
    """(file): what the batch lane owns; None before it took any."""
    path = f"{_root(raw_path)}/batch"
    if not path_exists(spark, path):
        return None
    return spark.read.schema("file string").parquet(path).distinct()


def claim_for_batch(spark: SparkSession, raw_path: str, folder: str) -> DataFrame | None:
    """The files of the raw stream folder that the batch lane may read; claims new ones while no stream has started."""
    if not stream_started(spark, raw_path):
        files = spark.read.text(folder).inputFiles()  # as Spark's own listing holds them
        listed = spark.createDataFrame([(f,) for f in files], "file string").select(file_key(F.col("file")).alias("file"))
        owned = batch_files(spark, raw_path)
        if owned is not None:
            listed = listed.join(owned, "file", "left_anti")
        listed.coalesce(1).write.mode("append").parquet(f"{_root(raw_path)}/batch")
    return batch_files(spark, raw_path)
