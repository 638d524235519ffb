"""The staged pipeline: each micro-batch through the raw, cleansed and curated zones.

A micro-batch is one unit in every zone. Its folders and its load are named
after the lane and the batch id and are replaced as wholes, so a batch that
runs again after a failure adds nothing. The messages are read once from the
source; the cleansed rows are read back from the CSV that was written, as the
batch lanes do, so both give the same curated rows. Rules of keys that no
message of the micro-batch has do not apply to it.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil.config import VALID_CODES
from vigil.operators.rules import Codes, outcomes
from vigil.schema import ABSENT_KEYS
from vigil.session import list_folders, path_exists
from vigil.sinks.files import write_curated, write_lines, write_outcomes
from vigil.sources.files import outcome_quality, read_kept, read_outcomes
from vigil.sources.messages import message_profile, parse_messages
from vigil.streaming.ingest import DRAIN, Trigger

STAGED = "staged"
FLUSHES = (
    "batch_id long, messages long, valid_messages long, invalid_messages long, visits long, rows_after long, "
    "missing_required long, bad_date long, invalid_code long")


@dataclass(frozen=True)
class Zones:
    """Base folders of a staged lane; ``flushes`` holds a row of counts a micro-batch."""

    raw: str
    cleansed: str
    curated: str
    flushes: str

    def batch(self, zone: str, lane: str, batch_id: int) -> str:
        return f"{zone.rstrip('/')}/{STAGED}/{lane}/batch={batch_id:012d}"


def lane_of(checkpoint: str) -> str:
    """A lane's name: the same for each start on a checkpoint."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def stage_batch(batch: DataFrame, batch_id: int, zones: Zones, lane: str, codes: Codes = VALID_CODES) -> None:
    """One micro-batch of messages (``value``) into the three zones, and its row of counts.

    A batch without a valid message leaves its raw lines and its counts
    only. The counts come from the files that were written.
    """
    spark = batch.sparkSession
    lines = batch.select("value").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_lines(lines, zones.batch(zones.raw, lane, batch_id))
        told = message_profile(lines).first()
        kept_counts = {"rows_after": 0, "missing_required": 0, "bad_date": 0, "invalid_code": 0}
        if told.valid_messages:
            out = zones.batch(zones.cleansed, lane, batch_id)
            rows = parse_messages(lines.withColumn(ABSENT_KEYS, F.lit(told[ABSENT_KEYS])), keep=[ABSENT_KEYS],
                                  mark_invalid=True, keep_message=True)
            rows = rows.withColumn("source", F.lit(f"{lane}/{batch_id}"))
            columns = [c for c in rows.columns if c not in ("source", "_message")]
            write_outcomes(outcomes(rows.select(*columns, "source", "_message"), codes), out)
            write_curated(read_kept(spark, [out]), zones.curated, f"{STAGED}-{lane}-{batch_id:012d}")
            kept_counts = outcome_quality(read_outcomes(spark, out)).first().asDict()
        row = (batch_id, told.messages, told.valid_messages, told.invalid_messages, told.visits, *[
            int(kept_counts[c]) for c in ("rows_after", "missing_required", "bad_date", "invalid_code")])
        spark.createDataFrame([row], FLUSHES).coalesce(1).write.mode("overwrite").parquet(
            zones.batch(zones.flushes, lane, batch_id))
    finally:
        lines.unpersist()


def stream_staged(messages: DataFrame, zones: Zones, checkpoint: str, trigger: Trigger = DRAIN,
                  name: str | None = None, codes: Codes = VALID_CODES) -> StreamingQuery:
    """Runs ``stage_batch`` on each micro-batch of a stream of messages."""
    lane = lane_of(checkpoint)
    writer = messages.select("value").writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: stage_batch(batch, batch_id, zones, lane, codes))
    if name:
        writer = writer.queryName(name)
    return trigger.apply(writer).start()


def _batches(spark: SparkSession, zone: str) -> list[str]:
    root = f"{zone.rstrip('/')}/{STAGED}"
    return [b for lane in list_folders(spark, root) for b in list_folders(spark, lane)] if path_exists(spark, root) else []


def read_staged_raw(spark: SparkSession, raw: str) -> DataFrame:
    """Every message of the staged raw zone (``value``)."""
    found = _batches(spark, raw)
    return spark.read.text(found) if found else spark.createDataFrame([], "value string")


def read_staged_cleansed(spark: SparkSession, cleansed: str) -> DataFrame:
    """The cleansed visits of all staged micro-batches."""
    return read_kept(spark, _batches(spark, cleansed))


def read_flushes(spark: SparkSession, flushes: str) -> DataFrame:
    """The counts of every flush of every staged lane."""
    found = _batches(spark, flushes)
    return spark.read.schema(FLUSHES).parquet(*found) if found else spark.createDataFrame([], FLUSHES)
