"""The visit topic as a streaming source.

Spark's Kafka connector replaces the hand-written consumer: offsets live in
the query checkpoint (no auto-commit before the data is written), and the
size at which a micro-batch runs replaces the in-memory buffer. The connector jar is
not part of this environment, so ``read_topic`` cannot be exercised here;
``read_message_files`` is the file-based stand-in the tests run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import LakeConfig
from vigil.sources.ledger import batch_files, file_key, start_stream


# Stand-in for "never flush by time": only a full batch (or the final drain) triggers.
NO_TIME_FLUSH_DELAY = "3650d"


def topic_options(cfg: LakeConfig, starting_offsets: str = "latest", drain: bool = False) -> dict[str, str]:
    """Kafka source options implementing the flush rule.

    A micro-batch runs when ``batch_size`` messages are waiting, or, with
    time flushing on, once ``flush_seconds`` have passed since the last one
    with fewer waiting; it takes all that wait, or at most
    ``max_batch_size`` if that is set. Use the default trigger with these
    options. To drain (``availableNow``) nothing is waited for, so the tail
    is read whatever its size. Messages that aged out unread fail the query
    unless ``allow_data_loss`` is set.
    """
    options = {
        "kafka.bootstrap.servers": cfg.bootstrap,
        "subscribe": cfg.topic,
        "startingOffsets": starting_offsets,
        # Offsets are tracked in the checkpoint; the group id only names the consumers.
        "groupIdPrefix": cfg.group_id,
        "failOnDataLoss": "false" if cfg.allow_data_loss else "true",
    }
    if cfg.max_batch_size:
        options["maxOffsetsPerTrigger"] = str(cfg.max_batch_size)
    if not drain:
        options["minOffsetsPerTrigger"] = str(cfg.batch_size)
        options["maxTriggerDelay"] = f"{cfg.flush_seconds}s" if cfg.flush_by_time else NO_TIME_FLUSH_DELAY
    return options


def read_topic(spark: SparkSession, cfg: LakeConfig, starting_offsets: str = "latest",
               drain: bool = False) -> DataFrame:
    """Streaming frame with one column ``value``: the message decoded as UTF-8 text."""
    reader = spark.readStream.format("kafka")
    for k, v in topic_options(cfg, starting_offsets, drain).items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_message_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of text lines (``value``) from files landing in ``path``.

    When ``path`` is the output of a file sink, Spark reads its commit log,
    so only committed files are seen, each once.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def read_raw_stream(spark: SparkSession, raw_path: str, checkpoint: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of the messages that ``stream_raw`` landed, less the files that the batch lane owns."""
    start_stream(spark, raw_path, checkpoint)
    folder = f"{raw_path.rstrip('/')}/stream"
    lines = read_message_files(spark, folder, max_files_per_trigger)
    owned = batch_files(spark, raw_path)
    if owned is None:
        return lines
    lines = lines.select("value", file_key(F.col("_metadata.file_path")).alias("file"))
    return lines.join(owned, "file", "left_anti").select("value")
