"""Configuration: environment mapping, topic options and triggers (no broker needed)."""

from __future__ import annotations

from vigil.config import LakeConfig
from vigil.sources.topic import topic_options
from vigil.streaming import Trigger


def test_from_env_maps_zones_topic_and_flush():
    cfg = LakeConfig.from_env({"LAKE_ROOT": "s3a://lake", "RAW_BUCKET": "landing", "CURATED_BUCKET": "/abs/cur",
                               "KAFKA_TOPIC": "t", "BATCH_SIZE": "250", "FLUSH_SECONDS": "5", "FLUSH_BY_TIME": "no"})
    assert cfg.raw_path == "s3a://lake/landing"
    assert cfg.cleansed_path == "s3a://lake/cleansed"
    assert cfg.curated_path == "/abs/cur"
    assert (cfg.topic, cfg.batch_size, cfg.flush_seconds, cfg.flush_by_time) == ("t", 250, 5, False)
    assert cfg.table_name == "public_health.patient_visits"
    bounded = LakeConfig.from_env({"MAX_FILES_PER_TRIGGER": "7", "MAX_BATCH_SIZE": "9", "ALLOW_DATA_LOSS": "true"})
    assert (bounded.max_files_per_trigger, bounded.max_batch_size, bounded.allow_data_loss) == (7, 9, True)
    free = LakeConfig.from_env({})
    assert (free.lake_root, free.max_files_per_trigger, free.max_batch_size, free.allow_data_loss) == ("", None, None, False)


def test_topic_options_flush_by_size_and_time():
    opts = topic_options(LakeConfig("/lake"))
    assert opts["startingOffsets"] == "latest"
    assert opts["minOffsetsPerTrigger"] == "500" and "maxOffsetsPerTrigger" not in opts
    assert opts["failOnDataLoss"] == "true"
    assert opts["maxTriggerDelay"] == "10s"
    size_only = topic_options(LakeConfig("/lake", flush_by_time=False))
    assert size_only["minOffsetsPerTrigger"] == "500"
    assert size_only["maxTriggerDelay"] == "3650d"


def test_trigger_from_config():
    assert Trigger.from_config(LakeConfig("/lake")).processing_time == "10 seconds"
    assert Trigger.from_config(LakeConfig("/lake", flush_by_time=False)) == Trigger()


def test_draining_waits_for_nothing_and_bounds_are_asked_for():
    cfg = LakeConfig("/lake", max_batch_size=1000, allow_data_loss=True)
    opts = topic_options(cfg, drain=True)
    assert "minOffsetsPerTrigger" not in opts and "maxTriggerDelay" not in opts
    assert opts["maxOffsetsPerTrigger"] == "1000" and opts["failOnDataLoss"] == "false"
