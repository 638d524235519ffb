"""Publishing visits to the topic.

``to_json`` replaces the per-message ``json.dumps`` of a hand-written
producer; the producer settings become ``kafka.*`` options. The Kafka
connector jar is not part of this environment, so only ``encode_json`` is
exercised by the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigil.config import LakeConfig
from vigil.sinks.files import encode_json

# Producer settings (acknowledged by all replicas, small linger, retries).
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.linger.ms": "5", "kafka.retries": "5"}


def write_topic(df: DataFrame, cfg: LakeConfig) -> None:
    """Publish every row of a batch frame as one JSON message (no key)."""
    writer = encode_json(df).write.format("kafka").option("kafka.bootstrap.servers", cfg.bootstrap)
    for k, v in PRODUCER_OPTIONS.items():
        writer = writer.option(k, v)
    writer.option("topic", cfg.topic).save()
