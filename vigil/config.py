"""Fixed values and the run-time configuration of the visit lake.

Every constant that must equal the original system's for identical results
is listed once, here, in its natural order.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

# --- fixed values (must not change: they define the results) ---------------
# Diagnosis codes kept by cleansing, case-sensitive.
VALID_CODES = ("B50", "A00", "J10", "A01", "A90")
# Text fields trimmed (space character only) before any other rule.
TRIM_COLUMNS = ("patient_id", "hospital", "county", "disease", "diagnosis_code", "visit_date")
# Fields that must be non-null for a visit to be kept.
REQUIRED_COLUMNS = ("patient_id", "disease", "diagnosis_code", "visit_date")
# Output column order of cleansed and curated visits.
PREFERRED_COLUMNS = (
    "patient_id", "hospital", "county", "visit_date", "disease", "diagnosis_code", "event_time_utc",
)
# Strict visit date format.
DATE_FORMAT = "yyyy-MM-dd"
# Rolling window: current row plus this many preceding rows (observed days).
WINDOW_PRECEDING_ROWS = 6
# Growth factor of the outbreak predicate (strict greater-than).
GROWTH_FACTOR = Decimal("1.5")
# Topic defaults.
DEFAULT_TOPIC = "public_health_visits"
DEFAULT_GROUP_ID = "public-health-pipeline"
DEFAULT_BOOTSTRAP = "localhost:29092"
# Micro-batch flush: by size, and by idle time in seconds.
DEFAULT_BATCH_SIZE = 500
DEFAULT_FLUSH_SECONDS = 10
# Words that switch a flag of the environment on (any case).
TRUE_WORDS = ("1", "true", "yes")
# Zone (bucket) names.
RAW_ZONE = "raw"
CLEANSED_ZONE = "cleansed"
CURATED_ZONE = "curated"
# Catalog names.
DEFAULT_DATABASE = "public_health"
DEFAULT_TABLE = "patient_visits"
# ---------------------------------------------------------------------------


def _flag(value: str) -> bool:
    return value.strip().lower() in TRUE_WORDS


@dataclass(frozen=True)
class LakeConfig:
    """Where the zones live and how the stream is read and flushed.

    Storage credentials are never part of this object: set them as
    ``spark.hadoop.fs.s3a.*`` (or the cloud equivalent) on the cluster.
    """

    lake_root: str
    raw_zone: str = RAW_ZONE
    cleansed_zone: str = CLEANSED_ZONE
    curated_zone: str = CURATED_ZONE
    bootstrap: str = DEFAULT_BOOTSTRAP
    topic: str = DEFAULT_TOPIC
    group_id: str = DEFAULT_GROUP_ID
    batch_size: int = DEFAULT_BATCH_SIZE
    flush_seconds: int = DEFAULT_FLUSH_SECONDS
    flush_by_time: bool = True
    # Upper bounds of a micro-batch (messages of the topic, files of a folder); none unless set.
    max_batch_size: int | None = None
    max_files_per_trigger: int | None = None
    # Go on when messages aged out of the topic before they were read (they are lost then).
    allow_data_loss: bool = False
    valid_codes: tuple[str, ...] = VALID_CODES
    window_rows: int = WINDOW_PRECEDING_ROWS
    growth_factor: Decimal = GROWTH_FACTOR
    database: str = DEFAULT_DATABASE
    table: str = DEFAULT_TABLE

    def zone_path(self, zone: str) -> str:
        """A zone given as a full URI or absolute path is used as is."""
        if "://" in zone or zone.startswith("/"):
            return zone
        return f"{self.lake_root.rstrip('/')}/{zone}"

    @property
    def raw_path(self) -> str:
        return self.zone_path(self.raw_zone)

    @property
    def cleansed_path(self) -> str:
        return self.zone_path(self.cleansed_zone)

    @property
    def curated_path(self) -> str:
        return self.zone_path(self.curated_zone)

    @property
    def table_name(self) -> str:
        return f"{self.database}.{self.table}"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> LakeConfig:
        env = os.environ if env is None else env
        d = cls(lake_root=env.get("LAKE_ROOT", ""))

        def bound(name: str) -> int | None:
            return int(env[name]) if env.get(name) else None

        return cls(
            lake_root=d.lake_root,
            raw_zone=env.get("RAW_BUCKET", d.raw_zone),
            cleansed_zone=env.get("CLEANSED_BUCKET", d.cleansed_zone),
            curated_zone=env.get("CURATED_BUCKET", d.curated_zone),
            bootstrap=env.get("KAFKA_BOOTSTRAP", d.bootstrap),
            topic=env.get("KAFKA_TOPIC", d.topic),
            group_id=env.get("KAFKA_GROUP_ID", d.group_id),
            batch_size=int(env.get("BATCH_SIZE", d.batch_size)),
            flush_seconds=int(env.get("FLUSH_SECONDS", d.flush_seconds)),
            flush_by_time=_flag(env.get("FLUSH_BY_TIME", "true")),
            max_batch_size=bound("MAX_BATCH_SIZE"),
            max_files_per_trigger=bound("MAX_FILES_PER_TRIGGER"),
            allow_data_loss=_flag(env.get("ALLOW_DATA_LOSS", "false")),
            database=env.get("LAKE_DATABASE", d.database),
            table=env.get("LAKE_TABLE", d.table),
        )
