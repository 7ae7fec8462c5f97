"""Operator settings with their default values."""

from __future__ import annotations

from dataclasses import dataclass

# Defaults of the pipeline's settings.
DEFAULT_THRESHOLD = 5.0
DEFAULT_SAMPLE_RATE = 0.001
DEFAULT_WRITERS = 3
DEFAULT_INTAKE_BATCH = 500
DEFAULT_TRIGGER_SECONDS = 30
DEFAULT_MAX_FILE_MB = 30.0
DEFAULT_MAX_AGE_MINUTES = 5
DEFAULT_MAX_ROWS = 24000
DEFAULT_MIN_ROWS = 50
DEFAULT_MAX_ATTEMPTS = 3
DEFAULT_TABLE = "messages"
DEFAULT_COLUMNS = "payload:payload.toString()"
DEFAULT_JDBC_BATCH = 1
DEFAULT_IDLE_TIMEOUT_MS = -1
DEFAULT_METRICS_PREFIX = "jdbc_consumer"
RATE_WINDOW_SECONDS = 300
PREVIEW_CHARS = 100
UNKNOWN = "unknown"
DRIVER_PREFIX = "DRIVER-"
TEXT_CONTENT_TYPES = ("text", "json", "x-spring-tuple")
DEFAULT_CONTENT_TYPE = "application/json"


@dataclass(frozen=True)
class DetectorConfig:
    threshold: float = DEFAULT_THRESHOLD
    sample_rate: float = DEFAULT_SAMPLE_RATE


@dataclass(frozen=True)
class RollConfig:
    """When an archive file is closed and which files count as too small."""

    max_age_minutes: float = DEFAULT_MAX_AGE_MINUTES
    max_rows: int = DEFAULT_MAX_ROWS
    max_size_mb: float = DEFAULT_MAX_FILE_MB
    min_rows: int = DEFAULT_MIN_ROWS

    @property
    def max_age_micros(self) -> int:
        return int(self.max_age_minutes * 60_000_000)

    @property
    def max_bytes(self) -> int:
        return int(self.max_size_mb * 1024 * 1024)


@dataclass(frozen=True)
class ArchiveConfig:
    """Where and how the archive is written.

    ``splits`` is over how many tasks a stream spreads the rows of one partition value.
    """

    path: str
    partition_columns: tuple[str, ...] = ("date",)
    trigger_seconds: int = DEFAULT_TRIGGER_SECONDS
    force_flush: bool = False
    splits: int = 4
    roll: RollConfig = RollConfig()


@dataclass(frozen=True)
class TableSinkConfig:
    """Settings of the table loader."""

    table: str = DEFAULT_TABLE
    columns: str = DEFAULT_COLUMNS
    initialize: str = "false"
    batch_size: int = DEFAULT_JDBC_BATCH
    idle_timeout_ms: int = DEFAULT_IDLE_TIMEOUT_MS
    enable_metrics: bool = True
    metrics_prefix: str = DEFAULT_METRICS_PREFIX
    max_attempts: int = DEFAULT_MAX_ATTEMPTS
