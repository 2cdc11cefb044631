"""Record-log data model: columns, offsets and argument checks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

# Fixed values of the data model.
FLAG_RAW = "RAW"
FLAG_JSON = "JSON"
COMPRESSIONS = ("none", "gzip", "zstd")
DEFAULT_SHARD_COUNT = 1
DEFAULT_BACKLOG_SECONDS = 604_800
DEFAULT_BATCH_COUNT = 100
DEFAULT_BATCH_BYTES = 1_048_576
DEFAULT_BATCH_TIMEOUT_MS = 100
DEFAULT_ACK_TIMEOUT_SECONDS = 600
DEFAULT_MAX_UNACKED = 10_000
ACK_BATCH_COUNT = 100
ACK_BATCH_SECONDS = 5

# Fixed texts of record-level errors.
ERROR_CONTAMINATED = "data contaminated"
ERROR_NO_RECORDS = "no records"
ERROR_UNKNOWN_TYPE = "unknown record type"
ERROR_NO_SHARD = "no shard for key"
ERROR_TOO_MANY_SHARDS = "too many shards"
ERROR_UNKNOWN_STAT = "unknown stat type"

ID_COLUMNS = ["shard_id", "batch_id", "batch_index"]


@dataclass(frozen=True)
class Offset:
    """A position in a stream: earliest, latest, a record, a time, or none."""

    kind: str
    batch_id: int | None = None
    batch_index: int | None = None
    at: datetime | None = None

    @staticmethod
    def earliest() -> "Offset":
        return Offset("earliest")

    @staticmethod
    def latest() -> "Offset":
        return Offset("latest")

    @staticmethod
    def empty() -> "Offset":
        return Offset("empty")

    @staticmethod
    def record(batch_id: int, batch_index: int) -> "Offset":
        return Offset("record", batch_id=batch_id, batch_index=batch_index)

    @staticmethod
    def timestamp(at: datetime | int) -> "Offset":
        """``at`` is a zone-less UTC time or epoch milliseconds."""
        if isinstance(at, int):
            at = datetime(1970, 1, 1) + timedelta(milliseconds=at)
        return Offset("timestamp", at=at)


def check_positive(name: str, value: int) -> int:
    if value <= 0:
        raise ValueError(f"{name} must be greater than 0, got {value}")
    return value


def check_stream(replicas: int = 3, shard_count: int = DEFAULT_SHARD_COUNT, backlog_seconds: int = DEFAULT_BACKLOG_SECONDS) -> None:
    check_positive("replicas", replicas)
    check_positive("shard_count", shard_count)
    if backlog_seconds < 0:
        raise ValueError(f"backlog_seconds must not be negative, got {backlog_seconds}")


def check_subscription(ack_timeout_s: int = DEFAULT_ACK_TIMEOUT_SECONDS, max_unacked: int = DEFAULT_MAX_UNACKED) -> None:
    check_positive("ack_timeout_s", ack_timeout_s)
    check_positive("max_unacked", max_unacked)


def check_compression(name: str) -> str:
    if name not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {COMPRESSIONS}, got {name!r}")
    return name
