"""Validated settings. Times are milliseconds."""

from __future__ import annotations

import re
from dataclasses import dataclass, field


class ConfigError(ValueError):
    """A setting that cannot work."""


@dataclass(frozen=True)
class ConsumerConfig:
    """How changes are applied.

    Batch mode gathers changes for flush_interval_ms and takes queue_capacity rows of each table at a time where the source
    can count rows; direct mode (enable_batch false) applies what there is as soon as it comes. Both give the same
    tables. batch_size is the size of the statements that a relational sink gets.
    """

    queue_capacity: int = 1000
    batch_size: int = 500
    enable_batch: bool = True
    flush_interval_ms: int = 2000
    drain_interval_ms: int = 60_000

    def __post_init__(self) -> None:
        if self.enable_batch and self.queue_capacity < self.batch_size:
            raise ConfigError("queue_capacity must not be below batch_size")
        if not 0 < self.batch_size <= 10_000:
            raise ConfigError("batch_size must be 1 to 10000")
        if self.flush_interval_ms <= 50:
            raise ConfigError("flush_interval_ms must be above 50")
        if not 0 <= self.drain_interval_ms <= 180_000:
            raise ConfigError("drain_interval_ms must be at most 180000")


@dataclass(frozen=True)
class RetryConfig:
    """Exponential backoff; max_attempts counts the first try."""

    max_attempts: int = 3
    initial_ms: int = 200
    multiplier: float = 2.0
    max_ms: int = 10_000

    def __post_init__(self) -> None:
        if self.max_attempts < 1 or self.initial_ms < 0 or self.multiplier < 1 or self.max_ms < self.initial_ms:
            raise ConfigError("retry settings out of range")


#: How the settings of a source with row limits are called in Spark's readers, by format.
ROW_LIMITS = {"kafka": "maxOffsetsPerTrigger", "changelog_simulator": "rows_per_batch"}


@dataclass(frozen=True)
class SourceConfig:
    """The change source. Connector settings that Spark does not interpret travel in `connector` and reach the reader as options.

    tables and schemas: only these (`table` or `schema.table`). topic_prefix: topics are named prefix.schema.table, so the lists
    act on the topic already, where the source can skip what is not wanted. snapshot_mode: `initial` loads a snapshot into tables
    that are empty and goes on with the stream, `never` leaves it out, `initial_only` stops after it. max_queue_size: rows
    taken at a time, max_batch_size: rows of a fetch; None leaves it to the source. payload: events stand in
    the field `payload`. provide_transaction_metadata: keep the transactions' begin and end events in a table.
    log_error_messages: log what was wrong with quarantined events, not only how many there were.
    """

    format: str = "parquet"
    path: str = ""
    tables: tuple[str, ...] = ()
    schemas: tuple[str, ...] = ()
    topic_prefix: str = ""
    snapshot_mode: str = "initial"
    ts_unit: str = "micros"
    poll_interval_ms: int = 100
    max_files_per_trigger: int | None = None
    max_batch_size: int | None = None
    max_queue_size: int | None = None
    payload: bool = False
    provide_transaction_metadata: bool = False
    log_error_messages: bool = True
    checkpoint: str = ""
    connector: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.ts_unit not in ("micros", "millis", "nanos"):
            raise ConfigError("ts_unit must be micros, millis or nanos")
        if self.snapshot_mode not in ("initial", "never", "initial_only"):
            raise ConfigError("snapshot_mode must be initial, never or initial_only")
        if any(n is not None and n < 1 for n in (self.max_batch_size, self.max_queue_size, self.max_files_per_trigger)):
            raise ConfigError("sizes must be above 0")
        if self.max_queue_size is not None and self.max_queue_size < (self.max_batch_size or 0):
            raise ConfigError("max_queue_size must not be below max_batch_size")
        if self.poll_interval_ms <= 0:
            raise ConfigError("poll_interval_ms must be above 0")
        if self.format == "kafka" and not self.topic_prefix and not any(k.startswith("subscribe") or k == "assign" for k in self.connector):
            raise ConfigError("a kafka source needs topic_prefix, or subscribe in connector")

    def topic_pattern(self) -> str | None:
        """Regular expression of the topics that the lists leave over; None without a topic_prefix."""
        if not self.topic_prefix:
            return None
        names = [re.escape(t) if "." in t else rf"[^.]+\.{re.escape(t)}" for t in self.tables] or [r"[^.]+\.[^.]+"]
        schemas = rf"(?=(?:{'|'.join(map(re.escape, self.schemas))})\.)" if self.schemas else ""
        return rf"{re.escape(self.topic_prefix)}\.{schemas}(?:{'|'.join(names)})"

    def options(self, rows: int | None = None) -> dict[str, str]:
        """Reader options, without those that are unset. rows: most rows at a time that the consumer takes."""
        limits = [n for n in (self.max_queue_size, rows) if n is not None]
        own: dict[str, object] = {"maxFilesPerTrigger": self.max_files_per_trigger}
        if self.format in ROW_LIMITS and limits:
            own[ROW_LIMITS[self.format]] = min(limits)
        if self.format == "kafka":
            own |= {"kafka.max.poll.records": self.max_batch_size, "kafkaConsumer.pollTimeoutMs": max(self.poll_interval_ms, 1000)}
            if self.topic_prefix and not any(k.startswith("subscribe") or k == "assign" for k in self.connector):
                own["subscribePattern"] = self.topic_pattern()
            own["startingOffsets"] = "earliest"
        return {k: str(v) for k, v in {**own, **self.connector}.items() if v is not None}


@dataclass(frozen=True)
class JdbcSinkConfig:
    """Settings of an optional relational sink (sources/relational.py), for those who bring a driver."""

    url: str = ""
    pool_min: int = 10
    pool_max: int = 10
    rewrite_batched_inserts: bool = True
    batch_rows: int = 5000

    def options(self) -> dict[str, str]:
        return {"url": self.url, "batchsize": str(self.batch_rows), "numPartitions": str(self.pool_max), "reWriteBatchedInserts": str(self.rewrite_batched_inserts).lower()}
