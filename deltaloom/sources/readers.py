"""Change sources: files (batch and streaming) and a simulator of a change log."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from ..config import SourceConfig

ENVELOPE = "topic string, seq long, value string"


FILES = ("parquet", "json", "csv", "orc", "text")


def as_envelopes(rows: DataFrame) -> DataFrame:
    """Rows of a message log (topic, partition, offset, value in bytes) as envelopes. seq is the offset: a key's changes stand in one partition, in order."""
    value = F.col("value").cast("string")
    return rows.select(F.col("topic").cast("string").alias("topic"), F.col("offset").cast("long").alias("seq"), value.alias("value"))


def _wanted(rows: DataFrame, cfg: SourceConfig) -> DataFrame:
    """Only topics that the lists leave over: a filter on a column of the source, which scans can push down."""
    pattern = cfg.topic_pattern()
    return rows.filter(F.col("topic").startswith(f"{cfg.topic_prefix}.") & F.col("topic").rlike(f"^{pattern}$")) if pattern else rows


def _shaped(rows: DataFrame, cfg: SourceConfig) -> DataFrame:
    return _wanted(as_envelopes(rows) if "offset" in rows.columns and "seq" not in rows.columns else rows, cfg)


def read_changes(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """All changes there are now."""
    reader = spark.read.format(cfg.format).options(**{k: v for k, v in cfg.options().items() if not k.startswith("max")})
    if cfg.format in FILES:
        reader = reader.schema(ENVELOPE)
    return _shaped(reader.load(cfg.path) if cfg.path else reader.load(), cfg)


def stream_changes(spark: SparkSession, cfg: SourceConfig, rows: int | None = None) -> DataFrame:
    """Changes as they come; the rate limits of the source hold back what is too much."""
    reader = spark.readStream.format(cfg.format).options(**cfg.options(rows))
    if cfg.format in FILES:
        reader = reader.schema(ENVELOPE)
    return _shaped(reader.load(cfg.path) if cfg.path else reader.load(), cfg)


class _Range(InputPartition):
    def __init__(self, start: int, end: int) -> None:
        self.start, self.end = start, end


def _event(i: int, keys: int) -> tuple[str, int, str]:
    """A fixed sequence of changes: every seventh deletes, every third leaves the total out."""
    op = "d" if i % 7 == 6 else "c" if i < keys else "u"
    total = "null" if i % 3 == 2 else f'{{"value": {i}.25, "set": true}}'
    row = f'{{"id": {{"value": {i % keys}, "set": true}}, "user_id": {{"value": {i}, "set": true}}, "total": {total}}}'
    before, after = (row, "null") if op == "d" else ("null", row)
    return "sim.public.orders", i, f'{{"op": "{op}", "before": {before}, "after": {after}, "source": {{"table": "orders", "schema": "public"}}}}'


class ChangeLogSimulator(DataSource):
    """`spark.read.format("changelog_simulator")`: options events, keys, parts; streaming gives rows_per_batch at a time."""

    @classmethod
    def name(cls) -> str:
        return "changelog_simulator"

    def schema(self) -> str:
        return ENVELOPE

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Stream(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.events, self.keys, self.parts = (int(options.get(k, v)) for k, v in (("events", 1000), ("keys", 50), ("parts", 4)))

    def partitions(self) -> list[InputPartition]:
        step = -(-self.events // self.parts)
        return [_Range(a, min(a + step, self.events)) for a in range(0, self.events, step)]

    def read(self, partition) -> Iterator[tuple]:
        return (_event(i, self.keys) for i in range(partition.start, partition.end))


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, options) -> None:
        self.events, self.keys, self.rows = (int(options.get(k, v)) for k, v in (("events", 1000), ("keys", 50), ("rows_per_batch", 250)))

    def initialOffset(self) -> dict:
        return {"at": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end = min(start["at"] + self.rows, self.events)
        return iter([_event(i, self.keys) for i in range(start["at"], end)]), {"at": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([_event(i, self.keys) for i in range(start["at"], end["at"])])

    def commit(self, end: dict) -> None:
        pass
