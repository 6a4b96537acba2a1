"""`python -m deltaloom settings.json`: build the session, the settings and the applier, and run it until it is told to stop.

The file holds {"store": path, "source": {...}, "consumer": {...}, "retry": {...}, "spark": {...}, "available_now": false,
"on_error": "fail", "buckets": 16, "snapshot": {table: path of Parquet}}; all but store and source may be left out.
"""

from __future__ import annotations

import json
import logging
import signal
import sys

from pyspark.sql import SparkSession

from .config import ConfigError, ConsumerConfig, RetryConfig, SourceConfig
from .sources.readers import ChangeLogSimulator
from .streaming.apply import Applier

KNOWN = {"store", "source", "consumer", "retry", "spark", "available_now", "on_error", "honor_set", "buckets", "snapshot"}


def build(settings: dict, spark: SparkSession | None = None) -> Applier:
    """The applier that the settings describe."""
    if unknown := set(settings) - KNOWN:
        raise ConfigError(f"unknown settings {sorted(unknown)}")
    if "store" not in settings or "source" not in settings:
        raise ConfigError("store and source are needed")
    try:
        source = SourceConfig(**{k: tuple(v) if isinstance(v, list) else v for k, v in settings["source"].items()})
        consumer, retry = ConsumerConfig(**settings.get("consumer", {})), RetryConfig(**settings.get("retry", {}))
    except TypeError as e:
        raise ConfigError(str(e)) from e
    if spark is None:
        spark = SparkSession.builder.appName("deltaloom").config(map={"spark.sql.session.timeZone": "UTC", **settings.get("spark", {})}).getOrCreate()
    if source.format == ChangeLogSimulator.name():
        spark.dataSource.register(ChangeLogSimulator)
    rows = {t: (lambda p=p: spark.read.parquet(p)) for t, p in settings.get("snapshot", {}).items()}
    return Applier(
        spark, source, settings["store"], consumer=consumer, retry=retry, on_error=settings.get("on_error", "fail"), honor_set=settings.get("honor_set", False), buckets=settings.get("buckets", 16), snapshot=rows
    )


def main(argv: list[str]) -> int:
    if len(argv) != 1:
        print(__doc__, file=sys.stderr)
        return 2
    logging.basicConfig(level=logging.INFO)
    with open(argv[0]) as f:
        settings = json.load(f)
    app = build(settings)
    was = signal.signal(signal.SIGTERM, lambda *_: app.drain())
    try:
        app.run(settings.get("available_now", False))
    finally:
        signal.signal(signal.SIGTERM, was)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
