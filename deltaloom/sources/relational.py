"""A relational sink: net changes go to a staging table, and statements of the database's own move them from there.

The statements are plain SQL of databases with INSERT ... ON CONFLICT. Staging is Spark's JDBC writer, so it needs a
driver, which the caller brings; `run` is the caller's way to execute statements in one transaction.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JdbcSinkConfig
from ..specs import TableSpec


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def statements(spec: TableSpec, staging: str) -> list[str]:
    """Delete what is gone or starts anew, upsert what lives keeping old values where the new one is null, empty the staging table."""
    table, stage, key = _quoted(spec.name), _quoted(staging), _quoted(spec.key)
    cols = ", ".join(map(_quoted, spec.columns))
    news = ", ".join(f"{_quoted(c)} = COALESCE(EXCLUDED.{_quoted(c)}, {table}.{_quoted(c)})" for c in spec.values)
    return [
        f"DELETE FROM {table} WHERE {key} IN (SELECT {key} FROM {stage} WHERE reset OR NOT alive)",
        f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {stage} WHERE alive ON CONFLICT ({key}) DO UPDATE SET {news}",
        f"DELETE FROM {stage}",
    ]


def stage(net: DataFrame, spec: TableSpec, staging: str, cfg: JdbcSinkConfig, batch_rows: int | None = None) -> None:
    """Write net changes to the staging table, over at most pool_max connections."""
    rows = net.select(*spec.columns, "reset", F.col("alive"))
    options = cfg.options() | ({"batchsize": str(batch_rows)} if batch_rows else {})
    rows.write.format("jdbc").options(**options, dbtable=staging, truncate="true").mode("overwrite").save()


def apply(net: DataFrame, spec: TableSpec, cfg: JdbcSinkConfig, run: Callable[[list[str]], None], batch_rows: int | None = None, write: Callable = stage) -> None:
    """Stage net changes and have `run` execute the statements as one transaction. Done twice, it leaves the same table."""
    staging = f"{spec.name}_staging"
    write(net, spec, staging, cfg, batch_rows)
    run(statements(spec, staging))
