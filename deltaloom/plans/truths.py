"""Registered queries whose right result is known row by row: truth tables, settings, restarts, conflicts.

Each has its rows in SQL beside it, written down from the rules, not from the engine.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ConfigError, ConsumerConfig, JdbcSinkConfig, RetryConfig, SourceConfig
from ..functions.convert import instant_from_number, instant_from_text, local_from_text, zoned_from_text
from ..operators import read
from ..shared import shared_dir
from ..sources import envelope as env
from ..sources.readers import as_envelopes
from ..sources.relational import statements
from ..specs import ORDERS, REVIEWS, Registry, TableSpec
from ..streaming.apply import Applier
from ..streaming.retry import RecoverableError, SqlError, TransactionError, TransientConnectionError, TransientDataAccessError, is_retryable, with_retry
from ..streaming.store import CommitConflict, KeyedStore
from . import fixtures as fx

SMALL = TableSpec("small", {"id": T.LongType(), "a": T.LongType(), "q": T.IntegerType()}, null_defaults={"q": 0})
ENV = "topic string, seq long, value string"


def _work(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/deltaloom-{name}-{uuid.uuid4().hex}"


def _event(seq: int, op: str = "u", table: str = "orders", schema: str = "public", before: dict | None = None, after: dict | None = None, topic: str | None = None) -> tuple[str, int, str]:
    return topic or f"src.{schema}.{table}", seq, json.dumps({"op": op, "before": before, "after": after, "source": {"table": table, "schema": schema}})


def _cells(**kw) -> dict:
    return {k: {"value": v, "set": True} for k, v in kw.items()}


def cells_truth_table(spark: SparkSession, sf: str) -> DataFrame:
    """Cells: value, null value, null cell, missing cell, column named set, unknown column, quoted numbers, decimals, overflow, delete."""
    rows = [
        _event(0, after={**_cells(id=7, user_id="12", total=12.34, extra=1, set=5), "product_id": None, "tax": {"value": None, "set": True}}),
        _event(1, after=_cells(id=8, quantity=3, total="12345678901234567890.12345")), _event(2, "d", before=_cells(id=9, total="no number")), _event(3, after=_cells(id=10, total=10**40)),
        _event(4, after=_cells(id="x")), _event(5, after=_cells(total=1)), _event(6, "t", after=_cells(id=1)), ("t", 7, "{no json"), _event(8, after=_cells(id=11, user_id=1.5)),
    ]
    got = env.decode(env.parse(spark.createDataFrame(rows, ENV)), ORDERS)
    return got.select("seq", "op", "id", "user_id", "product_id", "quantity", F.col("total").cast("string").alias("total"), F.col("tax").isNull().alias("no_tax"), "error")


def instants_truth_table(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers in each unit, text with and without a zone; as microseconds."""
    rows = [(0, -1500, "2024-01-01T00:00:00Z"), (1, 1704067207179575, "2024-01-01T02:00:00.123456+02:00"), (2, 0, "2024-01-01T00:00:00"), (3, None, None), (4, 999, "no time")]
    df = spark.createDataFrame(rows, "case_id int, n long, s string")
    ntz = lambda c: F.unix_micros(c.cast("timestamp"))
    return df.select(
        "case_id", F.unix_micros(instant_from_number(F.col("n"))).alias("micros"), F.unix_micros(instant_from_number(F.col("n"), "nanos")).alias("nanos"),
        F.unix_micros(instant_from_number(F.when(F.col("n") < 10**12, F.col("n")).when(F.col("n").isNotNull(), 10**12), "millis")).alias("millis"), F.unix_micros(instant_from_text(F.col("s"))).alias("instant"),
        ntz(local_from_text(F.col("s"))).isNotNull().alias("is_local"), F.unix_micros(zoned_from_text(F.concat("s", F.lit("[Europe/Paris]")))).alias("zoned"),
    )


def nested_cells(spark: SparkSession, sf: str) -> DataFrame:
    """A struct column whose fields are cells, or plain."""
    kind = T.StructType([T.StructField("city", T.StringType()), T.StructField("zip", T.StructType([T.StructField("code", T.LongType())]))])
    spec = TableSpec("places", {"id": T.LongType(), "at": kind})
    at = [{"city": {"value": "A", "set": True}, "zip": {"value": {"code": {"value": "12", "set": True}}, "set": True}}, {"city": "B", "zip": {"code": 7}}, {"city": None}, None, "no struct"]
    rows = [_event(i, table="places", after=_cells(id=i, at=v)) for i, v in enumerate(at)]
    got = env.decode(env.parse(spark.createDataFrame(rows, ENV)), spec)
    return got.select("id", "at.city", "at.zip.code", F.col("error").isNotNull().alias("bad"))


def include_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Events counted under lists of tables and schemas, by topic and by source alike."""
    e = fx.load(spark, sf, "events")
    schema, table = F.when(F.col("event_id") % 2 == 0, "public").otherwise("audit"), F.when(F.col("event_id") % 3 == 0, "orders").otherwise("users")
    body = F.to_json(F.struct(F.lit("u").alias("op"), F.struct(schema.alias("schema"), table.alias("table")).alias("source")))
    events = e.select(F.concat_ws(".", F.lit("src"), schema, table).alias("topic"), F.col("event_id").alias("seq"), body.alias("value"))
    lists = [((), ()), (("orders",), ()), (("audit.orders", "users"), ()), ((), ("audit",)), (("orders",), ("public",))]
    out = None
    for i, (tables, schemas) in enumerate(lists):
        cfg = SourceConfig(topic_prefix="src", tables=tables, schemas=schemas)
        kept = env.include(env.parse(events.filter(F.col("topic").rlike(f"^{cfg.topic_pattern()}$"))), tables, schemas)
        both = kept.agg(F.count("*").alias("n")).select(F.lit(i).alias("case_id"), "n")
        out = both if out is None else out.unionByName(both)
    return out


def transaction_metadata(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.load(spark, sf, "events").filter(F.col("event_id") < 100)
    meta = F.to_json(F.struct(F.when(F.col("event_id") % 20 == 0, "BEGIN").otherwise("END").alias("status"), F.concat(F.lit("tx"), F.col("event_id")).alias("id"), F.col("event_id").alias("event_count")))
    rows = e.select(F.lit("src.transaction").alias("topic"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 10 == 0, meta).otherwise('{"op": "c", "source": {"table": "orders"}}').alias("value"))
    return env.transactions(rows).select("seq", "id", "status", "event_count")


def message_log_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows as a message log gives them (bytes, offsets, the event in a payload), decoded."""
    rows = fx.base(spark, sf, "orders")
    e = env.envelope(rows, ORDERS, F.lit("c"), F.col("id"))
    wrapped = F.concat(F.lit('{"schema": {"type": "struct"}, "payload": '), F.col("value"), F.lit("}")).cast("binary")
    log = e.select("topic", F.lit(0).alias("partition"), F.col("seq").alias("offset"), F.lit(None).cast("binary").alias("key"), wrapped.alias("value"))
    good, _ = env.check(env.decode(env.parse(as_envelopes(log), payload=True), ORDERS))
    return good.select("seq", "id", "user_id", "quantity")


def connector_settings(spark: SparkSession, sf: str) -> DataFrame:
    """The reader options that settings turn into."""
    files = SourceConfig(path="/in", max_files_per_trigger=3, connector={"recursiveFileLookup": "true"})
    log = SourceConfig(format="kafka", topic_prefix="src", tables=("orders", "audit.users"), schemas=("public", "audit"), max_batch_size=500, max_queue_size=2000, poll_interval_ms=2500, connector={"kafka.bootstrap.servers": "host:9092", "plugin": "p", "slot": "s"})
    sim = SourceConfig(format="changelog_simulator", max_queue_size=100)
    sink = JdbcSinkConfig("jdbc:x", pool_max=4, batch_rows=50)
    rows = [(n, k, v) for n, o in (("files", files.options()), ("log", log.options(800)), ("simulator", sim.options()), ("sink", sink.options())) for k, v in o.items()]
    return spark.createDataFrame(rows, "source string, option string, value string")


def settings_accepted(spark: SparkSession, sf: str) -> DataFrame:
    cases = [
        (ConsumerConfig, {}), (ConsumerConfig, {"queue_capacity": 10, "batch_size": 11}), (ConsumerConfig, {"queue_capacity": 10, "batch_size": 10}), (ConsumerConfig, {"batch_size": 10_001, "queue_capacity": 20_000}),
        (ConsumerConfig, {"batch_size": 10_000, "queue_capacity": 20_000}), (ConsumerConfig, {"flush_interval_ms": 50}), (ConsumerConfig, {"flush_interval_ms": 51}), (ConsumerConfig, {"drain_interval_ms": 180_001}),
        (ConsumerConfig, {"drain_interval_ms": 180_000}), (ConsumerConfig, {"enable_batch": False, "queue_capacity": 1}), (SourceConfig, {"ts_unit": "days"}), (SourceConfig, {"snapshot_mode": "sometimes"}),
        (SourceConfig, {"max_queue_size": 10, "max_batch_size": 11}), (SourceConfig, {"poll_interval_ms": 0}), (SourceConfig, {"format": "kafka"}), (RetryConfig, {"max_attempts": 0}), (RetryConfig, {"initial_ms": 500, "max_ms": 100}),
    ]

    def accepted(kind, kw) -> bool:
        try:
            kind(**kw)
        except ConfigError:
            return False
        return True

    return spark.createDataFrame([(i, accepted(*c)) for i, c in enumerate(cases)], "case_id int, accepted boolean")


def _because(outer: BaseException, *causes: BaseException) -> BaseException:
    at = outer
    for c in causes:
        at.__cause__ = c
        at = c
    return outer


def retry_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Failures that come `times` times before success: whether worth another try, tries made, whether it went well in the end."""
    hidden = ValueError("shown")
    hidden.__context__ = SqlError("", "40001")  # was on the way, is no cause
    cases = [
        (SqlError("", "40001"), 2), (SqlError("", "40001"), 9), (SqlError("", "23505"), 1), (_because(ValueError("a"), RuntimeError("b"), SqlError("", "40P01")), 1), (TransientConnectionError(), 1),
        (TransientDataAccessError(), 1), (TransactionError(), 1), (RecoverableError(), 1), (ConnectionError("connection is closed"), 1), (TimeoutError(), 1), (hidden, 1),
        (OSError("connection is closed"), 1), (SqlError("Connection reset by peer"), 1), (CommitConflict("other writer"), 1),
    ]
    rows = []
    for i, (error, times) in enumerate(cases):
        tries = []

        def run() -> str:
            tries.append(1)  # noqa: B023
            if len(tries) <= times:  # noqa: B023
                raise error  # noqa: B023
            return "done"

        try:
            went_well = with_retry(run, RetryConfig(), lambda _: None) == "done"
        except Exception:
            went_well = False
        rows.append((i, is_retryable(error), len(tries), went_well))
    return spark.createDataFrame(rows, "case_id int, retryable boolean, tries int, went_well boolean")


def store_single_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One row written, one changed, one deleted, one absent key deleted, then the buckets changed; between them a stream's batch numbers stay."""
    store = KeyedStore(spark, _work(spark, "rows"), SMALL, 4)
    store.commit(spark.createDataFrame([(i, "c", i, i * 10, 1) for i in range(6)], "seq long, op string, id long, a long, q int"), 0)
    for row in ((2, None, 9), (77, 1, 1)):
        store.write(spark.createDataFrame([row], SMALL.schema))
    for key in (3, 500):
        store.delete(spark.createDataFrame([(key,)], "id long"))
    store.rebucket(3)
    store.commit(spark.createDataFrame([(9, "u", 5, 1, 1)], "seq long, op string, id long, a long, q int"), 1)
    m = store.manifest()
    return store.read().select("*", F.lit(m["last_batch_id"]).alias("last_batch"), F.lit(m["buckets"]).alias("buckets"))


def store_two_writers(spark: SparkSession, sf: str) -> DataFrame:
    """Two writers start from one version: the second fails, what the first published stays, and the second's next try lands on top."""
    path = _work(spark, "writers")
    changes = "seq long, op string, id long, a long, q int"
    first, second = KeyedStore(spark, path, SMALL, 2), KeyedStore(spark, path, SMALL, 2)
    first.commit(spark.createDataFrame([(0, "c", 1, 1, 1)], changes), 0)
    seen = second.manifest()
    first.commit(spark.createDataFrame([(1, "u", 1, 2, 2), (2, "c", 2, 2, 2)], changes), 1)
    late = spark.createDataFrame([(3, "u", 1, 3, 3)], changes)
    second.manifest = lambda: seen
    conflict = False
    try:
        second.commit(late, 2)
    except CommitConflict:
        conflict = True
    kept = {r["id"]: r["a"] for r in first.read().collect()}
    del second.manifest
    with_retry(lambda: second.commit(late, 2), RetryConfig(), lambda _: None)
    return first.read().select("*", F.lit(conflict and kept == {1: 2, 2: 2}).alias("first_stayed"))


def _orders_files(spark: SparkSession, sf: str, work: str) -> DataFrame:
    """The change log of the orders (phases 1 to 3) in three files; the rows before it."""
    rows = fx.base(spark, sf, "orders")
    for phase in (1, 2, 3):
        events = env.envelope(fx.table_log(rows, "orders", (phase,)), ORDERS, F.col("op"), F.col("seq"))
        events.coalesce(1).write.mode("append").parquet(f"{work}/in")
    return rows


def _orders_shown(app: Applier) -> DataFrame:
    t = app.stores["orders"].read()
    return t.select("id", "user_id", "product_id", "quantity", F.col("total").cast("decimal(18,2)").alias("total"), F.col("created_at").cast("timestamp_ntz").alias("created_at"))


def _only_orders() -> Registry:
    return Registry().register(ORDERS)


def stream_snapshot_initial(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot into the empty table, then the stream, in direct mode; started again, nothing is applied twice."""
    work = _work(spark, "initial")
    rows = _orders_files(spark, sf, work)
    for _ in range(2):
        app = Applier(spark, SourceConfig(path=f"{work}/in", max_files_per_trigger=2), f"{work}/store", registry=_only_orders(), snapshot={"orders": lambda: rows}, consumer=ConsumerConfig(enable_batch=False))
        app.run()
    return _orders_shown(app)


def stream_snapshot_only(spark: SparkSession, sf: str) -> DataFrame:
    work = _work(spark, "only")
    rows = fx.base(spark, sf, "orders")
    app = Applier(spark, SourceConfig(path=f"{work}/in", snapshot_mode="initial_only"), f"{work}/store", registry=_only_orders(), snapshot={"orders": rows})
    app.run()
    return _orders_shown(app)


def stream_snapshot_never(spark: SparkSession, sf: str) -> DataFrame:
    """No snapshot: only what the stream inserts or changes is there."""
    work = _work(spark, "never")
    rows = _orders_files(spark, sf, work)
    app = Applier(spark, SourceConfig(path=f"{work}/in", snapshot_mode="never"), f"{work}/store", registry=_only_orders(), snapshot={"orders": rows})
    app.run()
    return _orders_shown(app)


def stream_survives_failures(spark: SparkSession, sf: str) -> DataFrame:
    """A commit fails with a state worth another try until its own tries are used up; supervision starts the stream again from its checkpoint."""
    work = _work(spark, "failures")
    rows = _orders_files(spark, sf, work)
    app = Applier(spark, SourceConfig(path=f"{work}/in", max_files_per_trigger=1), f"{work}/store", registry=_only_orders(), snapshot={"orders": rows}, retry=RetryConfig(2, 1, 1.0, 1))
    app.take_snapshot()
    store, fails = app.stores["orders"], []
    commit = store.commit

    def sometimes(changes: DataFrame, batch_id: int | None) -> bool:
        if batch_id == 1 and len(fails) < 3:
            fails.append(1)
            raise SqlError("shut down", "57P01")
        return commit(changes, batch_id)

    store.commit = sometimes
    app.run(sleep=lambda _: None)
    return _orders_shown(app).withColumn("failures", F.lit(len(fails)))


def stream_flush_and_drain(spark: SparkSession, sf: str) -> DataFrame:
    """A stream with a flush interval, more changes while it runs, and a drain: it ends when all has been applied."""
    work = _work(spark, "drain")
    rows = fx.base(spark, sf, "orders")
    events = [env.envelope(fx.table_log(rows, "orders", (phase,)), ORDERS, F.col("op"), F.col("seq")) for phase in (1, 2, 3)]
    events[0].coalesce(1).write.parquet(f"{work}/in")
    app = Applier(spark, SourceConfig(path=f"{work}/in"), f"{work}/store", registry=_only_orders(), snapshot={"orders": rows}, consumer=ConsumerConfig(flush_interval_ms=100))
    app.take_snapshot()
    query = app.start()
    query.processAllAvailable()
    for e in events[1:]:
        e.coalesce(1).write.mode("append").parquet(f"{work}/in")
    query.processAllAvailable()
    said = app.drain()
    return _orders_shown(app).withColumn("drained", F.lit(said["drained"] and not query.isActive))


def exists_by_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.base(spark, sf, "orders")
    return spark.createDataFrame([(k, read.exists_by_id(rows, k)) for k in (0, 42, -1)], "id long, found boolean")


def sink_statements(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(statements(REVIEWS, "reviews_staging"))), "step int, statement string")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        cells_truth_table, instants_truth_table, nested_cells, include_lists, transaction_metadata, message_log_rows, connector_settings, settings_accepted, retry_outcomes, store_single_rows,
        store_two_writers, stream_snapshot_initial, stream_snapshot_only, stream_snapshot_never, stream_survives_failures, stream_flush_and_drain, exists_by_id, sink_statements,
    )
}

_ORDERS = "SELECT o_orderkey AS id, o_custkey AS user_id, o_orderkey % 2000 AS product_id, CAST(o_orderkey % 50 + 1 AS INTEGER) AS quantity, CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderdate AS created_at FROM orders"
_AFTER = f"""SELECT id, user_id, CASE WHEN id % 10 <> 0 THEN product_id END AS product_id, CASE WHEN id % 10 = 0 OR id % 3 = 0 THEN 0 ELSE quantity END AS quantity,
CASE WHEN id % 10 = 0 THEN NULL WHEN id % 3 = 0 THEN CAST(total * 2 AS DECIMAL(18,2)) ELSE total END AS total, CASE WHEN id % 10 <> 0 THEN created_at END AS created_at
FROM ({_ORDERS}) WHERE id % 5 <> 0 OR id % 10 = 0"""


def _values(names: str, rows: list[str]) -> str:
    return f"SELECT * FROM (VALUES {', '.join(f'({r})' for r in rows)}) t({names})"


SQL: dict[str, str] = {
    "cells_truth_table": _values("seq, op, id, user_id, product_id, quantity, total, no_tax, error", [
        "CAST(0 AS BIGINT), 'u', CAST(7 AS BIGINT), CAST(12 AS BIGINT), CAST(NULL AS BIGINT), 0, '12.3400000000', true, CAST(NULL AS VARCHAR)", "1, 'u', 8, NULL, NULL, 3, '12345678901234567890.1234500000', true, NULL",
        "2, 'd', 9, NULL, NULL, NULL, NULL, true, NULL", "3, 'u', 10, NULL, NULL, 0, NULL, true, 'cell total does not fit decimal(38,10)'", "4, 'u', NULL, NULL, NULL, 0, NULL, true, 'cell id does not fit bigint'",
        "5, 'u', NULL, NULL, NULL, 0, '1.0000000000', true, 'no id'", "6, 't', 1, NULL, NULL, 0, NULL, true, 'unknown op t'", "7, NULL, NULL, NULL, NULL, 0, NULL, true, 'no JSON'", "8, 'u', 11, 1, NULL, 0, NULL, true, NULL",
    ]),
    "instants_truth_table": _values("case_id, micros, nanos, millis, instant, is_local, zoned", [
        "0, CAST(-1000 AS BIGINT), CAST(0 AS BIGINT), CAST(-1500000 AS BIGINT), CAST(1704067200000000 AS BIGINT), true, CAST(1704067200000000 AS BIGINT)",
        "1, 1704067207179000, 1704067207000, 1000000000000000, 1704067200123456, true, 1704067200123456", "2, 0, 0, 0, NULL, true, NULL", "3, NULL, NULL, NULL, NULL, false, NULL", "4, 0, 0, 999000, NULL, false, NULL",
    ]),
    "nested_cells": _values("id, city, code, bad", ["CAST(0 AS BIGINT), 'A', CAST(12 AS BIGINT), false", "1, 'B', 7, false", "2, NULL, NULL, false", "3, NULL, NULL, false", "4, NULL, NULL, true"]),
    "include_lists": """SELECT 0 AS case_id, count(*) AS n FROM events UNION ALL SELECT 1, count(*) FROM events WHERE event_id % 3 = 0
UNION ALL SELECT 2, count(*) FROM events WHERE event_id % 3 <> 0 OR event_id % 2 <> 0 UNION ALL SELECT 3, count(*) FROM events WHERE event_id % 2 <> 0
UNION ALL SELECT 4, count(*) FROM events WHERE event_id % 6 = 0""",
    "transaction_metadata": "SELECT event_id AS seq, concat('tx', event_id) AS id, CASE WHEN event_id % 20 = 0 THEN 'BEGIN' ELSE 'END' END AS status, event_id AS event_count FROM events WHERE event_id < 100 AND event_id % 10 = 0",
    "message_log_rows": f"SELECT id AS seq, id, user_id, quantity FROM ({_ORDERS})",
    "connector_settings": _values("source, option, value", [
        "'files', 'maxFilesPerTrigger', '3'", "'files', 'recursiveFileLookup', 'true'", "'log', 'maxOffsetsPerTrigger', '800'", "'log', 'kafka.max.poll.records', '500'", "'log', 'kafkaConsumer.pollTimeoutMs', '2500'",
        r"'log', 'subscribePattern', 'src\.(?=(?:public|audit)\.)(?:[^.]+\.orders|audit\.users)'", "'log', 'startingOffsets', 'earliest'", "'log', 'kafka.bootstrap.servers', 'host:9092'", "'log', 'plugin', 'p'", "'log', 'slot', 's'",
        "'simulator', 'rows_per_batch', '100'", "'sink', 'url', 'jdbc:x'", "'sink', 'batchsize', '50'", "'sink', 'numPartitions', '4'", "'sink', 'reWriteBatchedInserts', 'true'",
    ]),
    "settings_accepted": "SELECT CAST(i AS INTEGER) AS case_id, i IN (0, 2, 4, 6, 8, 9) AS accepted FROM range(17) t(i)",
    "retry_outcomes": _values("case_id, retryable, tries, went_well", [
        "0, true, 3, true", "1, true, 3, false", "2, false, 1, false", "3, true, 2, true", "4, true, 2, true", "5, true, 2, true", "6, true, 2, true", "7, true, 2, true", "8, false, 1, false", "9, false, 1, false", "10, false, 1, false",
        "11, false, 1, false", "12, true, 2, true", "13, true, 2, true",
    ]),
    "store_single_rows": _values("id, a, q, last_batch, buckets", ["CAST(0 AS BIGINT), CAST(0 AS BIGINT), 1, 1, 3", "1, 10, 1, 1, 3", "2, 20, 9, 1, 3", "4, 40, 1, 1, 3", "5, 1, 1, 1, 3", "77, 1, 1, 1, 3"]),
    "store_two_writers": _values("id, a, q, first_stayed", ["CAST(1 AS BIGINT), CAST(3 AS BIGINT), 3, true", "2, 2, 2, true"]),
    "stream_snapshot_initial": _AFTER,
    "stream_snapshot_only": _ORDERS,
    "stream_snapshot_never": f"""SELECT id, CASE WHEN id % 10 = 0 THEN user_id END AS user_id, CAST(NULL AS BIGINT) AS product_id, 0 AS quantity, CASE WHEN id % 10 <> 0 THEN CAST(total * 2 AS DECIMAL(18,2)) END AS total, CAST(NULL AS TIMESTAMP) AS created_at
FROM ({_ORDERS}) WHERE id % 10 = 0 OR id % 3 = 0 AND id % 5 <> 0""",
    "stream_survives_failures": f"SELECT *, 3 AS failures FROM ({_AFTER})",
    "stream_flush_and_drain": f"SELECT *, true AS drained FROM ({_AFTER})",
    "exists_by_id": _values("id, found", ["CAST(0 AS BIGINT), true", "42, true", "-1, false"]),
    "sink_statements": _values("step, statement", [
        """0, 'DELETE FROM "reviews" WHERE "id" IN (SELECT "id" FROM "reviews_staging" WHERE reset OR NOT alive)'""",
        """1, 'INSERT INTO "reviews" ("id", "reviewer", "product_id", "rating", "body", "created_at") SELECT "id", "reviewer", "product_id", "rating", "body", "created_at" FROM "reviews_staging" WHERE alive ON CONFLICT ("id") DO UPDATE SET "reviewer" = COALESCE(EXCLUDED."reviewer", "reviews"."reviewer"), "product_id" = COALESCE(EXCLUDED."product_id", "reviews"."product_id"), "rating" = COALESCE(EXCLUDED."rating", "reviews"."rating"), "body" = COALESCE(EXCLUDED."body", "reviews"."body"), "created_at" = COALESCE(EXCLUDED."created_at", "reviews"."created_at")'""",
        """2, 'DELETE FROM "reviews_staging"'""",
    ]),
}
