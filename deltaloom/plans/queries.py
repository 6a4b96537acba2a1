"""The registered queries of the change-apply engine, and SQL that gets the same rows another way."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RetryConfig, SourceConfig
from ..functions.convert import instant_from_number
from ..operators import read
from ..operators.fold import compose, fold_changes, live_rows
from ..operators.merge import apply_changes, delete, empty_table
from ..operators.runs import plan_batches
from ..shared import shared_dir
from ..sources import envelope as env
from ..specs import ORDERS, USERS, default_registry
from ..streaming.retry import backoff_schedule, retryable_link
from . import fixtures as fx
from . import truths

COLS = ["a", "b", "quantity"]
#: Columns compared, by table.
SHOWN = {
    "orders": ["id", "user_id", "product_id", "quantity", "total", "created_at"],
    "users": ["id", "name", "city", "state", "latitude", "source"],
    "products": ["id", "category", "price", "quantity", "title", "vendor"],
    "reviews": ["id", "reviewer", "product_id", "rating", "body"],
}


def _shown(df: DataFrame, name: str) -> DataFrame:
    """Decimals as decimal(18,2), timestamps without zone."""
    kinds = {"total": "decimal(18,2)", "price": "decimal(18,2)", "latitude": "decimal(18,2)", "rating": "decimal(18,2)", "created_at": "timestamp_ntz"}
    return df.select(*(F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in SHOWN[name]))


def events_fold_live(spark: SparkSession, sf: str) -> DataFrame:
    return live_rows(fold_changes(fx.events_log(spark, sf), "id", COLS), "id", COLS)


def events_fold_net(spark: SparkSession, sf: str) -> DataFrame:
    return fold_changes(fx.events_log(spark, sf), "id", COLS)


def events_batch_split_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two halves folded apart, their net changes composed."""
    log = fx.events_log(spark, sf)
    odd = F.col("seq") < 4000
    return live_rows(compose(fold_changes(log.filter(odd), "id", COLS), fold_changes(log.filter(~odd), "id", COLS), "id", COLS), "id", COLS)


def events_run_batches(spark: SparkSession, sf: str) -> DataFrame:
    log = fx.events_log(spark, sf).withColumn("table", F.concat(F.lit("t"), F.col("id") % 8))
    return plan_batches(log, 3).select("table", "seq", "kind", "run_id", "batch_id")


def events_micros_to_millis(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.load(spark, sf, "events")
    return e.select("event_id", instant_from_number(F.unix_micros(F.col("ts").cast("timestamp"))).cast("timestamp_ntz").alias("ts_ms"))


def events_route_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = env.routed(env.parse(fx.events_envelopes(spark, sf)), default_registry())
    return kept.groupBy("table", "op", env.image(F.col("op")).alias("image")).agg(F.count("*").alias("n"))


def _upsert(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spec = fx.SPECS[name]
        return _shown(apply_changes(empty_table(spark, spec), fx.table_log(fx.base(spark, sf, name), name), spec), name)

    return run


def _delete(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = fx.base(spark, sf, name)
        return _shown(delete(rows, rows.filter(F.col("id") % 5 == 0).select("id"), fx.SPECS[name]), name)

    return run


def orders_delete_reinsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.base(spark, sf, "orders")
    return _shown(apply_changes(rows, fx.table_log(rows, "orders", (2, 3)), ORDERS), "orders").filter(F.col("id") % 10 == 0)


def orders_partial_quantity_zero(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.base(spark, sf, "orders")
    return _shown(apply_changes(rows, fx.table_log(rows, "orders", (1,)), ORDERS), "orders").select("id", "quantity", "total")


def users_null_does_not_clear(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.base(spark, sf, "users")
    return _shown(apply_changes(rows, fx.table_log(rows, "users", (1,)), USERS), "users")


def orders_snapshot_then_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot reads and later changes as envelopes, decoded and folded together."""
    rows = fx.base(spark, sf, "orders")
    events = env.snapshot(rows, ORDERS).unionByName(env.envelope(fx.table_log(rows, "orders", (1, 2, 3)), ORDERS, F.col("op"), F.col("seq")))
    good, _ = env.check(env.decode(env.parse(events), ORDERS))
    return _shown(live_rows(fold_changes(good, "id", ORDERS.values), "id", ORDERS.values), "orders")


def envelope_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.base(spark, sf, "orders")
    good, _ = env.check(env.decode(env.parse(env.envelope(rows, ORDERS, F.lit("c"), F.col("id"))), ORDERS))
    return _shown(good, "orders")


def envelope_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a broken op or key, by what is wrong."""
    rows = fx.base(spark, sf, "orders")
    op = F.when(F.col("id") % 17 == 0, "t").otherwise("u")
    events = env.envelope(rows, ORDERS, op, F.col("id")).withColumn("value", F.when(F.col("seq") % 19 == 0, F.regexp_replace("value", '"id":\\{"value":[0-9]+', '"id":{"value":"x"')).otherwise(F.col("value")))
    _, bad = env.check(env.decode(env.parse(events), ORDERS), "quarantine")
    return bad.groupBy("error").agg(F.count("*").alias("n"))


def stream_available_now_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Envelopes in four uneven files, one micro-batch each, into a keyed store."""
    from ..streaming.apply import Applier

    work = f"{shared_dir(spark)}/deltaloom-stream-{uuid.uuid4().hex}"
    events = fx.table_envelopes(fx.base(spark, sf, "orders"), "orders").withColumn("part", F.expr("case when seq < 1000003000 then 0 when seq < 2000000000 then 1 when seq < 3000000000 then 2 else 3 end"))
    for k in range(4):
        events.filter(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(f"{work}/in")
    app = Applier(spark, SourceConfig(path=f"{work}/in", max_files_per_trigger=1), f"{work}/store", retry=RetryConfig())
    app.run(available_now=True)
    return _shown(app.stores["orders"].read(), "orders")


STATES = [
    ("40001", ""), ("40P01", ""), ("57P01", ""), ("08006", ""), ("23505", ""), ("XX000", "Schema version mismatch for table"), ("XX000", "other"),
    (None, "Connection is closed"), (None, "connection reset by peer"), (None, "the connection is closed"), (None, ""), ("XX000", "catalog schema version mismatch seen"), ("XX000", None), ("23505", "Connection is closed"),
    ("400011", ""), ("XX000", "SCHEMA VERSION MISMATCH"),
]


def retry_classification(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(i, retryable_link(s, m)) for i, (s, m) in enumerate(STATES)], "case_id int, retryable boolean")


def retry_backoff_schedule(spark: SparkSession, sf: str) -> DataFrame:
    rows = [(n, i, w) for n, c in (("profile", RetryConfig(5, 500, 3.0, 30_000)), ("default", RetryConfig())) for i, w in enumerate(backoff_schedule(c))]
    return spark.createDataFrame(rows, "config string, attempt int, wait_ms int")


def read_find_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(read.find_by_id(fx.base(spark, sf, "orders"), 42), "orders")


def read_find_all_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(read.find_all_by_id(fx.base(spark, sf, "orders"), [1, 2, 42, -1]), "orders")


def read_page_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(read.find_page(fx.base(spark, sf, "orders"), 2, 25, F.desc("total"), "id"), "orders")


def read_count(spark: SparkSession, sf: str) -> DataFrame:
    return read.count(fx.base(spark, sf, "orders"))


def read_by_example(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(read.find_by_example(fx.base(spark, sf, "users"), state="BUILDING", source="seed", city=None), "users")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        events_fold_live, events_fold_net, events_batch_split_merge, events_run_batches, events_micros_to_millis, events_route_filter,
        orders_delete_reinsert, orders_partial_quantity_zero, users_null_does_not_clear, orders_snapshot_then_stream, envelope_json_roundtrip,
        envelope_quarantine, stream_available_now_orders, retry_classification, retry_backoff_schedule, read_find_by_id, read_find_all_by_id,
        read_page_sorted, read_count, read_by_example,
    )
} | {f"{t}_apply_upsert": _upsert(t) for t in fx.SPECS} | {f"{t}_apply_delete": _delete(t) for t in fx.SPECS} | truths.QUERIES

_EVENTS = """
log AS (SELECT user_id AS id, event_id AS seq, event_type = 'error' AS dead,
  CASE WHEN event_type <> 'view' THEN value END AS a,
  CASE WHEN event_type <> 'click' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS b,
  CASE WHEN event_type = 'purchase' THEN coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) ELSE 0 END AS quantity FROM events),
d AS (SELECT *, max(CASE WHEN dead THEN seq END) OVER (PARTITION BY id) AS ld FROM log),
net AS (SELECT id,
  max_by(a, seq) FILTER (WHERE NOT dead AND a IS NOT NULL AND (ld IS NULL OR seq > ld)) AS a,
  max_by(b, seq) FILTER (WHERE NOT dead AND b IS NOT NULL AND (ld IS NULL OR seq > ld)) AS b,
  max_by(quantity, seq) FILTER (WHERE NOT dead AND (ld IS NULL OR seq > ld)) AS quantity,
  max(ld) IS NOT NULL AS reset, max(seq) <> coalesce(max(ld), -1) AS alive, max(seq) AS last_seq FROM d GROUP BY id)
"""
_BASE = {
    "orders": "SELECT o_orderkey AS id, o_custkey AS user_id, o_orderkey % 2000 AS product_id, CAST(o_orderkey % 50 + 1 AS INTEGER) AS quantity, CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderdate AS created_at FROM orders",
    "users": "SELECT c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS city, c_mktsegment AS state, CAST(c_acctbal AS DECIMAL(18,2)) AS latitude, 'seed' AS source FROM customer",
    "products": "SELECT p_partkey AS id, p_type AS category, CAST(p_retailprice AS DECIMAL(18,2)) AS price, p_size AS quantity, p_name AS title, p_brand AS vendor FROM part",
    "reviews": "SELECT d.doc_id AS id, source AS reviewer, d.doc_id % 2000 AS product_id, CAST(quality AS DECIMAL(18,2)) AS rating, text AS body FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
}
_NEW = {"orders": ("total", "CAST(total * 2 AS DECIMAL(18,2))", "user_id"), "users": ("city", "'moved'", "name"), "products": ("price", "CAST(price * 2 AS DECIMAL(18,2))", "title"), "reviews": ("rating", "CAST(9 AS DECIMAL(18,2))", "reviewer")}


def _closed(name: str) -> str:
    """The table after its change log, by what must have become of each id."""
    changed, new, again = _NEW[name]

    def col(c: str) -> str:
        if c == "id":
            return "id"
        after = "0" if c == "quantity" else c if c == again else "NULL"
        third = new if c == changed else "0" if c == "quantity" else c
        return f"CASE WHEN id % 10 = 0 THEN {after} WHEN id % 3 = 0 THEN {third} ELSE {c} END AS {c}"

    return f"WITH base AS ({_BASE[name]}) SELECT {', '.join(col(c) for c in SHOWN[name])} FROM base WHERE id % 5 <> 0 OR id % 10 = 0"


_COLS = {t: ", ".join(c) for t, c in SHOWN.items()}
_KEPT = "event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 7 <> 0"
SQL: dict[str, str] = {
    "events_fold_live": f"WITH {_EVENTS} SELECT id, a, b, quantity FROM net WHERE alive",
    "events_fold_net": f"WITH {_EVENTS} SELECT id, a, b, quantity, reset, alive, last_seq FROM net",
    "events_batch_split_merge": f"WITH {_EVENTS} SELECT id, a, b, quantity FROM net WHERE alive",
    "events_run_batches": """
WITH l AS (SELECT concat('t', user_id % 8) AS "table", event_id AS seq, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'write' END AS kind FROM events),
n AS (SELECT *, CASE WHEN lag(kind) OVER w IS DISTINCT FROM kind THEN 1 ELSE 0 END AS fresh FROM l WINDOW w AS (PARTITION BY "table" ORDER BY seq)),
r AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY "table" ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_id FROM n)
SELECT "table", seq, kind, run_id, CAST((row_number() OVER (PARTITION BY "table", run_id ORDER BY seq) - 1) // 3 AS BIGINT) AS batch_id FROM r""",
    "events_micros_to_millis": "SELECT event_id, date_trunc('millisecond', ts) AS ts_ms FROM events",
    "events_route_filter": f"""
SELECT "table", op, CASE WHEN op = 'd' THEN 'before' ELSE 'after' END AS image, count(*) AS n FROM (
SELECT CASE event_type WHEN 'purchase' THEN 'orders' WHEN 'view' THEN 'products' WHEN 'click' THEN 'users' ELSE 'reviews' END AS "table",
CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op FROM events WHERE {_KEPT}) GROUP BY 1, 2, 3""",
    **{f"{t}_apply_upsert": _closed(t) for t in _BASE},
    **{f"{t}_apply_delete": f"SELECT {_COLS[t]} FROM ({_BASE[t]}) WHERE id % 5 <> 0" for t in _BASE},
    "orders_delete_reinsert": f"SELECT id, user_id, CAST(NULL AS BIGINT) AS product_id, 0 AS quantity, CAST(NULL AS DECIMAL(18,2)) AS total, CAST(NULL AS TIMESTAMP) AS created_at FROM ({_BASE['orders']}) WHERE id % 10 = 0",
    "orders_partial_quantity_zero": f"SELECT id, CASE WHEN id % 3 = 0 THEN 0 ELSE quantity END AS quantity, CASE WHEN id % 3 = 0 THEN CAST(total * 2 AS DECIMAL(18,2)) ELSE total END AS total FROM ({_BASE['orders']})",
    "users_null_does_not_clear": f"SELECT id, name, CASE WHEN id % 3 = 0 THEN 'moved' END AS city, state, latitude, source FROM ({_BASE['users']})",
    "orders_snapshot_then_stream": _closed("orders"),
    "envelope_json_roundtrip": _BASE["orders"],
    "envelope_quarantine": """
SELECT error, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'unknown op t' ELSE 'cell id does not fit bigint' END AS error
FROM orders WHERE o_orderkey % 17 = 0 OR o_orderkey % 19 = 0) GROUP BY 1""",
    "stream_available_now_orders": _closed("orders"),
    "retry_classification": "SELECT * FROM (VALUES (0,true),(1,true),(2,true),(3,true),(4,false),(5,false),(6,false),(7,true),(8,true),(9,false),(10,false),(11,true),(12,false),(13,true),(14,false),(15,false)) t(case_id, retryable)",
    "retry_backoff_schedule": "SELECT * FROM (VALUES ('profile',0,500),('profile',1,1500),('profile',2,4500),('profile',3,13500),('default',0,200),('default',1,400)) t(config, attempt, wait_ms)",
    "read_find_by_id": f"SELECT {_COLS['orders']} FROM ({_BASE['orders']}) WHERE id = 42",
    "read_find_all_by_id": f"SELECT {_COLS['orders']} FROM ({_BASE['orders']}) WHERE id IN (1, 2, 42, -1)",
    "read_page_sorted": f"SELECT {_COLS['orders']} FROM ({_BASE['orders']}) ORDER BY total DESC, id LIMIT 25 OFFSET 50",
    "read_count": "SELECT count(*) AS n FROM orders",
    "read_by_example": f"SELECT {_COLS['users']} FROM ({_BASE['users']}) WHERE state = 'BUILDING' AND source = 'seed'",
    **truths.SQL,
}
