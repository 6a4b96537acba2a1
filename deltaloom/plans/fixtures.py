"""Change logs derived from the test tables, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.envelope import envelope
from ..specs import ORDERS, PRODUCTS, REVIEWS, USERS, TableSpec

MONEY = T.DecimalType(18, 2)
SPECS = {"orders": ORDERS, "users": USERS, "products": PRODUCTS, "reviews": REVIEWS}
#: Column changed in phase 1, column set in phase 3.
PHASES = {"orders": ("total", "user_id"), "users": ("city", "name"), "products": ("price", "title"), "reviews": ("rating", "reviewer")}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, seq, op, a, b, quantity from the events."""
    e = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    return e.select(
        F.col("user_id").alias("id"), F.col("event_id").alias("seq"),
        F.when(kind == "error", "d").when(kind == "signup", "c").otherwise("u").alias("op"),
        F.when(kind != "view", F.col("value")).alias("a"), F.when(kind != "click", k).alias("b"),
        F.coalesce(F.when(kind == "purchase", k), F.lit(0)).alias("quantity"),
    )


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a target table before any change, with all its columns."""
    if name == "orders":
        o = load(spark, sf_dir, "orders")
        key = F.col("o_orderkey")
        have = {
            "id": key, "user_id": F.col("o_custkey"), "product_id": key % 2000, "quantity": (key % 50 + 1).cast("int"),
            "total": F.col("o_totalprice").cast(MONEY), "created_at": F.col("o_orderdate").cast("timestamp"),
        }
    elif name == "users":
        o = load(spark, sf_dir, "customer")
        have = {"id": F.col("c_custkey"), "name": F.col("c_name"), "state": F.col("c_mktsegment"), "latitude": F.col("c_acctbal").cast(MONEY), "source": F.lit("seed")}
    elif name == "products":
        o = load(spark, sf_dir, "part")
        have = {"id": F.col("p_partkey"), "category": F.col("p_type"), "price": F.col("p_retailprice").cast(MONEY), "quantity": F.col("p_size"), "title": F.col("p_name"), "vendor": F.col("p_brand")}
    else:
        o = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
        have = {"id": F.col("doc_id"), "reviewer": F.col("source"), "product_id": F.col("doc_id") % 2000, "rating": F.col("quality"), "body": F.col("text")}
    return o.select(*(have.get(c, F.lit(None)).cast(t).alias(c) for c, t in SPECS[name].columns.items()))


def _only(spec: TableSpec, values: dict) -> list:
    return [values.get(c, F.lit(spec.null_defaults.get(c))).cast(t).alias(c) for c, t in spec.columns.items()]


def table_log(rows: DataFrame, name: str, phases: tuple[int, ...] = (0, 1, 2, 3)) -> DataFrame:
    """seq, op and columns: snapshot reads, then partial updates, deletes and partial inserts, by id."""
    spec, (changed, again) = SPECS[name], PHASES[name]
    key = F.col("id")
    new = {"total": F.col("total") * 2, "price": F.col("price") * 2, "city": F.lit("moved"), "rating": F.lit(9)}[changed]
    seq = lambda phase: (key + phase * 1_000_000_000).cast("long").alias("seq")
    parts = [
        rows.select(seq(0), F.lit("r").alias("op"), *spec.columns),
        rows.filter(key % 3 == 0).select(seq(1), F.lit("u").alias("op"), *_only(spec, {"id": key, changed: new})),
        rows.filter(key % 5 == 0).select(seq(2), F.lit("d").alias("op"), *spec.columns),
        rows.filter(key % 10 == 0).select(seq(3), F.lit("c").alias("op"), *_only(spec, {"id": key, again: F.col(again)})),
    ]
    out = parts[phases[0]]
    for p in phases[1:]:
        out = out.unionByName(parts[p])
    return out


def events_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as envelopes, with heartbeats, tombstones, null topics and foreign tables among them."""
    e = load(spark, sf_dir, "events")
    n = F.col("event_id")
    kind = F.col("event_type")
    op = F.when(kind == "error", "d").when(kind == "signup", "c").otherwise("u")
    name = F.when(n % 7 == 0, "ledger").when(kind == "purchase", "orders").when(kind == "view", "products").when(kind == "click", "users").otherwise("reviews")
    row = F.struct(F.struct(F.col("user_id").alias("value"), F.lit(True).alias("set")).alias("id"))
    null = F.lit(None).cast("struct<id:struct<value:bigint,set:boolean>>")
    body = F.struct(op.alias("op"), F.when(op == "d", row).otherwise(null).alias("before"), F.when(op != "d", row).otherwise(null).alias("after"), F.struct(name.alias("table")).alias("source"))
    return e.select(F.when(n % 11 == 0, "__debezium-heartbeat.src").otherwise("src.public.t").alias("topic"), n.alias("seq"), F.when(n % 13 != 0, F.to_json(body)).alias("value"))


def table_envelopes(rows: DataFrame, name: str) -> DataFrame:
    """The change log of a table as envelopes."""
    log = table_log(rows, name)
    return envelope(log, SPECS[name], F.col("op"), F.col("seq"))
