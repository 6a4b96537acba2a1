"""Truth tables, replay properties, the store, and streaming."""

import json
import random
from datetime import UTC, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.config import ConfigError, ConsumerConfig, JdbcSinkConfig, RetryConfig, SourceConfig
from deltaloom.functions.convert import instant_from_number, instant_from_text, local_from_text, zoned_from_text
from deltaloom.operators import read
from deltaloom.operators.fold import compose, fold_changes, live_rows, reject_ties
from deltaloom.operators.merge import apply_changes, delete, empty_table, upsert
from deltaloom.operators.runs import batches
from deltaloom.sources import envelope as env
from deltaloom.sources.readers import ChangeLogSimulator
from deltaloom.specs import ORDERS, PRODUCTS, TableSpec, default_registry
from deltaloom.streaming.apply import Applier
from deltaloom.streaming.retry import SqlError, TransientConnectionError, backoff_schedule, is_retryable, with_retry
from deltaloom.streaming.store import CommitConflict, KeyedStore

SPEC = TableSpec("t", {"id": T.LongType(), "a": T.LongType(), "q": T.IntegerType()}, null_defaults={"q": 0})
LOG = "id long, seq long, op string, a long, q int"


def log(n, keys, seed):
    r = random.Random(seed)
    return [(r.randrange(keys), i, r.choice("ccuurd"), r.choice([None, r.randrange(100)]), r.randrange(9)) for i in range(n)]


def replay(rows, table=None):
    """Statement after statement, as the definition of what is right."""
    table = dict(table or {})
    for key, _, op, a, q in sorted(rows, key=lambda x: x[1]):
        if op == "d":
            table.pop(key, None)
        else:
            old = table.get(key, (None, None))
            table[key] = (a if a is not None else old[0], q if q is not None else old[1])
    return table


def as_dict(df):
    return {r["id"]: (r["a"], r["q"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_fold_is_replay_however_it_is_split(spark, seed):
    rows = log(300, 25, seed)
    df = spark.createDataFrame(rows, LOG)
    assert as_dict(live_rows(fold_changes(df, "id", ["a", "q"]), "id", ["a", "q"])) == replay(rows)
    cut = random.Random(seed).randrange(300)
    parts = [fold_changes(df.filter(f"seq < {cut}"), "id", ["a", "q"]), fold_changes(df.filter(f"seq >= {cut}"), "id", ["a", "q"])]
    assert as_dict(live_rows(compose(*parts, "id", ["a", "q"]), "id", ["a", "q"])) == replay(rows)
    target = empty_table(spark, SPEC)
    for lo, hi in ((0, cut), (cut, 300)):
        target = apply_changes(target, df.filter(f"seq >= {lo} and seq < {hi}"), SPEC)
    assert as_dict(target) == replay(rows)


def test_fold_cases(spark):
    rows = [(1, 1, "u", 5, 1), (2, 1, "c", 5, 1), (2, 2, "u", None, 0), (3, 1, "d", None, None), (4, 1, "c", 7, 3), (4, 2, "d", None, None), (4, 3, "c", None, 2)]
    net = {r["id"]: r for r in fold_changes(spark.createDataFrame(rows, LOG), "id", ["a", "q"]).collect()}
    assert (net[1]["a"], net[2]["a"], net[2]["q"]) == (5, 5, 0)
    assert not net[3]["alive"] and net[4]["alive"] and net[4]["reset"] and net[4]["a"] is None
    assert reject_ties(spark.createDataFrame([(1, 1, "u", 1, 1), (1, 1, "u", 2, 2)], LOG), "id").count() == 1


def test_fold_shuffles_once(spark):
    plan = fold_changes(spark.createDataFrame(log(50, 5, 1), LOG), "id", ["a", "q"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_upsert_and_delete(spark):
    t = spark.createDataFrame([(1, 10, 1), (2, 20, 2)], SPEC.schema)
    assert as_dict(upsert(t, spark.createDataFrame([(1, None, 0), (3, 30, 3)], SPEC.schema), SPEC)) == {1: (10, 0), 2: (20, 2), 3: (30, 3)}
    assert as_dict(delete(t, spark.createDataFrame([(2,), (9,)], "id long"), SPEC)) == {1: (10, 1)}


def test_runs(spark):
    rows = [("t", i, op) for i, op in enumerate("cucdduud")] + [("u", 0, "d")]
    got = [tuple(r) for r in batches(spark.createDataFrame(rows, "table string, seq long, op string"), 2).orderBy("table", "first_seq").select("table", "kind", "n_rows", "first_seq").collect()]
    assert got == [("t", "write", 2, 0), ("t", "write", 1, 2), ("t", "delete", 2, 3), ("t", "write", 2, 5), ("t", "delete", 1, 7), ("u", "delete", 1, 0)]


@pytest.mark.parametrize("piece_rows", [1, 7, 40, 1000])
def test_runs_in_pieces(spark, piece_rows):
    """Runs that go on over pieces, pieces of one run, and ties of none."""
    from deltaloom.operators.runs import plan_batches

    r = random.Random(piece_rows)
    rows = [(t, i * 3 + k, op) for k, t in enumerate("tu") for i, op in enumerate([*("u" * 30), *("d" * 20), *(r.choice("ud") for _ in range(60)), *("u" * 25)])]
    got = {(x["table"], x["seq"]): (x["run_id"], x["batch_id"]) for x in plan_batches(spark.createDataFrame(rows, "table string, seq long, op string"), 4, piece_rows=piece_rows).collect()}
    want = {}
    for t in "tu":
        run, place, last = 0, 0, None
        for _, seq, op in sorted(x for x in rows if x[0] == t):
            run, place = (run, place + 1) if (op == "d") == last else (run + 1, 0)
            last = op == "d"
            want[t, seq] = (run, place // 4)
    assert got == want


def test_decode_parses_once(spark):
    """One parse of the JSON, two looks at each cell at most, however the rows are used."""
    df = spark.createDataFrame([event(after=cells(id=1))], ENV)
    good, _ = env.check(env.decode(env.parse(df), ORDERS))
    plan = good.select("id", "quantity", "total").filter("total > 1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1
    assert all(1 <= plan.count(f"$.after.{c}.value") <= 2 for c in ORDERS.columns)


def test_sink_statements_in_a_database(spark):
    """The statements, run by a database on staged net changes, leave what the store leaves; done twice, the same."""
    import duckdb

    from deltaloom.sources.relational import apply

    spec = TableSpec("t", {"id": T.LongType(), "a": T.LongType(), "q": T.LongType()})
    con = duckdb.connect()
    con.execute('CREATE TABLE t (id BIGINT PRIMARY KEY, a BIGINT, q BIGINT); CREATE TABLE t_staging (id BIGINT, a BIGINT, q BIGINT, "reset" BOOLEAN, alive BOOLEAN)')

    def write(net, spec, staging, cfg, batch_rows):
        con.execute(f"DELETE FROM {staging}")
        rows = net.select(*spec.columns, "reset", "alive").collect()
        if rows:
            con.executemany(f"INSERT INTO {staging} VALUES (?, ?, ?, ?, ?)", [tuple(x) for x in rows])

    def run(statements):
        for x in statements:
            con.execute(x)

    rows = log(120, 12, 4)
    df = spark.createDataFrame(rows, LOG)
    for lo, hi in ((0, 50), (50, 90), (90, 120), (90, 120)):
        net = fold_changes(df.filter(f"seq >= {lo} and seq < {hi}"), "id", ["a", "q"])
        apply(net, spec, JdbcSinkConfig(), run, write=write)
    assert {i: (a, q) for i, a, q in con.execute("SELECT id, a, q FROM t").fetchall()} == replay(rows)


def test_large_buckets_are_written_by_several_tasks(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), SPEC, 1)
    was = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        store.write(spark.range(200_000).selectExpr("id", "id * 7919 as a", "cast(1 as int) as q"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", was)
    (folder,) = set(store.manifest()["parts"].values())
    assert len(list((tmp_path / "s" / "data" / folder / "b=0").glob("*.parquet"))) > 1
    assert store.read().count() == 200_000


def test_failed_commits_leave_nothing(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), SPEC, 2)
    store.write(spark.createDataFrame([(1, 1, 1)], SPEC.schema))
    with pytest.raises(Exception, match="broken"):
        store.write(spark.createDataFrame([(2, 1, 1)], SPEC.schema).withColumn("a", F.expr("cast(raise_error('broken') as bigint)")))
    assert len(list((tmp_path / "s" / "data").iterdir())) == 1 and store.read().count() == 1


def test_supervision_gives_up(spark, tmp_path):
    src = str(tmp_path / "in")
    _write(spark, src, 0, 10)
    app = Applier(spark, SourceConfig(path=src), str(tmp_path / "store"), retry=RetryConfig(2, 1, 1.0, 1))
    tries = []

    def broken(changes, batch_id):
        tries.append(1)
        raise SqlError("", "40001" if len(tries) < 3 else "23505")

    app.stores["orders"].commit = broken
    with pytest.raises(Exception, match="SqlError"):
        app.run(sleep=lambda s: None)
    assert len(tries) == 3


def test_boot(tmp_path, spark):
    from deltaloom.__main__ import build, main

    settings = {"store": str(tmp_path / "store"), "source": {"path": str(tmp_path / "in"), "tables": ["orders"]}, "available_now": True, "buckets": 2, "snapshot": {"orders": str(tmp_path / "snap")}}
    _write(spark, str(tmp_path / "in"), 0, 50)
    spark.createDataFrame([(1000,)], "id long").selectExpr("id", *(f"cast(null as {t.simpleString()}) as {c}" for c, t in list(ORDERS.columns.items())[1:])).write.parquet(str(tmp_path / "snap"))
    (tmp_path / "settings.json").write_text(json.dumps(settings))
    assert main([str(tmp_path / "settings.json")]) == 0
    app = build(settings, spark)
    assert _got(app) == {**_expected(50), 1000: (None, None)}
    assert main([]) == 2
    for bad in ({"store": "x"}, {**settings, "more": 1}, {**settings, "source": {"paths": "x"}}):
        with pytest.raises(ConfigError):
            build(bad, spark)


def test_topics_of_lists():
    import re

    cfg = SourceConfig(topic_prefix="a.b", tables=("orders", "x.users"), schemas=("public", "x"))
    match = lambda t: bool(re.fullmatch(cfg.topic_pattern(), t))
    assert [match(t) for t in ("a.b.public.orders", "a.b.x.users", "a.b.public.users", "a.b.y.orders", "aXb.public.orders", "a.b.public.orders2")] == [True, True, False, False, False, False]
    assert SourceConfig().topic_pattern() is None


def test_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from deltaloom.shared import shared_dir

    conf = SimpleNamespace(get=lambda k, d=None: d)
    with pytest.raises(RuntimeError):
        shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")))


def event(table="orders", op="u", seq=0, topic="src.public.orders", before=None, after=None, **source):
    return (topic, seq, json.dumps({"op": op, "before": before, "after": after, "source": {"table": table, **source}}))


def cells(**kw):
    return {k: {"value": v, "set": True} for k, v in kw.items()}


ENV = "topic string, seq long, value string"


def test_filters_and_routing(spark):
    rows = [
        event(after=cells(id=1)), event(topic="__debezium-heartbeat.src", after=cells(id=2)), ("t", 3, None), event("ledger", after=cells(id=4)), event("orders", after=cells(id=5), schema="other"),
        ("t", 6, '{"status": "BEGIN"}'), event("Users", after=cells(id=7)),
    ]
    parsed = env.parse(spark.createDataFrame([(t, i, v) for i, (t, _, v) in enumerate(rows)], ENV))
    assert {r["seq"] for r in env.routed(parsed, default_registry()).collect()} == {0, 4, 6}
    assert {r["seq"] for r in env.include(parsed, ["orders"]).collect()} == {0, 4}
    assert {r["seq"] for r in env.include(parsed, [], ["other"]).collect()} == {4}


def decoded(spark, *events, spec=ORDERS, **kw):
    rows = [(t, i, v) for i, (t, _, v) in enumerate(events)]
    return env.decode(env.parse(spark.createDataFrame(rows, ENV)), spec, **kw).orderBy("seq").collect()


def test_cells(spark):
    row = decoded(
        spark,
        event(after={**cells(id=7, user_id="12", total=12.34, extra=1, set=5), "product_id": None, "tax": {"value": None, "set": True}}),
        event(after=cells(id=8, quantity=3, total="12345678901234567890.12345", created_at=1704067207179575)),
        event(op="d", before=cells(id=9, total="no number")),
        event(after=cells(id=10, created_at="2024-01-01T00:00:00.123456+02:00")),
    )
    assert (row[0]["id"], row[0]["user_id"], row[0]["total"], row[0]["product_id"], row[0]["tax"], row[0]["quantity"]) == (7, 12, Decimal("12.3400000000"), None, None, 0)
    assert row[1]["quantity"] == 3 and row[1]["total"] == Decimal("12345678901234567890.1234500000")
    assert row[1]["created_at"].replace(tzinfo=UTC) == datetime(2024, 1, 1, 0, 0, 7, 179000, UTC)
    assert row[2]["id"] == 9 and row[2]["op"] == "d" and row[2]["quantity"] is None
    assert row[3]["created_at"].replace(tzinfo=UTC) == datetime(2023, 12, 31, 22, 0, 0, 123456, UTC)
    assert all(r["error"] is None for r in row)


def test_bad_events(spark):
    bad = decoded(
        spark, event(op="t", after=cells(id=1)), event(op=None, after=cells(id=1)), event(after=cells(total=1)), event(after=cells(id=1, total=10**40)), event(after=cells(id="x")),
        event(after=cells(id=1, created_at="2024-01-01T00:00:00")), ("t", 0, "{no json"),
    )
    assert [r["error"] is not None for r in bad] == [True] * 7
    one = env.decode(env.parse(spark.createDataFrame([event(op="t", after=cells(id=1))], ENV)), ORDERS)
    with pytest.raises(Exception, match="unknown op t"):
        env.check(one)[0].collect()
    good, quarantined = env.check(one, "quarantine")
    assert good.count() == 0 and quarantined.count() == 1


def test_honor_set_clears(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ORDERS, 2, honor_set=True)
    for i, after in enumerate((cells(id=1, total=5, user_id=3), {**cells(id=1), "total": {"value": None, "set": True}})):
        store.commit(env.decode(env.parse(spark.createDataFrame([event(after=after, seq=i)], ENV)), ORDERS, honor_set=True).drop("error"), i)
    row = store.read().first()
    assert row["total"] is None and row["user_id"] == 3


def test_instants(spark):
    df = spark.createDataFrame([(-1500, "2024-01-01T00:00:00Z"), (1704067207179575, "2024-01-01T00:00:00")], "n long, s string")
    got = df.select(F.unix_micros(instant_from_number(F.col("n"))), instant_from_text(F.col("s")), local_from_text(F.col("s")), zoned_from_text(F.concat("s", F.lit("[Europe/Paris]")))).collect()
    assert [r[0] for r in got] == [-1000, 1704067207179000]
    assert got[0][1] is not None and got[1][1] is None and got[1][2] == datetime(2024, 1, 1) and got[0][3] is not None


def test_config():
    for bad in ({"queue_capacity": 10, "batch_size": 11}, {"batch_size": 10_001, "queue_capacity": 20_000}, {"flush_interval_ms": 50}, {"drain_interval_ms": 180_001}):
        with pytest.raises(ConfigError):
            ConsumerConfig(**bad)
    ConsumerConfig(enable_batch=False, queue_capacity=1)
    with pytest.raises(ConfigError):
        SourceConfig(ts_unit="days")
    assert SourceConfig(max_files_per_trigger=2, connector={"a": "b"}).options() == {"a": "b", "maxFilesPerTrigger": "2"}
    assert JdbcSinkConfig("u").options()["url"] == "u"
    assert PRODUCTS.preserving().null_defaults == {}


_Sql = lambda state, message="": SqlError(message, state)


class _Throwable:
    """Stands in for a throwable of the JVM."""

    def __init__(self, kinds, message=None, state=None, cause=None):
        self.kinds, self.message, self.state, self.cause = kinds, message, state, cause

    def getClass(self):
        return _Class(self.kinds)

    def getMessage(self):
        return self.message

    def getCause(self):
        return self.cause

    def getSQLState(self):
        return self.state


class _Class:
    def __init__(self, kinds):
        self.kinds = kinds

    def getName(self):
        return self.kinds[0]

    def getSuperclass(self):
        return _Class(self.kinds[1:]) if self.kinds[1:] else None


def test_retry():
    assert backoff_schedule(RetryConfig(5, 500, 3.0, 30_000)) == [500, 1500, 4500, 13500]
    outer = ValueError("outer")
    outer.__cause__ = RuntimeError("middle")
    outer.__cause__.__cause__ = _Sql("40001")
    assert is_retryable(outer) and is_retryable(TransientConnectionError()) and is_retryable(_Sql("XX000", "a schema version mismatch")) and is_retryable(_Sql(None, "Connection is closed"))
    assert not is_retryable(_Sql("XX000", "Schema Version Mismatch")) and not is_retryable(OSError("Connection is closed")) and not is_retryable(ConnectionError())
    assert not is_retryable(_Sql("23505")) and not is_retryable(_Sql("XX000", "other")) and not is_retryable(ValueError())
    sql = ("java.sql.SQLException", "java.lang.Exception")
    for throwable, want in (
        (_Throwable(("org.x.Broken", "java.sql.SQLRecoverableException", *sql)), True), (_Throwable(("java.lang.RuntimeException",), cause=_Throwable(("org.x.SqlError", *sql), "m", "57P01")), True),
        (_Throwable(sql, "Connection reset by peer"), True), (_Throwable(("java.io.IOException",), "Connection reset by peer", "40001"), False), (_Throwable(sql, "m", "23505"), False),
    ):
        e = RuntimeError("from the JVM")
        e.java_exception = throwable
        assert is_retryable(e) == want
    tries, waits = [], []

    def run():
        tries.append(1)
        if len(tries) < 3:
            raise _Sql("40P01")
        return "done"

    assert with_retry(run, RetryConfig(), waits.append) == "done" and waits == [0.2, 0.4]
    with pytest.raises(SqlError):
        with_retry(lambda: (_ for _ in ()).throw(_Sql("23505")), RetryConfig(), waits.append)


def test_store(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), SPEC, 4)
    rows = log(200, 20, 9)
    df = spark.createDataFrame(rows, LOG)
    assert store.read().count() == 0
    for i, (lo, hi) in enumerate(((0, 80), (80, 90), (90, 200))):
        part = df.filter(f"seq >= {lo} and seq < {hi}")
        assert store.commit(part, i)
        assert not store.commit(part, i)  # delivered twice
    assert as_dict(store.read()) == replay(rows)
    before = store.manifest()["parts"]
    store.write(spark.createDataFrame([(500, 1, 1)], SPEC.schema))
    after = store.manifest()["parts"]
    assert sum(before.get(b) != v for b, v in after.items()) == 1  # one bucket rewritten
    store.delete(spark.createDataFrame([(500,)], "id long"))
    assert as_dict(store.read()) == replay(rows)
    with pytest.raises(CommitConflict):
        store._publish(store.manifest())
    assert store.vacuum(1) and not store.vacuum(1) and as_dict(store.read()) == replay(rows)


def test_read(spark):
    df = spark.createDataFrame([(i, i % 3, i) for i in range(10)], SPEC.schema)
    assert read.find_by_id(df, 4).count() == 1 and read.exists_by_id(df, 4) and not read.exists_by_id(df, 99)
    assert read.find_all_by_id(df, [1, 2, 77]).count() == 2 and read.count(df).first()["n"] == 10
    assert [r["id"] for r in read.find_page(df, 1, 3, F.desc("id")).collect()] == [6, 5, 4] and read.find_by_example(df, a=1, q=None).count() == 3
    assert read.find_all(df).count() == 10 and read.find_sorted(df, "id").first()["id"] == 0


def _write(spark, path, lo, hi, keys=20):
    from deltaloom.sources.readers import _event

    spark.createDataFrame([_event(i, keys) for i in range(lo, hi)], ENV).coalesce(1).write.mode("append").parquet(path)


def _expected(n, keys=20):
    table = {}
    for i in range(n):
        if i % 7 == 6:
            table.pop(i % keys, None)
        else:
            old = table.get(i % keys, (None, None))
            table[i % keys] = (i, Decimal(f"{i}.25") if i % 3 != 2 else old[1])
    return table


def _got(app):
    return {r["id"]: (r["user_id"], r["total"]) for r in app.stores["orders"].read().collect()}


def test_stream_restart_and_drain(spark, tmp_path):
    src, store = str(tmp_path / "in"), str(tmp_path / "store")
    for lo, hi in ((0, 30), (30, 37), (37, 100)):
        _write(spark, src, lo, hi)
    app = Applier(spark, SourceConfig(path=src, max_files_per_trigger=1), store, buckets=2)
    app.run()
    assert _got(app) == _expected(100)
    _write(spark, src, 100, 160)
    again = Applier(spark, SourceConfig(path=src, max_files_per_trigger=1), store, buckets=2, consumer=ConsumerConfig(enable_batch=False))
    again.run()  # goes on from the checkpoint
    assert _got(again) == _expected(160)
    _write(spark, src, 160, 200)
    third = Applier(spark, SourceConfig(path=src), store, buckets=2, consumer=ConsumerConfig(flush_interval_ms=100))
    q = third.start()
    q.processAllAvailable()
    assert third.drain() == {"drained": True} and not q.isActive
    assert _got(third) == _expected(200)
    with pytest.raises(ValueError):
        Applier(spark, SourceConfig(path=store), store)


def test_unreadable_events(spark, tmp_path, caplog):
    src = str(tmp_path / "in")
    spark.createDataFrame([event(after=cells(id=1, total=1)), ("t", 1, "{no json")], ENV).coalesce(1).write.parquet(src)
    with pytest.raises(Exception, match="no JSON"):
        Applier(spark, SourceConfig(path=src), str(tmp_path / "a")).run(sleep=lambda s: None)
    app = Applier(spark, SourceConfig(path=src), str(tmp_path / "b"), on_error="quarantine")
    app.run()
    assert list(_got(app)) == [1] and "no JSON" in caplog.text
    assert [r["value"] for r in spark.read.parquet(str(tmp_path / "b/_quarantine/_unreadable/batch=0")).collect()] == ["{no json"]
    assert app.stores["users"].manifest()["version"] == -1  # no events, no commit


def test_stream_fails_loudly_or_quarantines(spark, tmp_path, caplog):
    src = str(tmp_path / "in")
    spark.createDataFrame([event(after=cells(id=1, total=1)), event(op="x", after=cells(id=2), seq=1)], ENV).coalesce(1).write.parquet(src)
    with pytest.raises(Exception, match="unknown op x"):
        Applier(spark, SourceConfig(path=src), str(tmp_path / "a")).run(sleep=lambda s: None)
    app = Applier(spark, SourceConfig(path=src), str(tmp_path / "b"), on_error="quarantine")
    app.run()
    assert list(_got(app)) == [1]
    assert spark.read.parquet(str(tmp_path / "b/_quarantine/orders/batch=0")).count() == 1
    assert "unknown op x (1, first at 1)" in caplog.text
    caplog.clear()
    Applier(spark, SourceConfig(path=src, log_error_messages=False), str(tmp_path / "c"), on_error="quarantine").run()
    assert "1 events of batch 0 set aside" in caplog.text and "unknown op" not in caplog.text


def test_simulator(spark):
    spark.dataSource.register(ChangeLogSimulator)
    df = spark.read.format("changelog_simulator").option("events", 100).option("keys", 20).load()
    good, _ = env.check(env.decode(env.parse(df), ORDERS))
    net = live_rows(fold_changes(good, "id", ORDERS.values), "id", ORDERS.values)
    assert {r["id"]: (r["user_id"], r["total"]) for r in net.collect()} == _expected(100)


@pytest.mark.parametrize("name, route, table", [("orders", "sales_orders", "Sales_Orders"), ("Parts", None, "Parts")])
def test_registered_table(spark, tmp_path, name, route, table):
    from pyspark.sql import types as T

    from deltaloom.config import SourceConfig
    from deltaloom.specs import Registry, TableSpec
    from deltaloom.streaming.apply import Applier

    registry = Registry().register(TableSpec(name, {"id": T.LongType(), "v": T.StringType()}), route)
    value = '{"op": "c", "after": {"id": {"value": 1}, "v": {"value": "x"}}, "source": {"table": "%s"}}' % table
    a = Applier(spark, SourceConfig(path=str(tmp_path / "in")), str(tmp_path / "out"), registry=registry, buckets=1)
    a.handle_batch(spark.createDataFrame([("t", 1, value)], "topic string, seq long, value string"), 0)
    (store,) = a.stores.values()
    assert [(r["id"], r["v"]) for r in store.read().collect()] == [(1, "x")]
