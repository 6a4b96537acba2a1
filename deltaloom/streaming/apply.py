"""The applier: a change stream into keyed stores."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import ConsumerConfig, RetryConfig, SourceConfig
from ..sources import envelope as env
from ..sources.readers import stream_changes
from ..specs import Registry, default_registry
from .retry import backoff_schedule, is_retryable, with_retry
from .store import KeyedStore

log = logging.getLogger(__name__)


class Applier:
    """Decode each micro-batch once, then fold and commit it table by table. The checkpoint moves on only when all tables have committed.

    snapshot: route -> rows as they stand at the source (or a function that reads them), taken into tables that have no content
    yet before the stream goes on, as snapshot_mode says; changes must begin where the snapshot was taken, or earlier.
    """

    def __init__(
        self, spark: SparkSession, source: SourceConfig, store_path: str, *, registry: Registry | None = None, consumer: ConsumerConfig | None = None, retry: RetryConfig | None = None,
        on_error: str = "fail", honor_set: bool = False, buckets: int = 16, snapshot: Mapping[str, DataFrame | Callable[[], DataFrame]] | None = None,
    ) -> None:
        if source.path and source.path.rstrip("/") == store_path.rstrip("/"):
            raise ValueError("source and store must be different paths")
        self.spark, self.source, self.on_error, self.honor_set = spark, source, on_error, honor_set
        self.registry, self.consumer, self.retry = registry or default_registry(), consumer or ConsumerConfig(), retry or RetryConfig()
        self.store_path = store_path.rstrip("/")
        self.stores = {route: KeyedStore(spark, f"{self.store_path}/{route}", spec, buckets, honor_set) for route, spec in self.registry.items()}
        self.snapshot = {route.lower(): rows for route, rows in (snapshot or {}).items()}
        if unknown := set(self.snapshot) - set(self.stores):
            raise ValueError(f"snapshot of unknown tables {sorted(unknown)}")
        self.query: StreamingQuery | None = None
        self.failure: BaseException | None = None

    def take_snapshot(self) -> list[str]:
        """Load the snapshot into tables without content, as snapshot_mode says; the routes loaded."""
        if self.source.snapshot_mode == "never":
            return []
        done = []
        for route, rows in self.snapshot.items():
            store = self.stores[route]
            if store.manifest()["version"] < 0:
                taken = rows() if callable(rows) else rows
                with_retry(lambda: store.load(taken), self.retry)  # noqa: B023
                done.append(route)
        return done

    def handle_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Apply one micro-batch; a batch that was applied before changes nothing."""
        try:
            self._handle(batch, batch_id)
        except BaseException as e:
            self.failure = e  # the streaming query only passes its text on
            raise

    def _handle(self, batch: DataFrame, batch_id: int) -> None:
        cfg = self.source
        if cfg.provide_transaction_metadata:
            env.transactions(batch, cfg.payload).write.mode("overwrite").parquet(f"{self.store_path}/_transactions/batch={batch_id}")
        slots = self.spark.sparkContext.defaultParallelism
        if 2 * batch.rdd.getNumPartitions() <= slots:  # a few large files: parsing is dear, moving text is not
            batch = batch.repartition(slots)
        parsed = env.routed(env.include(env.parse(batch, cfg.payload), cfg.tables, cfg.schemas), self.registry)
        # The text is of use only where it could not be read.
        parsed = parsed.withColumn("value", F.when(F.col("e").isNull(), F.col("value"))).persist()
        try:
            # A row for each table that has events: the others have nothing to commit.
            found = {r["route"]: r["n"] for r in parsed.groupBy(F.when(F.col("e").isNotNull(), F.lower("table")).alias("route")).agg(F.count("*").alias("n")).collect()}
            if None in found:
                self._unreadable(parsed.filter("e IS NULL"), found.pop(None), batch_id)
            readable = parsed.filter("e IS NOT NULL")
            # Small tables and large ones commit side by side; Spark shares the executors among them.
            with ThreadPoolExecutor(max_workers=4) as pool:
                for done in [pool.submit(self._one, readable, route, batch_id) for route in found]:
                    done.result()
        finally:
            parsed.unpersist()

    def _unreadable(self, rows: DataFrame, n: int, batch_id: int) -> None:
        """Events that are no JSON belong to no table."""
        if self.on_error != "quarantine":
            raise env.ChangeFormatError(f"bad change: no JSON, in {n} events of batch {batch_id}")
        rows.select("seq", "op", F.lit("no JSON").alias("error"), "value").write.mode("overwrite").parquet(f"{self.store_path}/_quarantine/_unreadable/batch={batch_id}")
        log.warning("%d events of batch %d are no JSON; set aside", n, batch_id)

    def _one(self, parsed: DataFrame, route: str, batch_id: int) -> None:
        store = self.stores[route]
        good, bad = env.check(env.decode(parsed, store.spec, self.source.ts_unit, self.honor_set, route), self.on_error)
        if bad is not None:
            at = f"{self.store_path}/_quarantine/{route}/batch={batch_id}"
            bad.select("seq", "op", "error").write.mode("overwrite").parquet(at)
            self._log_bad(self.spark.read.schema("seq long, op string, error string").parquet(at), route, batch_id)
        with_retry(lambda: store.commit(good, batch_id), self.retry)

    def _log_bad(self, bad: DataFrame, route: str, batch_id: int) -> None:
        n = bad.count()
        if n and self.source.log_error_messages:
            most = bad.groupBy("error").agg(F.count("*").alias("n"), F.min("seq").alias("seq")).orderBy(F.desc("n"), "error").limit(20).collect()
            log.warning("%s: %d events of batch %d set aside: %s", route, n, batch_id, "; ".join(f"{r['error']} ({r['n']}, first at {r['seq']})" for r in most))
        elif n:
            log.warning("%s: %d events of batch %d set aside", route, n, batch_id)

    def trigger(self) -> dict[str, str]:
        """How often a micro-batch starts: after flush_interval_ms in batch mode; in direct mode as often as the source is polled."""
        return {"processingTime": f"{self.consumer.flush_interval_ms if self.consumer.enable_batch else self.source.poll_interval_ms} milliseconds"}

    def start(self, available_now: bool = False) -> StreamingQuery:
        self.failure = None
        rows = self.consumer.queue_capacity * len(self.stores) if self.consumer.enable_batch and self.source.max_queue_size else None
        writer = stream_changes(self.spark, self.source, rows).writeStream.foreachBatch(self.handle_batch).option("checkpointLocation", self.source.checkpoint or f"{self.store_path}/_checkpoint")
        self.query = writer.trigger(**({"availableNow": True} if available_now else self.trigger())).start()
        return self.query

    def drain(self) -> dict:
        """Stop after what has come is applied, or drain_interval_ms have passed; says whether anything was left."""
        q, until = self.query, time.monotonic() + self.consumer.drain_interval_ms / 1000
        if q is None:
            return {"drained": True}
        while q.isActive and (q.status["isDataAvailable"] or q.status["isTriggerActive"]) and time.monotonic() < until:
            time.sleep(0.05)
        left = q.isActive and (q.status["isDataAvailable"] or q.status["isTriggerActive"])
        q.stop()
        if left:
            log.warning("stopped with changes pending; they come again from the checkpoint")
        return {"drained": not left}

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()

    def run(self, available_now: bool = True, sleep=time.sleep) -> None:
        """Snapshot, then stream under supervision: restart after failures worth another try, give up after the last."""
        self.take_snapshot()
        if self.source.snapshot_mode == "initial_only":
            return
        waits = backoff_schedule(self.retry)
        for wait in [*waits, None]:
            try:
                self.start(available_now).awaitTermination()
                return
            except Exception as e:
                self.stop()
                if wait is None or not is_retryable(self.failure or e):
                    log.exception("the change stream stopped")
                    raise
                log.warning("the change stream starts again in %d ms after %s", wait, self.failure or e)
                sleep(wait / 1000)
