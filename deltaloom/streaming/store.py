"""A versioned keyed table in files.

`<path>/data/<version>-<unique>/b=<bucket>/` holds Parquet, bucketed by key hash; `<path>/_manifest/<n>.json` names, for
each bucket, the folder that holds it, and the last batch applied. A commit folds the batch and rewrites only the
buckets that it touches, into a folder of its own; large buckets are written by several tasks, as many as their size asks for.
It then publishes the next manifest by the protocol of Spark's own checkpoints: whoever comes second to a
version fails, removes what it wrote and may try again on top of the first. Delivering a batch twice changes nothing.
All paths go through Hadoop's file systems. On stores that cannot rename atomically, set the checkpoint file manager
that Spark's streaming needs there as well (spark.sql.streaming.checkpointFileManagerClass).
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fold import fold_changes
from ..operators.merge import apply_net, empty_table
from ..specs import TableSpec
from .retry import RecoverableError


class CommitConflict(RecoverableError):
    """Another writer published this version first."""


class KeyedStore:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, buckets: int = 16, honor_set: bool = False, guard_order: bool = False) -> None:
        self.spark, self.path, self.spec, self.buckets = spark, path.rstrip("/"), spec, buckets
        self.honor_set, self.guard_order = honor_set, guard_order
        self._jvm = spark.sparkContext._jvm  # noqa: SLF001
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001

    def _path(self, rest: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{rest}" if rest else self.path)

    def _read_text(self, rest: str) -> str:
        stream = self._fs.open(self._path(rest))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def manifest(self) -> dict:
        """The newest published manifest; version -1 before the first commit."""
        at = self._path("_manifest")
        found = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        versions = [int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit()]
        return json.loads(self._read_text(f"_manifest/{max(versions)}.json")) if versions else {"version": -1, "last_batch_id": -1, "last_seq": None, "buckets": self.buckets, "parts": {}}

    def _publish(self, m: dict) -> None:
        """Put the next manifest there, whole, unless that version exists."""
        self._fs.mkdirs(self._path("_manifest"))
        final = self._path(f"_manifest/{m['version']}.json")
        files = self._jvm.org.apache.spark.sql.execution.streaming.checkpointing.CheckpointFileManager.create(self._path("_manifest"), self.spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
        try:
            if self._fs.exists(final):
                raise CommitConflict(f"version {m['version']} of {self.path} is there already")
            out = files.createAtomic(final, False)
            try:
                out.write(bytearray(json.dumps(m).encode()))
            except BaseException:
                out.cancel()
                raise
            out.close()
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
                raise CommitConflict(f"version {m['version']} of {self.path} is there already") from e
            raise

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The table as of the newest version."""
        parts = self.manifest()["parts"]
        found = [f"{self.path}/data/{v}/b={b}" for b, v in parts.items() if buckets is None or int(b) in buckets]
        if not found:
            return empty_table(self.spark, self.spec)
        return self.spark.read.schema(self.spec.schema).parquet(*found)

    def commit(self, changes: DataFrame, batch_id: int | None) -> bool:
        """Apply a batch of decoded changes (seq, op, columns); False if it had been applied before. None: changes that are no batch of a stream, always applied."""
        m = self.manifest()
        if batch_id is not None and batch_id <= m["last_batch_id"]:
            return False
        spec, clear = self.spec, tuple(self.spec.values) if self.honor_set else ()
        if self.guard_order and m["last_seq"] is not None:
            changes = changes.filter(F.col("seq") > m["last_seq"])
        net = fold_changes(changes, spec.key, spec.values, may_clear=clear).withColumn("_b", self._bucket(m["buckets"])).persist()
        try:
            touched = net.groupBy("_b").agg(F.max("last_seq").alias("s")).collect()  # one row per bucket
            last = max([r["s"] for r in touched if r["s"] is not None] + ([m["last_seq"]] if m["last_seq"] is not None else []), default=None)
            new = {"version": m["version"] + 1, "last_batch_id": m["last_batch_id"] if batch_id is None else batch_id, "last_seq": last, "buckets": m["buckets"]}
            which = [r["_b"] for r in touched]
            self._put(apply_net(self.read(which), net, spec, clear) if which else None, new, m["parts"], which)
            return True
        finally:
            net.unpersist()

    def _bucket(self, buckets: int):
        return F.pmod(F.hash(self.spec.key), F.lit(buckets)).cast("int")

    def _put(self, rows: DataFrame | None, new: dict, parts: dict, which: list[int]) -> None:
        """Write rows as the buckets `which`, beside the other parts, and publish; on failure nothing of it stays."""
        folder = f"{new['version']}-{uuid.uuid4().hex}"
        parts = {b: v for b, v in parts.items() if int(b) not in which}
        try:
            if rows is not None:
                # Rebalancing splits a large bucket over tasks and keeps small ones whole, by the sizes found at run time.
                rows.withColumn("b", self._bucket(new["buckets"])).hint("rebalance", "b").write.partitionBy("b").parquet(f"{self.path}/data/{folder}")
                found = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"data/{folder}"))]
                parts |= {n[2:]: folder for n in found if n.startswith("b=")}
            self._publish({**new, "parts": parts})
        except BaseException:
            self._fs.delete(self._path(f"data/{folder}"), True)
            raise

    def rebucket(self, buckets: int) -> None:
        """Write the whole table anew with another number of buckets."""
        if buckets < 1:
            raise ValueError("buckets must be 1 or more")
        m = self.manifest()
        self._put(self.read() if m["parts"] else None, {"version": m["version"] + 1, "last_batch_id": m["last_batch_id"], "last_seq": m["last_seq"], "buckets": buckets}, {}, [])

    def load(self, rows: DataFrame) -> bool:
        """Take rows as the table's first content; False if it has some already."""
        if self.manifest()["version"] >= 0:
            return False
        return self.write(rows)

    def _as_changes(self, rows: DataFrame, op: str, cols: list) -> DataFrame:
        sets = [F.lit(False).alias(f"{c}__set") for c in self.spec.values] if self.honor_set else []
        return rows.select(F.lit(0).cast("long").alias("seq"), F.lit(op).alias("op"), *cols, *sets)

    def write(self, rows: DataFrame) -> bool:
        """Upsert rows given as such, each key once."""
        return self._apart(self._as_changes(rows, "u", list(self.spec.columns)))

    def delete(self, keys: DataFrame) -> bool:
        cols = [F.lit(None).cast(t).alias(c) if c != self.spec.key else F.col(c) for c, t in self.spec.columns.items()]
        return self._apart(self._as_changes(keys, "d", cols))

    def _apart(self, changes: DataFrame) -> bool:
        """Rows from outside the stream have no position: the guard of the order does not hold for them."""
        was, self.guard_order = self.guard_order, False
        try:
            return self.commit(changes, None)
        finally:
            self.guard_order = was

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete data folders of published versions that none of the last `keep` manifests names; returns them. Folders of commits under way stay."""
        newest = self.manifest()["version"]
        used: set[str] = set()
        for v in range(max(0, newest - keep + 1), newest + 1):
            if self._fs.exists(self._path(f"_manifest/{v}.json")):
                used |= set(json.loads(self._read_text(f"_manifest/{v}.json"))["parts"].values())
        gone = []
        if self._fs.exists(self._path("data")):
            for f in self._fs.listStatus(self._path("data")):
                name = f.getPath().getName()
                if name not in used and int(name.split("-")[0]) <= newest:
                    self._fs.delete(f.getPath(), True)
                    gone.append(name)
        return sorted(gone)
