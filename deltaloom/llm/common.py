"""What the operators share: the shared folder, materialised tables, Arrow plumbing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import shared_dir

#: Characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_SPACE = " \t\n\x0b\x0c\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Folders that materialize wrote and nobody has released yet.
_written: list[str] = []


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends, lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/deltaloom-{uuid.uuid4().hex}"
    # Shuffle files of what is written go at once, not when the driver happens to collect its garbage.
    was = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, was)
    out = spark.read.schema(df.schema).parquet(path)
    out._deltaloom_path = path  # noqa: SLF001
    _written.append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)  # noqa: SLF001
    if path in _written:
        _written.remove(path)


def release(df: DataFrame) -> None:
    """Delete what materialize wrote, once nothing reads it any more."""
    path = getattr(df, "_deltaloom_path", None)
    if path:
        _delete(df.sparkSession, path)


def release_all(spark: SparkSession) -> int:
    """Delete all that materialize wrote and that is still there: for callers that have written their results. How many folders."""
    n = len(_written)
    for path in list(_written):
        _delete(spark, path)
    return n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text):
    """Words of a text column as an array of strings; null or blank text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPLIT))


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, one more than rows, from 0) and bytes of a string column; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    o = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return o - o[0], b


def slices(batches: Iterator[pa.RecordBatch], col: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that col holds about `most` bytes at a time (one row at least): memory stays bounded."""
    for b in batches:
        off, _ = string_buffers(b.column(b.schema.get_field_index(col)))
        at = 0
        while at < b.num_rows:
            to = int(np.searchsorted(off, off[at] + most, side="right")) - 1
            to = min(max(to, at + 1), b.num_rows)
            yield b.slice(at, to - at)
            at = to


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 (the finaliser of a well-known 64-bit hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
