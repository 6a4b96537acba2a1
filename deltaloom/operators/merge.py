"""Apply net changes to a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import TableSpec
from .fold import fold_changes


def apply_net(target: DataFrame, net: DataFrame, spec: TableSpec, may_clear: tuple[str, ...] = ()) -> DataFrame:
    """Full outer join on the key: absent change keeps the row, a dead one drops it, a reset one replaces it, any other fills in its non-null columns."""
    t, n = target.alias("t"), net.alias("n")
    tk, nk = F.col(f"t.{spec.key}"), F.col(f"n.{spec.key}")

    def value(c: str):
        new, old = F.col(f"n.{c}"), F.col(f"t.{c}")
        kept = F.when(F.col(f"n.{c}__set"), new).otherwise(old) if c in may_clear else F.coalesce(new, old)
        return F.when(nk.isNull(), old).when(F.col("n.reset"), new).otherwise(kept).cast(spec.columns[c]).alias(c)

    return t.join(n, tk == nk, "full_outer").filter(nk.isNull() | F.col("n.alive")).select(F.coalesce(tk, nk).cast(spec.columns[spec.key]).alias(spec.key), *(value(c) for c in spec.values))


def upsert(target: DataFrame, rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Insert or fill in: rows hold each key once; a null column keeps what is stored."""
    net = rows.select("*", F.lit(False).alias("reset"), F.lit(True).alias("alive"))
    return apply_net(target, net, spec)


def delete(target: DataFrame, keys: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows whose key is not among the keys."""
    return target.join(keys.select(spec.key), spec.key, "left_anti").select(*spec.columns)


def apply_changes(target: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Fold and merge: target after all changes (columns of spec, op, seq)."""
    return apply_net(target, fold_changes(changes, spec.key, spec.values), spec)


def empty_table(spark, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)
