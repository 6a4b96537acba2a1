"""The net effect of each key's changes.

Replaying a key's changes in order (write: new value or else the old one; delete: forget the row) has a closed
form. With `ld` the position of the last delete, each column is its last non-null value among writes after `ld`,
and the row lives unless the last change is a delete. One shuffle by key; map-side combined, so a key with a
third of all changes costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELETE = "d"


def _last(value: Column, seq: Column, when: Column) -> Column:
    """Last value by position where `when` holds, null if none; both arguments masked, as max_by keeps nulls."""
    return F.max_by(F.when(when, value), F.when(when, seq))


def fold_changes(changes: DataFrame, key: str, columns: Sequence[str], seq: str = "seq", op: str = "op", may_clear: Sequence[str] = ()) -> DataFrame:
    """(key, columns..., reset, alive, last_seq), one row per key.

    Two-step aggregation over one exchange: the last value after the last delete equals the last value overall
    if its position lies after the last delete, so positions are aggregated beside the values and compared then.
    may_clear: columns where an explicit null (flag column `<c>__set`) clears the value.
    """
    d, s = F.col(op) == DELETE, F.col(seq)
    aggs = [F.max(F.when(d, s)).alias("_ld"), F.max(s).alias("last_seq"), F.max_by(d, s).alias("_dead")]
    for c in columns:
        there = ~d & (F.col(c).isNotNull() | F.col(f"{c}__set")) if c in may_clear else ~d & F.col(c).isNotNull()
        aggs += [F.max(F.when(there, s)).alias(f"_s_{c}"), _last(F.col(c), s, there).alias(f"_v_{c}")]
    g = changes.groupBy(key).agg(*aggs)
    after = lambda c: F.when(F.col("_ld").isNull() | (F.col(f"_s_{c}") > F.col("_ld")), F.col(f"_v_{c}"))
    sets = [(F.col("_ld").isNull() & F.col(f"_s_{c}").isNotNull() | (F.col(f"_s_{c}") > F.col("_ld"))).alias(f"{c}__set") for c in may_clear]
    return g.select(key, *(after(c).alias(c) for c in columns), *sets, F.col("_ld").isNotNull().alias("reset"), (~F.col("_dead")).alias("alive"), "last_seq")


def live_rows(net: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return net.filter("alive").select(key, *columns)


def compose(first: DataFrame, then: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The net change of two net changes in order; associative."""
    a, b = first.alias("a"), then.alias("b")
    one, two = F.col(f"a.{key}"), F.col(f"b.{key}")
    pick = [
        F.when(two.isNull(), F.col(f"a.{c}")).when(F.col("b.reset") | one.isNull(), F.col(f"b.{c}")).otherwise(F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}"))).alias(c)
        for c in columns
    ]
    return a.join(b, one == two, "full_outer").select(
        F.coalesce(one, two).alias(key), *pick,
        (F.coalesce(F.col("a.reset"), F.lit(False)) | F.coalesce(F.col("b.reset"), F.lit(False))).alias("reset"),
        F.coalesce(F.col("b.alive"), F.col("a.alive")).alias("alive"),
        F.greatest("a.last_seq", "b.last_seq").alias("last_seq"),
    )


def reject_ties(changes: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Positions that a key has more than once: the order would be undefined. Empty if the log is sound."""
    return changes.groupBy(key, seq).agg(F.count("*").alias("n")).filter("n > 1")
