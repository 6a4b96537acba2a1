"""The write plan of a consumer that applies consecutive writes, or consecutive deletes, in batches.

Runs are counted in pieces of the log, cut where positions divide it evenly, and what stands before each piece is
carried over from one row a piece: no task holds more than a piece, however few parts there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE_ROWS = 1_000_000
MOST_PIECES = 1000


def _piece(changes: DataFrame, seq: str, rows: int) -> Column:
    """Number of the piece that a position falls into; the cuts are approximate quantiles of all positions."""
    n = min(MOST_PIECES, -(-changes.count() // rows))
    if n < 2:
        return F.lit(0)
    cuts = changes.agg(F.percentile_approx(seq, [i / n for i in range(1, n)], 10_000)).first()[0]
    bounds = F.array(*(F.lit(c) for c in sorted(set(cuts))))
    return F.size(F.filter(bounds, lambda b: b <= F.col(seq)))


def plan_batches(changes: DataFrame, batch_size: int, part: str = "table", seq: str = "seq", op: str = "op", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Add kind, run_id (a new run at each change of kind) and batch_id (every batch_size rows of a run) within each part."""
    cols = changes.columns
    kind = F.when(F.col(op) == "d", "delete").otherwise("write")
    rows = changes.withColumns({"kind": kind, "_piece": _piece(changes, seq, piece_rows)})
    w = Window.partitionBy(part, "_piece").orderBy(seq)
    rows = rows.withColumn("_new", F.coalesce(F.lag("kind").over(w) != F.col("kind"), F.lit(True)).cast("long"))
    rows = rows.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_place", F.row_number().over(Window.partitionBy(part, "_piece", "_run").orderBy(seq)) - 1)
    # One row a piece: its rows, its runs, the kinds at its ends, the length of its last run.
    ends = rows.groupBy(part, "_piece").agg(
        F.count("*").alias("n"), F.max("_run").alias("runs"), F.min_by("kind", seq).alias("first"), F.max_by(F.struct("kind", "_place"), seq).alias("last")
    )
    p = Window.partitionBy(part).orderBy("_piece")
    goes_on = F.coalesce(F.lag("last.kind").over(p) == F.col("first"), F.lit(False))
    ends = ends.withColumn("_on", goes_on).withColumn("_fresh", ((F.col("runs") > 1) | ~F.col("_on")).cast("long"))
    ends = ends.withColumn("_group", F.sum("_fresh").over(p.rowsBetween(Window.unboundedPreceding, 0)))
    tail = F.when(F.col("_fresh") == 1, F.col("last._place") + 1).otherwise(F.col("n"))
    ends = ends.withColumn("_tail", F.sum(tail).over(Window.partitionBy(part, "_group").orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.withColumn("_runs", F.sum(F.col("runs") - F.col("_on").cast("long")).over(p.rowsBetween(Window.unboundedPreceding, 0)))
    carried = ends.select(
        F.col(part).alias("_part"), F.col("_piece").alias("_of"), (F.col("_runs") - F.col("runs")).alias("_before"),
        F.when(F.col("_on"), F.lag("_tail").over(p)).otherwise(F.lit(0)).alias("_carry"),
    )
    out = rows.join(carried, F.col(part).eqNullSafe(F.col("_part")) & (F.col("_piece") == F.col("_of")))
    place = F.col("_place") + F.when(F.col("_run") == 1, F.col("_carry")).otherwise(F.lit(0))
    return out.select(*cols, "kind", (F.col("_run") + F.col("_before")).alias("run_id"), F.floor(place / batch_size).cast("long").alias("batch_id"))


def batches(changes: DataFrame, batch_size: int, part: str = "table", seq: str = "seq", op: str = "op") -> DataFrame:
    """One row per batch: part, run_id, batch_id, kind, rows, first and last position."""
    return plan_batches(changes, batch_size, part, seq, op).groupBy(part, "run_id", "batch_id", "kind").agg(F.count("*").alias("n_rows"), F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"))
