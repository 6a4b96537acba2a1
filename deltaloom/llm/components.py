"""Connected components of an edge table, in the cluster: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import materialize, release


def _star(edges: DataFrame, large: bool) -> tuple[DataFrame, DataFrame]:
    """Hang the neighbours of each node on the smallest node around: the larger ones (large) or the smaller ones. The edges, and the table of each node's smallest.

    The smallest of a large star is a table of its own, so that the join with it can split the rows of a node that has
    a third of all others for neighbours. In a small star a node has few: the large one before has hung the others elsewhere.
    """
    e = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        e = e.union(e.select("v", "u"))
    else:
        e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    least = materialize(least) if large else least
    joined = e.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    out = out.filter("a <> b")
    return (out if large else out.distinct()), least


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; edges: a, b long; component is the smallest node reachable.

    Ends when a round changes nothing, after about log(nodes) rounds. An empty table gives no rows.
    """
    now = materialize(edges.select("a", "b").filter("a <> b").distinct())
    state = None
    for _ in range(most_rounds):
        seen = Observation()
        spread, least = _star(now, True)
        was, now = now, materialize(_star(spread, False)[0].observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")))
        release(was)
        release(least)
        r = seen.get
        if state == (r["n"], r["h"]):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        state = (r["n"], r["h"])
    raise RuntimeError("components did not settle")
