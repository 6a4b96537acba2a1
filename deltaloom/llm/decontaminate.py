"""Benchmark decontamination by SimHash windows.

Texts become lower-case words of letters and digits; windows are as long as the benchmark item they are held
against, and carry multisets of five-word shingles. A window of similarity 0.8 shares 0.8 of the item's shingles at least, so it
shares one of the item's rarest m - 0.8 m + 1: only these (rare among the items, that is) make candidates, and a
phrase that many items have in common makes none. In a candidate's text a window can only reach the similarity if enough of its shingles are the
item's, and a best one begins with a shared shingle; windows are taken there. Windows get a 64-bit SimHash; eight blocks of eight bits, each probed up to two
bits off, find every item fingerprint of that length within RADIUS (23 = 3 * 8 - 1: by the pigeonhole principle
some block is at most two bits off). Candidates are then verified exactly: similarity is the sum of least counts
over the sum of greatest counts of the shingles of both.

Two multisets of similarity 0.8 differ by 9.7 bits on average with a deviation of 2.9: the radius lies 4.8
deviations beyond.

DataFrame functions only. The rare shingles of the benchmark are broadcast if they number at most BROADCAST_ROWS, else joined by
a shuffle; every other join is left to sizes. Documents shorter than an item are held against it whole.

Null and empty texts, and items or documents of fewer than five words, have no shingle: they match nothing.
Repeated rows of one id count as one document, different texts under one id are each held against the items, rows
without an id are not looked at (and stay); of several texts of one item the least counts; an empty table on either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, release

K = 5
RADIUS = 23
BROADCAST_ROWS = 200_000
_SEPARATOR = r"[^\p{L}\p{N}]+"


def shingles(text: Column) -> Column:
    """Hashes of the five-word shingles of a text, in order."""
    # One-element arrays name the word hashes, which are used five times.
    hashes = F.transform(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATOR), ""), lambda x: F.xxhash64(x))

    def windows(w: Column) -> Column:
        n = F.size(w)
        return F.when(n >= K, F.transform(F.sequence(F.lit(0), n - K), lambda i: F.xxhash64(*(w[i + j] for j in range(K))))).otherwise(F.array().cast("array<bigint>"))

    return F.transform(F.array(hashes), windows)[0]


def fingerprints(rows: DataFrame, keys: list[str], window: str) -> DataFrame:
    """keys and fp: the 64-bit SimHash of an array of hashes. Two 32-bit counters share a long, so 32 sums make 64 counts."""
    h = F.col("_h")
    spread = [(F.shiftrightunsigned(h, b).bitwiseAND(F.lit(1).cast("long"))) + F.shiftleft(F.shiftrightunsigned(h, b + 32).bitwiseAND(F.lit(1).cast("long")), 32) for b in range(32)]
    sums = rows.select(*keys, F.explode(window).alias("_h")).groupBy(*keys).agg(F.count("*").alias("_n"), *(F.sum(x).alias(f"_{b}") for b, x in enumerate(spread)))
    low = F.lit(0xFFFFFFFF).cast("long")
    fp = F.lit(0).cast("long")
    for b in range(32):
        for at, count in ((b, F.col(f"_{b}").bitwiseAND(low)), (b + 32, F.shiftrightunsigned(F.col(f"_{b}"), 32))):
            fp = fp.bitwiseOR(F.when(2 * count > F.col("_n"), F.shiftleft(F.lit(1).cast("long"), at)).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fp.alias("fp"))


def _block(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255).cast("long")).cast("int")


def _blocks(fp: Column) -> Column:
    return F.array(*(F.struct(F.lit(i).alias("block"), _block(fp, i).alias("value")) for i in range(8)))


def _probes(fp: Column) -> Column:
    """Blocks and every value up to two bits off."""
    off = [0, *(1 << a for a in range(8)), *(1 << a | 1 << b for a in range(8) for b in range(a))]
    flips = F.array(*(F.lit(x) for x in off))
    return F.flatten(F.transform(_blocks(fp), lambda s: F.transform(flips, lambda x: F.struct(s["block"].alias("block"), s["value"].bitwiseXOR(x).alias("value")))))


def shared(a: Column, b: Column) -> Column:
    """Sum of the least counts of two multisets of hashes."""
    both = F.array_intersect(a, b)
    count = lambda arr, x: F.size(F.filter(arr, lambda y: y == x))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    # Where one side repeats nothing, each shared hash counts once.
    return F.when(plain, F.size(both)).otherwise(F.aggregate(both, F.lit(0), lambda acc, x: acc + F.least(count(a, x), count(b, x))))


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", similarity: float = 0.8,
) -> DataFrame:
    """(id_col, item_col, start, similarity): the best window of each document for each item that reaches the similarity.

    start counts words from 0; a document's best window is the first of the most similar that begin with a shared shingle.
    """
    items = benchmark.select(F.col(item_col).alias("item"), shingles(F.col(item_text)).alias("t")).filter(F.col("item").isNotNull() & (F.size("t") > 0))
    items = items.groupBy("item").agg(F.min("t").alias("t"))
    items = materialize(items.withColumn("m", F.size("t")))
    least = F.ceil(F.col("m") * F.lit(similarity) - 1e-9).cast("int")
    item_marks = items.select("item", "m", F.explode("t").alias("h"))
    holders = item_marks.groupBy("h").agg(F.count_distinct("item").alias("f"))
    ranked = item_marks.join(holders, "h").groupBy("item", "m").agg(F.array_sort(F.collect_list(F.struct("f", "h"))).alias("r"))
    rare = ranked.select("item", F.explode(F.array_distinct(F.slice("r", F.lit(1), F.col("m") - least + 1))).alias("x")).select("item", "x.h")
    rare = materialize(rare.groupBy("h").agg(F.collect_set("item").alias("items")))
    n_rare = rare.count()
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("sub"), F.col(text_col).alias("text")).filter("id IS NOT NULL")
    places = source.select("id", "sub", F.explode(F.array_distinct(shingles(F.col("text")))).alias("h"))
    hits = places.join(F.broadcast(rare) if n_rare <= BROADCAST_ROWS else rare, "h")
    pairs = materialize(hits.select("id", "sub", F.explode("items").alias("item")).distinct())
    ids = materialize(pairs.select("id", "sub").distinct())
    # Few documents hold shared passages; if the list of them is small it is broadcast (by its size on disk), else joined by a shuffle.
    texts = source.join(ids, ["id", "sub"], "left_semi").dropDuplicates(["id", "sub"])
    texts = materialize(texts.select("id", "sub", shingles(F.col("text")).alias("s")))
    release(ids)
    spots = pairs.join(texts, ["id", "sub"]).select("id", "sub", "item", F.size("s").alias("n"), F.posexplode("s").alias("p", "h"))
    spots = spots.join(item_marks.distinct(), ["item", "h"]).groupBy("id", "sub", "item", "n", "m").agg(F.sort_array(F.collect_list("p")).alias("at"))
    # A window is worth a look if the last of the shared shingles that it needs lies within it.
    dense = F.filter("at", lambda p, i: F.coalesce(F.get(F.col("at"), i + least - 1) < p + F.col("m"), F.lit(False)))
    last = F.greatest(F.col("n") - F.col("m"), F.lit(0))
    starts = materialize(spots.select("id", "sub", "m", last.alias("last"), F.explode(dense).alias("p")).select("id", "sub", "m", F.least("p", "last").alias("start")).distinct())
    windows = materialize(starts.join(texts, ["id", "sub"]).select("id", "sub", "m", "start", F.slice("s", F.col("start") + 1, F.col("m")).alias("w")))
    release(pairs)
    release(texts)
    release(starts)
    probes = fingerprints(items, ["item", "m"], "t").select("item", "m", "fp", F.explode(_probes(F.col("fp"))).alias("b")).select("item", "m", F.col("fp").alias("ifp"), "b.block", "b.value")
    key = ["id", "sub", "m", "start"]
    blocks = fingerprints(windows, key, "w").select(*key, "fp", F.explode(_blocks(F.col("fp"))).alias("b")).select(*key, "fp", "b.block", "b.value")
    near = blocks.join(probes, ["m", "block", "value"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS).select(*key, "item").distinct()
    both = near.join(windows, key).join(items.select("item", "t"), "item").withColumn("x", shared(F.col("w"), F.col("t")))
    scored = both.select("id", "item", "start", (F.col("x") / (F.size("w") + F.size("t") - F.col("x"))).alias("similarity")).filter(F.col("similarity") >= similarity)
    best = scored.groupBy("id", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), (-F.col("b.s")).alias("start"), F.round("b.similarity", 6).alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    gone = materialize(leaks(docs, benchmark, id_col, **kw).select(F.col(id_col).alias("_dl_id")).distinct())
    return docs.join(gone, docs[id_col] == F.col("_dl_id"), "left_anti")
