"""Near duplicates by one-permutation MinHash with optimal densification.

1. One pass hashes each text's shingle set once: its size, a digest of the set, and a signature of `BINS` bins;
   an empty bin takes the value of the first filled bin in an order of its own (optimal densification).
2. Documents with equal sets are one; the smallest stands for them.
3. `ROWS` neighbouring bins make a band; documents with an equal band share a bucket. A bucket's star is the document
   with the most company over all its buckets: of many copies with edits of their own, that is the one they come from.
   Candidate edges go from the star to the others, so pairs grow with rows, not with their square.
4. Candidates are confirmed on the full sets; confirmed links are joined to components.
5. Where a bucket still holds several components, its largest one sends further stars: CENTERS of its documents, drawn
   by hashes, are held against the documents outside it.
6. Documents that are outside their bucket's largest component even then are compared with all of the others there, so
   that no link through a bucket is lost. In buckets of more than SMALL rows, as a passage that many texts share makes them,
   prefixes say which pairs can be similar enough at all: with shingles in one order, rare ones first, two sets that share
   80 % of their union share one of the first n - 0.8 n + 1 of each, early enough for the rest to suffice. That is exact as
   well, and shared passages stand last.

At a similarity of 0.8, a pair shares no bucket with probability (1 - 0.8^6)^42 = 3e-6.

Words and shingles are told apart by 64-bit hashes of a keyed scrambler: two sets of a thousand shingles hold a false
match with probability 5e-14.

A text without words has an empty set and is linked with nothing. Rows without an id keep their row with a null
component; an empty table gives no rows; repeated rows of one id are one document. Of different texts
under one id, the one with the least digest is the one that others are linked with; a row's component is that of the
smallest id with the row's set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, release, slices
from .components import components
from .grams import Words, shingle_sets

BINS, ROWS = 256, 6
BANDS = BINS // ROWS
_rng = np.random.default_rng(977)
_ORDER = np.stack([_rng.permutation(BINS) for _ in range(BINS)])


def signatures(d: np.ndarray, h: np.ndarray, n_docs: int) -> np.ndarray:
    """n_docs x BINS: least hash in each bin, empty bins densified; rows of empty sets stay 0."""
    sig, full = np.zeros((n_docs, BINS), np.uint64), np.zeros((n_docs, BINS), bool)
    bins = (h >> np.uint64(56)).astype(np.int64)
    key = d * BINS + bins
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]  # hashes are sorted within a document, and so are bins: the first of each run is the least
    sig.reshape(-1)[key[first]] = h[first]
    full.reshape(-1)[key[first]] = True
    rows, cols = np.nonzero(~full & full.any(1)[:, None])
    for t in range(BINS):
        if not len(rows):
            break
        to = _ORDER[cols, t]
        got = full[rows, to]
        sig[rows[got], cols[got]] = sig[rows[got], to[got]]
        rows, cols = rows[~got], cols[~got]
    return sig


def bands(sig: np.ndarray) -> np.ndarray:
    """n_docs x BANDS bucket keys."""
    x = sig[:, : BANDS * ROWS].reshape(len(sig), BANDS, ROWS)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), x.shape[:2]).copy()
    for r in range(ROWS):
        acc = mix64(acc ^ x[:, :, r]) + np.uint64(r + 1)
    return acc.view(np.int64)


def _digests(h: np.ndarray, cuts: np.ndarray) -> list[bytes | None]:
    """A digest of each set; none of empty ones."""
    raw = h.tobytes()
    return [hashlib.blake2b(raw[8 * a : 8 * z], digest_size=16).digest() if z > a else None for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _sketch(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """id, n_shingles, digest, bands; no bands where the set is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col, 2 << 20):
            for at in range(0, b.num_rows, 4000):
                part = b.slice(at, 4000)
                w = Words(part.column(1), lower=True)
                d, h = shingle_sets(w, k)
                n = np.bincount(d, minlength=part.num_rows)
                cuts = np.concatenate([[0], np.cumsum(n)])
                digest = _digests(h, cuts)
                keys = bands(signatures(d, h, part.num_rows))
                has = n > 0
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has * BANDS)]), pa.int32()), pa.array(keys[has].reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n.astype(np.int64)), pa.array(digest, pa.binary()), lists], ["id", "n_shingles", "digest", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(run, "id long, n_shingles long, digest binary, bands array<bigint>")


def _sets(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """id, its full set as an array of hashes, digest of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col, 1 << 20):
            d, h = shingle_sets(Words(b.column(1), lower=True), k)
            cuts = np.concatenate([[0], np.cumsum(np.bincount(d, minlength=b.num_rows))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(h.view(np.int64))), pa.array(_digests(h, cuts), pa.binary())], ["id", "set", "digest"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(run, "id long, set array<bigint>, digest binary")


CENTERS, ROUNDS, SMALL = 4, 1, 48


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
    same = F.size(F.array_intersect("x", "y"))
    return both.filter(100 * same >= percent * (F.size("x") + F.size("y") - same)).select("a", "b")


def _mixed(crowded: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components: key, id, n_shingles, c, main (the bucket's largest component)."""
    placed = crowded.join(comp.withColumnRenamed("node", "id"), "id", "left").select("key", "id", "n_shingles", F.coalesce("component", "id").alias("c"))
    sizes = placed.groupBy("key", "c").agg(F.count("*").alias("n"))
    top = sizes.groupBy("key").agg(F.max(F.struct("n", (-F.col("c")).alias("c"))).alias("top"), F.count("*").alias("n_c"), F.sum("n").alias("n_all")).filter("n_c > 1 AND n_all > 2")
    return materialize(placed.join(top.select("key", (-F.col("top.c")).alias("main")), "key"))


def _prefixes(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """id, c, n_shingles, outside (of the largest component of some bucket) and mark, at: each shingle of the document's prefix and its place."""
    docs = rows.groupBy("id", "c", "n_shingles").agg(F.max(F.col("c") != F.col("main")).alias("outside"))
    marks = docs.join(sets, "id").select("id", "c", "n_shingles", "outside", F.explode("set").alias("mark"))
    common = marks.groupBy("mark").agg(F.count("*").alias("f"))
    ranked = marks.join(common, "mark").groupBy("id", "c", "n_shingles", "outside").agg(F.array_sort(F.collect_list(F.struct("f", "mark"))).alias("m"))
    n = F.size("m")
    prefix = F.slice("m", F.lit(1), (n - F.ceil(n * percent / 100) + 1).cast("int"))
    return ranked.select("id", "c", "n_shingles", "outside", F.posexplode(prefix).alias("at", "m")).select("id", "c", "n_shingles", "outside", "at", "m.mark")


def _grown(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: those links are few, so only the components they touch are joined anew."""
    of = lambda c: comp.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    moved = materialize(components(between))
    known = comp.union(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(comp, "node", "left_anti").select("node", F.col("node").alias("component")))
    return known.join(moved.select(F.col("node").alias("component"), F.col("component").alias("c")), "component", "left").select("node", F.coalesce("c", "component").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 80) -> DataFrame:
    """id_col, n_shingles, component_id of every row. Links: at least `percent` of the union of two shingle sets is shared."""
    sketch = materialize(_sketch(docs, id_col, text_col, k))
    same = sketch.filter("n_shingles > 0").groupBy("digest", "n_shingles").agg(F.min("id").alias("id"))
    reps = sketch.join(same.select("id", "digest"), ["id", "digest"], "left_semi").groupBy("id").agg(F.min(F.struct("digest", "n_shingles", "bands")).alias("r")).select("id", "r.*")
    reps = materialize(reps)
    rows = reps.select(F.explode("bands").alias("key"), "id", "n_shingles")
    # Tables of a row for each bucket stand by themselves, so that joins with them can split the rows of a hot one.
    shared = materialize(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    # Rows of buckets with company: all that is read later.
    crowded = materialize(rows.join(shared, "key"))
    company = crowded.groupBy("id").agg(F.sum("n").alias("company"))
    star = crowded.join(company, "id").groupBy("key").agg(F.max(F.struct("company", (-F.col("id")).alias("m"), "n_shingles")).alias("s"))
    star = materialize(star.select("key", (-F.col("s.m")).alias("a"), F.col("s.n_shingles").alias("na")))
    size_fits = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)
    # Texts go through one shuffle, at every size alike.
    some = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).hint("merge").join(crowded.select("id").distinct(), "id", "left_semi")
    made = _sets(some, "id", "text", k)
    repeated = not sketch.groupBy("id").agg(F.count("*").alias("c")).filter("c > 1").isEmpty()
    if repeated:  # the set of the text that stands for the id
        made = made.join(reps.select("id", "digest"), ["id", "digest"], "left_semi").dropDuplicates(["id"])
    sets = materialize(made.drop("digest"))
    crowded_rows = crowded.select("key", "id", "n_shingles")
    first = crowded_rows.join(star, "key").filter((F.col("id") != F.col("a")) & size_fits(F.col("na"), F.col("n_shingles")))
    tried = materialize(first.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct())
    links = materialize(_confirm(tried, sets, percent))
    comp = materialize(components(links))

    def go_on(pairs: DataFrame) -> bool:
        """Try new pairs; whether the components changed."""
        nonlocal tried, comp
        new = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"))
        more = materialize(_confirm(new, sets, percent))
        tried = tried.union(new)
        if more.isEmpty():
            return False
        comp = materialize(_grown(comp, more))
        return True

    for r in range(ROUNDS):
        mixed = _mixed(crowded_rows, comp)
        if mixed.isEmpty():
            break
        inside = mixed.filter("c = main")
        drawn = inside.groupBy("key").agg(*(F.min(F.struct(F.xxhash64("id", F.lit(r * CENTERS + i)).alias("h"), "id", "n_shingles")).alias(f"s{i}") for i in range(CENTERS)))
        stars = drawn.select("key", F.explode(F.array_distinct(F.array(*(F.struct(F.col(f"s{i}.id").alias("id"), F.col(f"s{i}.n_shingles").alias("n")) for i in range(CENTERS))))).alias("s"))
        outside = mixed.filter("c <> main").join(stars, "key").filter(size_fits(F.col("n_shingles"), F.col("s.n")))
        if not go_on(outside.select(F.col("id").alias("a"), F.col("s.id").alias("b"))):
            break
    mixed = _mixed(crowded_rows, comp)
    if not mixed.isEmpty():
        large = mixed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > SMALL).select("key")
        few, many = mixed.join(large, "key", "left_anti"), materialize(mixed.join(large, "key", "left_semi"))
        x, y = few.filter("c <> main").alias("x"), few.alias("y")
        once = (F.col("y.c") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))
        fits = (F.col("x.c") != F.col("y.c")) & size_fits(F.col("x.n_shingles"), F.col("y.n_shingles"))
        rest = x.join(y, (F.col("x.key") == F.col("y.key")) & fits & once).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        if not many.isEmpty():
            first = materialize(_prefixes(many, sets, percent))
            x, y = first.filter("outside").alias("x"), first.alias("y")
            once = ~F.col("y.outside") | (F.col("x.id") < F.col("y.id"))
            # What two sets share stands at or after the first mark that they share, so its places bound it.
            sure = F.least(F.col("x.n_shingles") - F.col("x.at"), F.col("y.n_shingles") - F.col("y.at")) * (100 + percent) >= percent * (F.col("x.n_shingles") + F.col("y.n_shingles"))
            rest = rest.union(x.join(y, (F.col("x.mark") == F.col("y.mark")) & fits & once & sure).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
        go_on(rest)
    for t in (reps, shared, crowded, star, sets, links):
        release(t)
    final = (
        sketch.select("id", "n_shingles", "digest").join(same.select("digest", F.col("id").alias("rep")), "digest", "left")
        .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    )
    return final.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "rep", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies of smaller id, with all their columns; of repeated ids one row stays, of the least text."""
    gone = near_duplicates(docs, id_col, text_col, k, percent).filter(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("_dl_id")).distinct()
    kept = docs.join(materialize(gone), docs[id_col].cast("long") == F.col("_dl_id"), "left_anti")
    twice = docs.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("_dl_n")).filter("_dl_n > 1").select(F.col(id_col).alias("_dl_id"))
    if twice.isEmpty():
        return kept
    twice = materialize(twice)
    order = F.struct(text_col, *(F.to_json(F.struct(c)) for c in docs.columns if c not in (id_col, text_col)))
    one = kept.join(twice, kept[id_col] == F.col("_dl_id"), "left_semi").groupBy(F.col(id_col).alias("_dl_id")).agg(F.min_by(F.struct(*docs.columns), order).alias("_dl_row")).select("_dl_row.*")
    return kept.join(twice, kept[id_col] == F.col("_dl_id"), "left_anti").unionByName(one)
