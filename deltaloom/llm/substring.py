"""Substring dedup: on bytes by suffix arrays, on words by a compacted De Bruijn graph.

Bytes: different paths that share a minimizer are laid out in shards; each shard's suffix array is made by induced
sorting, its permuted common prefixes say which windows are equal, and the least coordinates of each class are the
first occurrence. A minimizer shared by more than SHARD_PATHS different paths is dealt over several shards; each is
sorted by itself, and the classes of its shards, one row each, are joined by the content of their window.

Words: the windows of paths that share a minimizer are the edges of a De Bruijn graph; its nodes are the sequences one word
shorter. Edges that occur once are left out. A node with one edge in and one out continues a path if the
edges' first occurrences follow each other; such paths compact to unitigs, each with its source coordinates. Joined
back to the text, a run of windows on one unitig is one row. A run is removed only if the coordinates of its
first occurrence lie in an earlier document.

Null text has no bytes and no words; texts shorter than a window keep all; an empty table gives no rows. Rows with
one id and one text count as one document, whatever else stands in the row, and each of them gets its result;
different texts under one id are different documents: on words neither is earlier, on bytes the one
with the smaller hash is. Rows without an id keep all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, release, slices
from .grams import Words
from .repeats import Kind, merged, removals
from .suffix import SEPARATOR, permuted_prefixes, suffix_array

SHARD_PATHS = 5000
SHARD_BYTES = 1 << 20


def _shard_classes(content: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(path, t, class) of every window of the strings; equal windows are one class, 0, 1, 2 and so on, and stand together."""
    lengths = np.array([len(c) for c in content])
    s = np.empty(int(lengths.sum()) + len(content) + 1, np.int64)
    firsts = np.cumsum(lengths + 1) - lengths - 1
    s[:-1] = np.frombuffer(b"\0".join(content) + b"\0", np.uint8).astype(np.int64) + 2
    s[firsts + lengths] = SEPARATOR
    s[-1] = 0
    sa = suffix_array(s, 258)
    plcp = permuted_prefixes(s, sa)
    path = np.repeat(np.arange(len(content)), lengths + 1)
    t = np.arange(len(path)) - firsts[path]
    ok = np.append(t + k <= lengths[path], False)
    order = sa[ok[sa]]
    # Suffixes between two that share k bytes share them too, so windows of a class stand together.
    new = plcp[order] < k
    new[:1] = True
    return path[order], t[order], np.cumsum(new) - 1


def _sorted_shards(paths: DataFrame, kind: Kind) -> DataFrame:
    """x1, x2, t, n, id0, sub0, pos0 of windows that occur earlier in another path of their minimizer."""
    k = kind.k

    def sort(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = pa.Table.from_batches(rows).combine_chunks()
        content = b.column("content").to_pylist()
        ids, subs, starts, split = (b.column(c).to_numpy() for c in ("id", "sub", "start", "split"))
        path, t, cls = _shard_classes(content, k)
        if not len(path):
            return
        rank = np.empty(len(content), np.int64)
        back = np.lexsort((starts, subs, ids))
        rank[back] = np.arange(len(content))
        key = rank[path] << 32 | t
        heads = np.flatnonzero(np.diff(cls, prepend=-1))
        least = np.minimum.reduceat(key, heads)
        of, lt = back[least >> 32], least & 0xFFFFFFFF
        # Windows of minimizers that have a shard to themselves are settled here; those of split ones go on, by class.
        far = split[path].astype(bool)
        go = (least[cls] != key) | far
        path, t, cls, far = path[go], t[go], cls[go], far[go]
        h = np.zeros((len(heads), 2), np.int64)
        for c in np.unique(cls[far]).tolist():
            h[c] = np.frombuffer(xxhash.xxh3_128_digest(content[of[c]][lt[c] : lt[c] + k]), ">i8")
        at = pa.array(path)
        yield pa.RecordBatch.from_arrays(
            [b.column("x1").combine_chunks().take(at), b.column("x2").combine_chunks().take(at), pa.array(t.astype(np.int32)), pa.array(ids[of[cls]]), pa.array(subs[of[cls]]), pa.array(starts[of[cls]] + lt[cls]),
             pa.array(h[cls, 0], mask=~far), pa.array(h[cls, 1], mask=~far)],
            ["x1", "x2", "t", "id0", "sub0", "pos0", "h1", "h2"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for b in batches:
            marks = b.column(0).to_numpy() ^ b.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), b.num_rows]
            for a, to in zip(cuts[:-1], cuts[1:]):
                if size > SHARD_BYTES and marks[a] != last:  # rows come by shard: what is sorted together ends between two
                    yield from sort(held)
                    held, size = [], 0
                part = b.slice(a, to - a)
                held.append(part)
                size += (k + kind.width) * part.num_rows
                last = marks[a]
        if held:
            yield from sort(held)

    shards = F.ceil(F.col("c") / SHARD_PATHS)
    # The xor of both keys tells neighbours apart: shard is scrambled.
    dealt = paths.select("mark", F.when(F.col("c") > SHARD_PATHS, F.xxhash64(F.pmod("x1", shards))).otherwise(F.lit(0).cast("long")).alias("shard"), "x1", "x2", "id", "sub", "start", (F.col("c") > SHARD_PATHS).cast("int").alias("split"), "content")
    ordered = dealt.repartition("mark", "shard").sortWithinPartitions("mark", "shard")
    made = materialize(ordered.mapInArrow(run, "x1 long, x2 long, t int, id0 long, sub0 long, pos0 long, h1 long, h2 long"))
    far = made.filter("h1 IS NOT NULL")
    least = far.groupBy("h1", "h2").agg(F.min(F.struct("id0", "sub0", "pos0")).alias("o"))
    across = far.select("x1", "x2", "t", "h1", "h2").join(materialize(least), ["h1", "h2"]).select("x1", "x2", "t", "o.*")
    cols = ["x1", "x2", "t", F.lit(1).alias("n"), "id0", "sub0", "pos0"]
    return made.filter("h1 IS NULL").select(*cols).union(across.select(*cols))


def _edges(paths: DataFrame, k: int) -> DataFrame:
    """The windows of paths as edges: l, r (hashes of the nodes that they join, which say which edge it is), x1, x2, t, id, sub, pos, times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "content", 1 << 20):
            w = Words(b.column(6))
            at, h = w.grams(k - 1)
            doc = w.doc[at]
            follows = np.flatnonzero(doc[1:] == doc[:-1])  # the node after the one at `follows` is in the same path
            l, r, row = h[follows].view(np.int64), h[follows + 1].view(np.int64), doc[follows]
            t = at[follows] - w.first[row]
            take = pa.array(row)
            x1, x2, ids, sub, start, times = (b.column(i).take(take) for i in range(6))
            yield pa.RecordBatch.from_arrays([pa.array(l), pa.array(r), x1, x2, pa.array(t.astype(np.int32)), ids, sub, pa.array(start.to_numpy() + t), times], ["l", "r", "x1", "x2", "t", "id", "sub", "pos", "times"])

    return paths.select("x1", "x2", "id", "sub", "start", "times", "content").mapInArrow(run, "l long, r long, x1 long, x2 long, t int, id long, sub long, pos long, times long")


def _unitigs(edges: DataFrame) -> DataFrame:
    """Repeated edges l, r with their first occurrence (id0, sub0, pos0) and their unitig: the place there where it begins (head)."""
    again = materialize(edges.groupBy("l", "r").agg(F.min(F.struct("id", "sub", "pos")).alias("o"), F.sum("times").alias("c")).filter("c > 1").select("l", "r", F.col("o.id").alias("id0"), F.col("o.sub").alias("sub0"), F.col("o.pos").alias("pos0")))
    ends = again.select(F.explode(F.array(F.struct(F.col("l").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")), F.struct(F.col("r").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))).alias("e")).select("e.*")
    degrees = ends.groupBy("node").agg(F.sum("out").alias("out"), F.sum("in").alias("in"))
    through = materialize(degrees.filter("out = 1 AND `in` = 1").select(F.col("node").alias("l"), F.lit(True).alias("through")))
    placed = again.join(through, "l", "left")
    w = Window.partitionBy("id0", "sub0").orderBy("pos0")
    goes_on = F.col("through") & (F.lag("pos0").over(w) == F.col("pos0") - 1)
    placed = placed.withColumn("head", F.when(~F.coalesce(goes_on, F.lit(False)), F.col("pos0")))
    out = materialize(placed.withColumn("head", F.last("head", True).over(w)).drop("through"))
    release(again)
    release(through)
    return out


def _compacted(paths: DataFrame, kind: Kind) -> DataFrame:
    """x1, x2, t, n, id0, sub0, pos0: runs of windows that follow one unitig, with the coordinates of the first occurrence of the run's first window.

    Runs that first occur where their path does are left out: the path's own coordinates say as much.
    """
    edges = materialize(_edges(paths, kind.k))
    unitigs = _unitigs(edges)
    base = (F.col("pos0") - F.col("t")).alias("base")
    on = edges.select("l", "r", "x1", "x2", "t", "id").join(unitigs, ["l", "r"]).filter("id0 < id").select("x1", "x2", "t", "id0", "sub0", "head", base)
    # A path has fewer windows than would fit two runs of one unitig at one distance from the source: the windows between belong to it.
    runs = on.repartition("x1", "x2").groupBy("x1", "x2", "id0", "sub0", "head", "base").agg(F.min("t").alias("t"), F.count("*").cast("int").alias("n"))
    out = materialize(runs.select("x1", "x2", "t", "n", "id0", "sub0", (F.col("base") + F.col("t")).alias("pos0")))
    release(edges)
    release(unitigs)
    return out


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 100, g: int = 32, with_text: bool = False) -> DataFrame:
    """id_col, n_bytes, n_removed, n_spans, kept_sha256; with_text adds kept, the remaining bytes."""
    src = _source(docs, id_col, text_col)
    removed = removals(src, Kind(False, k, g), _sorted_shards, same_document=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows: list[tuple] = []
            for text, copy, spans in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                raw = (text or "").encode()
                cut = [(0, len(raw))] if copy else merged([(s["a"], s["b"]) for s in spans or ()])
                at, kept = 0, []
                for a, z in cut:
                    kept.append(raw[at:a])
                    at = z
                kept.append(raw[at:])
                rest = b"".join(kept)
                rows.append((len(raw), len(raw) - len(rest), len(cut), hashlib.sha256(rest).hexdigest(), rest if with_text else None))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())))], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = _with(src, removed).mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else []))


def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 13, g: int = 4, with_text: bool = False) -> DataFrame:
    """id_col, n_words, n_removed, kept_sha256; with_text adds kept, the remaining words joined by one space."""
    src = _source(docs, id_col, text_col)
    removed = removals(src, Kind(True, k, g), _compacted, same_document=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows: list[tuple] = []
            for text, copy, spans in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                words = (text or "").encode().split()
                cut = [(0, len(words))] if copy else merged([(s["a"], s["b"]) for s in spans or ()])
                at, kept = 0, []
                for a, z in cut:
                    kept += words[at:a]
                    at = z
                kept += words[at:]
                rest = b" ".join(kept)
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(rest).hexdigest(), rest.decode() if with_text else None))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string())))], ["id", "n_words", "n_removed", "kept_sha256", "kept"])

    out = _with(src, removed).mapInArrow(run, "id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept_sha256", *(["kept"] if with_text else []))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("sub"), F.col(text_col).alias("text"))


def _with(src: DataFrame, removed: DataFrame) -> DataFrame:
    """id, text, whether it is a copy, spans; the table says something of few documents."""
    return src.join(removed, ["id", "sub"], "left").select("id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "spans")
