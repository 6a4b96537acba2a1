"""Windows that occur again: what substring dedup on bytes and on words have in common.

A window of `k` units (bytes or words) is ruled by its minimizer: the least hash among its grams of `g` units,
the leftmost of equals. Equal windows have equal minimizers, so a window can only repeat if its minimizer does.
Successive windows with one minimizer form a path. Only paths whose minimizer occurs twice or more go on; equal
paths are one, with the coordinates (document, position) of the first. Where different paths share a minimizer,
their windows are compared with each other, by the caller's method. Every window so gets the coordinates of its
first occurrence.

Documents that equal an earlier one unit for unit are known as copies by a digest and need no windows of their own.

A document is an id and a text (`sub` is a hash of the text). Repeated rows are one document, and each row gets its
result. Different texts under one id are documents of their own that come in the order of `sub`. Rows without an
id keep their text, and nothing is removed on their account.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, release, slices, string_buffers
from .grams import Words, powers, prefix_hashes


@dataclass(frozen=True)
class Kind:
    """Bytes or words, the window length, the gram length."""

    words: bool
    k: int
    g: int

    def __post_init__(self) -> None:
        if not 0 < self.g <= self.k or self.width > 128:
            raise ValueError("grams must be shorter than windows, by 127 units at most")

    @property
    def width(self) -> int:
        return self.k - self.g + 1


class Units:
    """The units of a batch of texts, with gram hashes."""

    def __init__(self, col: pa.Array, kind: Kind) -> None:
        self.kind = kind
        if kind.words:
            w = Words(col)
            self.bytes, self.off, self.start, self.end = w.bytes, w.off, w.start, w.end
            self.first, self.n = w.first, len(w.hash)
            n = max(self.n - kind.g + 1, 0)
            acc = np.zeros(n, np.uint64)
            for j in range(kind.g):
                acc = mix64(acc + w.hash[j : j + n]) + np.uint64(j)
            self.gram = mix64(acc)
        else:
            self.off, self.bytes = string_buffers(col)
            self.first, self.n = self.off, len(self.bytes)
            p, inverse = prefix_hashes(self.bytes), powers(self.n + 1)[1]
            n = max(self.n - kind.g + 1, 0)
            self.gram = mix64((p[kind.g : kind.g + n] - p[:n]) * inverse[:n])
        self.doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def digests(self) -> list[bytes]:
        """A digest of each document's units."""
        raw = self.bytes.tobytes()
        texts = (raw[a:b] for a, b in zip(self.off[:-1].tolist(), self.off[1:].tolist()))
        return [hashlib.blake2b(b" ".join(t.split()) if self.kind.words else t, digest_size=16).digest() for t in texts]

    def paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(minimizer, first window, windows) of every path; windows never cross documents."""
        k, w = self.kind.k, self.kind.width
        n = self.n - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        g = self.gram
        blocks = -(-len(g) // w)
        key = np.full(blocks * w, ~np.uint64(0), np.uint64)
        key[: len(g)] = g
        key &= ~np.uint64(0xFF)
        key = key.reshape(blocks, w) | np.arange(w, dtype=np.uint64)
        # Least from each gram to its block's end, and from each block's start to each gram: every window is one of the first and one of the second.
        left = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        right = np.minimum.accumulate(key + np.uint64(w), axis=1).reshape(-1)
        least = np.minimum(left[:n], right[w - 1 : w - 1 + n])
        at = np.arange(n) // w * w + (least & np.uint64(0xFF)).astype(np.int64)
        inside = self.doc[:n] == self.doc[k - 1 :]
        windows = np.flatnonzero(inside)
        if not len(windows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        pos, doc = at[windows], self.doc[windows]
        new = np.ones(len(windows), bool)
        new[1:] = (pos[1:] != pos[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(new)
        return (least[windows[heads]] >> np.uint64(8)).view(np.int64), windows[heads], np.diff(np.append(heads, len(windows)))

    def content(self, first: np.ndarray, windows: np.ndarray) -> list[bytes]:
        """The units that paths cover, words joined by one space."""
        raw, last = self.bytes.tobytes(), first + windows + self.kind.k - 2
        if self.kind.words:
            return [b" ".join(raw[a:b].split()) for a, b in zip(self.start[first].tolist(), self.end[last].tolist())]
        return [raw[a : b + 1] for a, b in zip(first.tolist(), last.tolist())]


PIECE = 1 << 20
SPANS = "array<struct<a:bigint,b:bigint>>"


def _digest_pass(docs: DataFrame, kind: Kind) -> DataFrame:
    """id, sub, n_units, digest, marks (minimizers of its paths) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PIECE):
            u = Units(b.column(2), kind)
            marks, first, _ = u.paths()
            cuts = np.searchsorted(first, u.first)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.diff(u.first).astype(np.int64)), pa.array(u.digests(), pa.binary()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(marks))],
                ["id", "sub", "n_units", "digest", "marks"],
            )

    return docs.mapInArrow(run, "id long, sub long, n_units long, digest binary, marks array<bigint>")


def _path_pass(docs: DataFrame, kind: Kind) -> DataFrame:
    """Paths of each document whose minimizer is in its list `marks`: x1, x2 (digest of the content), mark, id, sub, start, n, content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PIECE):
            u = Units(b.column(2), kind)
            marks, first, n = u.paths()
            doc = u.doc[first] if len(first) else np.zeros(0, np.int64)
            lists = b.column(3)
            cuts = np.asarray(lists.offsets)
            known = np.asarray(lists.values)[cuts[0] : cuts[-1]]
            owner = np.repeat(np.arange(b.num_rows), np.diff(cuts))
            both = lambda d, m: mix64(m.view(np.uint64) + mix64(d.astype(np.uint64) + np.uint64(1)))
            keep = np.isin(both(doc, marks), both(owner, known.astype(np.int64)))
            marks, first, n, doc = marks[keep], first[keep], n[keep], doc[keep]
            content = u.content(first, n)
            x = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, content)), ">i8").reshape(-1, 2).astype(np.int64)
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(marks), b.column(0).take(at), b.column(1).take(at), pa.array(first - u.first[doc]), pa.array(n.astype(np.int32)), pa.array(content, pa.binary())],
                ["x1", "x2", "mark", "id", "sub", "start", "n", "content"],
            )

    return docs.select("id", "sub", "text", "marks").mapInArrow(run, "x1 long, x2 long, mark long, id long, sub long, start long, n int, content binary")


def removals(src: DataFrame, kind: Kind, compare: Callable[[DataFrame, Kind], DataFrame], same_document: bool) -> DataFrame:
    """id, sub, copy, spans, one row for each document of src(id, sub, text) that loses something.

    copy: it equals an earlier one and has a window or more. spans: the (from, to) units covered by windows that
    occur earlier: in a document of smaller id or, with same_document, before in the same one.
    compare takes the distinct paths that share a minimizer with others (x1, x2, mark, c: paths of the minimizer, id, sub,
    start, n, times, content) and returns runs of windows of them, from window t on n of them, with the coordinates of the first occurrence
    of the first (x1, x2, t, n, id0, sub0, pos0); it may leave out what is first itself.
    """
    pass1 = materialize(_digest_pass(src, kind))
    first = pass1.groupBy("digest", "n_units").agg(F.min("id").alias("id"))
    copies = pass1.select("id", "sub", "digest", "n_units").join(first.select("digest", F.col("id").alias("id0")), "digest").filter(f"id > id0 AND n_units >= {kind.k}").select("id", "sub").distinct()
    copies = materialize(copies)
    own = pass1.filter(F.size("marks") > 0).join(first.select("id", "digest"), ["id", "digest"], "left_semi")
    marks = own.select("id", F.explode("marks").alias("mark"))
    # Tables of their own, so that the joins below can split the rows of a hot minimizer.
    again = materialize(marks.groupBy("mark").agg(F.count("*").alias("c")).filter("c > 1").select("mark"))
    known = materialize(marks.join(again, "mark").groupBy("id").agg(F.collect_set("mark").alias("marks")))
    unique = pass1.groupBy("id").agg(F.count("*").alias("c")).filter("c > 1").isEmpty()
    release(pass1)
    release(again)
    texts = src.join(known, "id")
    # Each document once; where no id stands in two rows, the texts need no further sort.
    paths = materialize(_path_pass(texts if unique else texts.dropDuplicates(["id", "sub"]), kind))
    release(known)
    order = F.struct("id", "sub", "start")
    once = materialize(paths.groupBy("x1", "x2").agg(F.min(order).alias("o"), F.first("mark").alias("mark"), F.first("n").alias("n"), F.first("content").alias("content"), F.count("*").alias("times")))
    places = materialize(paths.select("x1", "x2", "id", "sub", "start", "n"))
    release(paths)
    crowd = materialize(once.groupBy("mark").agg(F.count("*").alias("c")).filter("c > 1"))
    crowded = once.join(crowd, "mark").select("x1", "x2", "mark", "c", F.col("o.id").alias("id"), F.col("o.sub").alias("sub"), F.col("o.start").alias("start"), "n", "times", "content")
    windows = compare(crowded, kind)
    # Per path: where it occurred first, and for runs of windows that occurred earlier in another path, where.
    moved = windows.groupBy("x1", "x2").agg(F.collect_list(F.struct("t", "n", "id0", "sub0", "pos0")).alias("moved"))
    said = once.select("x1", "x2", F.col("o.id").alias("fid"), F.col("o.sub").alias("fsub"), F.col("o.start").alias("fstart"), "times").join(moved, ["x1", "x2"], "left")
    said = materialize(said.filter("times > 1 OR moved IS NOT NULL").drop("times"))
    release(once)
    release(crowd)
    seen = places.join(said, ["x1", "x2"])

    def earlier(i, sub, p, at):
        """Whether the document i, sub comes before the row's, or p before at in the same one."""
        before = i < F.col("id")
        return before | ((i == F.col("id")) & ((sub < F.col("sub")) | ((sub == F.col("sub")) & (p < at)))) if same_document else before

    whole = earlier(F.col("fid"), F.col("fsub"), F.col("fstart"), F.col("start"))
    some = F.transform(
        F.filter(F.col("moved"), lambda m: earlier(m["id0"], m["sub0"], m["pos0"], F.col("start") + m["t"])),
        lambda m: F.struct((F.col("start") + m["t"]).cast("bigint").alias("a"), (F.col("start") + m["t"] + m["n"] + (kind.k - 1)).cast("bigint").alias("b")),
    )
    spans = F.when(whole, F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("n") + kind.k - 1).alias("b")))).otherwise(F.coalesce(some, F.array().cast(SPANS)))
    removed = seen.select("id", "sub", spans.alias("s")).filter(F.size("s") > 0).groupBy("id", "sub").agg(F.flatten(F.collect_list("s")).alias("spans"))
    out = copies.select("id", "sub", F.lit(True).alias("copy"), F.lit(None).cast(SPANS).alias("spans")).unionByName(removed.select("id", "sub", F.lit(False).alias("copy"), "spans"))
    # A document may be both: one of two texts under its id that have the same units.
    out = materialize(out.groupBy("id", "sub").agg(F.max("copy").alias("copy"), F.flatten(F.collect_list("spans")).alias("spans")))
    for t in (copies, places, said):
        release(t)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out
