"""Best-fit packing by minimum bin slack.

Only the histogram of piece lengths decides how bins are filled, and a histogram has at most `capacity`
entries whatever the corpus holds. The driver plans on it: for each bin a bitset subset-sum over the
lengths still available finds the fullest combination around the longest of them; the combination is
removed as often as it still fits, as one pattern. The pieces themselves never leave the executors: each
is ranked among those of its own length, and its rank tells pattern, bin and place.

Null text packs as an empty one (one token, the separator). An empty table gives no rows. Repeated rows
are packed as often as they stand there. Columns other than the two named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices

#: White space as the vocabulary's normaliser knows it: no piece of text crosses it.
SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Words remembered by a worker; beyond it the memory starts anew (results are the same).
REMEMBERED = 1_000_000
_MARK = "\x01"
_NO_SPACE = "\x1c\x1d\x1e\x1f"  # str.split() takes these for white space, the normaliser does not
_memory: dict[str, dict] = {}


def _encoder(path: str):
    """words -> list of little-endian uint32 ids, by the tokenizer file, each distinct word encoded once."""
    if path not in _memory:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        mark = tok.encode(_MARK, add_special_tokens=False).ids
        _memory[path] = {"tok": tok, "mark": mark[0] if len(mark) == 1 else None, "known": {}}
    return _memory[path]


def _learn(m: dict, new: list[str]) -> None:
    tok, known = m["tok"], m["known"]
    plain = [w for w in new if _MARK not in w] if m["mark"] is not None else []
    for at in range(0, len(plain), 20_000):
        part = plain[at : at + 20_000]
        ids = np.asarray(tok.encode(f" {_MARK} ".join(part) + f" {_MARK}", add_special_tokens=False).ids, "<u4")
        cuts = np.flatnonzero(ids == m["mark"])
        if len(cuts) != len(part):
            for w in part:
                known[w] = np.asarray(tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
            continue
        raw, start = ids.tobytes(), 0
        for w, c in zip(part, cuts.tolist()):
            known[w] = raw[4 * start : 4 * c]
            start = c + 1
    if len(plain) < len(new):
        for w in new:
            if w not in known:
                known[w] = np.asarray(tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes()


def token_bytes(path: str, text: str) -> bytes:
    """Ids of a text as little-endian uint32. Words are encoded one by one: the vocabulary drops white space and never joins across it."""
    m = _encoder(path)
    known = m["known"]
    found = SPACE.split(text) if any(c in text for c in _NO_SPACE) else text.split()
    try:
        return b"".join(map(known.__getitem__, found))
    except KeyError:
        if len(known) > REMEMBERED:
            known.clear()
        known[""] = b""
        _learn(m, [w for w in set(found) if w not in known])
        return b"".join(map(known.__getitem__, found))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, separator: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32. Documents longer than capacity are cut, others kept whole."""
    end = np.asarray([separator], "<u4").tobytes()
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col):
            ids, rows = b.column(0), ([], [], [], [], [])
            for i, text in enumerate(b.column(1).to_pylist()):
                raw = token_bytes(tokenizer, text or "") + end
                n = len(raw) // 4
                for k, at in enumerate(range(0, n, capacity)):
                    part = raw[4 * at : 4 * (at + capacity)]
                    for r, v in zip(rows, (i, k, at, len(part) // 4, zlib.crc32(part))):
                        r.append(v)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()), *(pa.array(r, pa.int64()) for r in rows[2:])], [id_col, "piece", "start", "length", "ids_crc32"])

    return docs.select(id_col, text_col).mapInArrow(cut, f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long")


def fullest(avail: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """The fullest combination around the longest length: (length, copies). Bitset subset-sum, longer lengths first."""
    first = max(avail)
    room = capacity - first
    items: list[tuple[int, int]] = []
    reach, history = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted(avail, reverse=True):
        left = min(avail[length] - (length == first), room // length)
        step = 1
        while left > 0 and not reach >> room & 1:
            take = min(step, left)
            history.append(reach)
            items.append((length, take))
            reach |= reach << (length * take) & mask
            left -= take
            step *= 2
        if reach >> room & 1:
            break
    got = {first: 1}
    at = reach.bit_length() - 1
    for (length, take), before in zip(reversed(items), reversed(history)):
        if not before >> at & 1:
            got[length] = got.get(length, 0) + take
            at -= length * take
    return sorted(got.items(), reverse=True)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (bins, [(length, copies in each bin)]) that use up the counts.

    The longest length left anchors each bin. A pattern is removed as often as all its lengths last, so each
    step uses up a length or leaves too few for the pattern: the steps follow the number of lengths, not rows.
    """
    left = {k: v for k, v in counts.items() if v > 0}
    out = []
    while left:
        pattern = fullest(left, capacity)
        times = min(left[length] // k for length, k in pattern)
        out.append((times, pattern))
        for length, k in pattern:
            left[length] -= times * k
            if not left[length]:
                del left[length]
    return out


def pack(cut: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "piece"), per_chunk: int = 50_000) -> DataFrame:
    """Add sequence_id and offset to rows with a `length` from 1 to capacity.

    A rank within a length is a running number inside one of its chunks plus the sizes of the chunks before,
    so no length, however common, meets in one task. Chunks follow the number of rows (`per_chunk`).
    """
    made = materialize(cut)
    spark = made.sparkSession
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `capacity` rows at most
    chunks = max(8, sum(counts.values()) // per_chunk)
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    base, used = 0, dict.fromkeys(counts, 0)
    for times, pattern in plan(counts, capacity):
        at = 0
        for length, k in pattern:
            slots.setdefault(length, []).append((used[length], k, base, at))
            used[length] += k * times
            at += length * k
        base += times
    sent = spark.sparkContext.broadcast({k: np.asarray(v, np.int64).T for k, v in slots.items()})  # follows the histogram, not the rows

    made = made.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    sizes = made.groupBy("length", "_chunk").agg(F.count("*").alias("_n"))
    before = sizes.select("length", "_chunk", (F.sum("_n").over(Window.partitionBy("length").orderBy("_chunk")) - F.col("_n")).alias("_before"))
    ranked = made.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_chunk").orderBy(*order)).cast("long") - 1)
    ranked = ranked.join(before, ["length", "_chunk"]).withColumn("_rank", F.col("_rank") + F.col("_before")).select(*cut.columns, "_rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "_rank"))
            seq, off = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order], prepend=-1))
            for at, to in zip(cuts, [*cuts[1:], b.num_rows]):
                rows = order[at:to]
                size = int(length[rows[0]])
                first, copies, bins, start = table[size]
                k = np.searchsorted(first, rank[rows], side="right") - 1
                into = rank[rows] - first[k]
                seq[rows] = bins[k] + into // copies[k]
                off[rows] = start[k] + size * (into % copies[k])
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(seq), pa.array(off)], [*b.schema.names[:-1], "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, separator: int = 0) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its sequence and place."""
    return pack(pieces(docs, tokenizer, capacity, separator), capacity)
