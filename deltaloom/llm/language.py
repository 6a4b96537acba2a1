"""Language identification by a linear-chain conditional random field over the words of a text.

Words are runs of letters. Their features are hashed into one weight table with a column per language: affixes of one to four
bytes, all three-byte pieces, and the word itself (a learned lexicon). Transitions between the labels of neighbouring
words are learned too. Training maximises the likelihood of chains put together from pieces of labelled texts
in different languages, so the transitions know code-switched text. Forward-backward gives each word's label
probabilities; a text's language is the one with the largest mean, and that mean is the score.

The model is fitted on the driver on a bounded sample of labelled documents: MOST_DOCS in all (one of each language at
least, so every language is learned) and at most MOST_CHARS characters of each from a random place on, cut on the
executors. The weight table has 2^BITS rows, fewer with many languages, so that it stays within MOST_WEIGHTS numbers.
Prediction covers every word of every text; long texts go through in pieces of PIECE bytes, with the messages
handed on from piece to piece, so they take no more memory than short ones and get the same probabilities.

Null texts and texts without a letter get `und` and score 0. Without labelled documents every text gets `und`. An empty
table gives no rows; repeated rows are predicted each for itself; columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, slices, string_buffers

MOST_DOCS = 1600
MOST_WORDS = 400
MOST_CHARS = 6000
BITS = 18
MOST_WEIGHTS = 1 << 22
PIECE = 1 << 20
CHAIN = 48
EPOCHS = 3
UNKNOWN = "und"
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_MASK = np.uint64((1 << BITS) - 1)


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    weights: np.ndarray  # hashed features x labels
    moves: np.ndarray  # labels x labels


class Tokens:
    """Letter runs of a batch of texts: start, end, document; first[i] to first[i + 1] are those of text i."""

    def __init__(self, off: np.ndarray, b: np.ndarray) -> None:
        self.bytes = b
        n = len(b)
        solid = _LETTER[b]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        left, right = edge[:n].copy(), edge[1:].copy()
        left[1:] |= ~solid[:-1]
        right[:-1] |= ~solid[1:]
        self.start, self.end = np.flatnonzero(solid & left), np.flatnonzero(solid & right) + 1
        self.first = np.searchsorted(self.start, off)

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words x 9 indices of affixes and the word itself, indices of the pieces, first piece of each word)."""
        low = _LOWER[self.bytes]
        low = np.concatenate([low, np.zeros(4, np.uint64)])
        s, e = self.start, self.end
        size = e - s
        per, head, tail = [], np.zeros(len(s), np.uint64), np.zeros(len(s), np.uint64)
        for k in range(4):
            has = size > k
            head = np.where(has, head << np.uint64(8) | low[np.minimum(s + k, len(low) - 1)], head)
            tail = np.where(has, tail << np.uint64(8) | low[np.maximum(e - 1 - k, 0)], tail)
            per += [mix64(head + np.uint64((k + 1) << 40)) & _MASK, mix64(tail + np.uint64((k + 9) << 40)) & _MASK]
        # The word itself: its letters in a sum with scrambled places.
        places = np.arange(int(size.max()) if len(size) else 0, dtype=np.uint64)
        scramble = mix64(places + np.uint64(77)) | np.uint64(1)
        inside = np.repeat(np.cumsum(size) - size, size)
        at = np.arange(int(size.sum())) - inside
        where = np.repeat(s, size) + at
        mixed = mix64(low[where] + np.uint64(3)) * scramble[at]
        starts = np.cumsum(size) - size
        whole = np.add.reduceat(mixed, starts) if len(s) else np.zeros(0, np.uint64)
        per.append(mix64(whole + np.uint64(5)) & _MASK)
        three = low[where] << np.uint64(16) | low[np.minimum(where + 1, len(low) - 1)] << np.uint64(8) | low[np.minimum(where + 2, len(low) - 1)]
        ok = at + 2 < np.repeat(size, size)
        # Words of one or two letters have one piece, of their own kind.
        pieces = np.where(ok | (at == 0), mix64(np.where(ok, three, np.uint64(1 << 50) + whole[np.repeat(np.arange(len(s)), size)])) & _MASK, np.uint64(0))
        keep = ok | (at == 0)
        counts = np.add.reduceat(keep.astype(np.int64), starts) if len(s) else np.zeros(0, np.int64)
        return np.stack(per, 1).astype(np.int64) if len(s) else np.zeros((0, 9), np.int64), pieces[keep].astype(np.int64), np.cumsum(counts) - counts


def emissions(weights: np.ndarray, per: np.ndarray, pieces: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Score of each label for each word: the sum of the weights of its features."""
    if not len(per):
        return np.zeros((0, weights.shape[1]), np.float32)
    low = len(weights) - 1
    if low < int(_MASK):
        per, pieces = per & low, pieces & low
    out = weights[per[:, 0]].copy()
    for j in range(1, per.shape[1]):
        out += weights[per[:, j]]
    return out + np.add.reduceat(weights[pieces], starts)


def forward_backward(e: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label probabilities, forward messages, psi times backward messages) of each word.

    Chains are the runs first[i] to first[i + 1]; all chains take a step at once.
    """
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    heads, n = first[:-1][order], n[order]
    steps = int(n[0]) if len(n) else 0
    psi = _psi(e)
    trans = np.exp(moves - moves.max()).astype(np.float32)
    alpha, beta = np.ones_like(psi), np.ones_like(psi)
    # Chains with more than t words, for each t.
    active = np.searchsorted(-n, -np.arange(steps), side="left")
    now = None
    for t in range(steps):
        k = active[t]
        at = heads[:k] + t
        a = psi[at] if t == 0 else (now[:k] @ trans) * psi[at]
        now = a / a.sum(1, keepdims=True)
        alpha[at] = now
    back = trans.T.copy()
    for t in range(steps - 2, -1, -1):
        k = active[t + 1]
        at = heads[:k] + t
        b = (psi[at + 1] * beta[at + 1]) @ back
        beta[at] = b / b.sum(1, keepdims=True)
    p = alpha * beta
    return (p / p.sum(1, keepdims=True) if len(p) else p), alpha, psi * beta


def table_rows(labels: int) -> int:
    """Rows of the weight table: a power of two."""
    return 1 << max(8, min(BITS, (MOST_WEIGHTS // labels).bit_length() - 1))


def fit(texts: list[str], langs: list[str], seed: int = 1) -> Model:
    """Train on texts with one language each."""
    labels = tuple(sorted(set(langs)))
    size = len(labels)
    rng = np.random.default_rng(seed)
    raw = [t.encode() for t in texts]
    tokens = Tokens(np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64), np.frombuffer(b"".join(raw), np.uint8))
    per, pieces, starts = tokens.features()
    ends = np.append(starts[1:], len(pieces))
    # Segments of 3 to 24 words of a text; chains of segments of any language, more often the same than chance has it.
    segments: list[list[tuple[int, int]]] = [[] for _ in labels]
    for i, lang in enumerate(langs):
        a, z = int(tokens.first[i]), int(tokens.first[i + 1])
        if z - a > MOST_WORDS:
            a += int(rng.integers(0, z - a - MOST_WORDS + 1))
            z = a + MOST_WORDS
        while a < z:
            k = int(rng.integers(3, 25))
            segments[labels.index(lang)].append((a, min(a + k, z)))
            a += k
    for s in segments:
        rng.shuffle(s)
    queues = [list(map(tuple, s)) for s in segments]
    words, truth = [], []
    now = 0
    while any(queues):
        left = [j for j in range(size) if queues[j]]
        if now not in left or rng.random() < 0.5:
            now = int(rng.choice(left))
        a, z = queues[now].pop()
        words += range(a, z)
        truth += [now] * (z - a)
    step = min(CHAIN, len(words)) or 1
    heads = list(range(0, len(words) - step + 1, step))
    if heads and heads[-1] + step < len(words):
        heads.append(len(words) - step)  # the last chain begins early enough to be whole
    span = np.asarray(heads, np.int64)[:, None] + np.arange(step)
    chains, truth_at = np.asarray(words, np.int64)[span], np.asarray(truth, np.int64)[span]
    rows_of = table_rows(size)
    per, pieces = per & (rows_of - 1), pieces & (rows_of - 1)
    weights, moves = np.zeros((rows_of, size), np.float32), np.zeros((size, size), np.float32)
    seen, seen_moves = np.full((rows_of, size), 1e-2, np.float32), np.full((size, size), 1e-1, np.float32)
    eye = np.eye(size, dtype=np.float32)
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(chains)), max(1, len(chains) // 64)):
            w = chains[rows].reshape(-1)
            length = ends[w] - starts[w]
            inner = np.repeat(starts[w], length) + np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
            part = pieces[inner]
            e = emissions(weights, per[w], part, np.cumsum(length) - length)
            first = np.arange(len(rows) + 1) * chains.shape[1]
            p, alpha, ahead = forward_backward(e, moves, first)
            y = eye[truth_at[rows].reshape(-1)]
            g = (y - p).astype(np.float32)
            flat = np.concatenate([per[w].reshape(-1), part])
            grad = np.concatenate([np.repeat(g, per.shape[1], 0), np.repeat(g, length, 0)])
            used, inverse = np.unique(flat, return_inverse=True)
            total = np.stack([np.bincount(inverse, grad[:, j], len(used)) for j in range(size)], 1).astype(np.float32) - 0.01 * weights[used]
            seen[used] += total**2
            weights[used] += 0.3 * total / np.sqrt(seen[used])
            y, alpha, ahead = (v.reshape(len(rows), -1, size) for v in (y, alpha, ahead))
            move = np.einsum("nti,ntj->ij", y[:, :-1], y[:, 1:]) - _expected_moves(alpha, ahead, moves)
            seen_moves += move**2
            moves += 0.3 * (move / np.sqrt(seen_moves)).astype(np.float32)
    return Model(labels, weights, moves - moves.mean())


def _expected_moves(alpha: np.ndarray, ahead: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Expected number of each move: the pair probabilities of neighbouring words, summed over chains."""
    pair = alpha[:, :-1, :, None] * np.exp(moves - moves.max())[None, None] * ahead[:, 1:, None, :]
    return (pair / np.maximum(pair.sum((2, 3), keepdims=True), 1e-30)).sum((0, 1))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most: int = MOST_DOCS) -> list[tuple[str, str]]:
    """At most `most` labelled (text, language) in all, or one a language, evenly by language, chosen by hashes of the ids; of a long text a stretch of MOST_CHARS."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")).alias("h"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").agg(F.count("*")).collect()}  # a row for each language
    if not counts:
        return []
    each = max(1, most // len(counts))
    # Twice as many as are wanted, and a few more, by their hashes: enough with all but certainty, and where it is not, some fewer are learned from.
    share = F.element_at(F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, float(min(1.0, (2 * each + 40) / n))))), F.col("lang"))
    near = rows.filter(F.pmod("h", F.lit(1 << 30)) < share * float(1 << 30))
    best = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", F.xxhash64("text")))).filter(F.col("r") <= each)
    spare = F.greatest(F.length("text") - MOST_CHARS, F.lit(0))
    place = F.pmod(F.xxhash64("h", F.lit("place")), spare + 1).cast("int") + 1
    cut = F.when(spare == 0, F.col("text")).otherwise(F.regexp_replace(F.substr("text", place, F.lit(MOST_CHARS)), r"^\S*\s+|\s+\S*$", ""))
    return [(r["text"], r["lang"]) for r in best.select("lang", "r", cut.alias("text")).orderBy("lang", "r").collect()]


def _pieces(b: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Stretches of about `size` bytes that end where no word goes on; a single longer word stays whole."""
    out, at = [], 0
    while at < len(b):
        to = min(at + size, len(b))
        while to < len(b) and _LETTER[b[to]] and _LETTER[b[to - 1]]:
            more = np.flatnonzero(~_LETTER[b[to : to + size]])
            to = to + int(more[0]) if len(more) else min(to + size, len(b))
        out.append((at, to))
        at = to
    return out


def _piece_emissions(b: np.ndarray, m: Model) -> np.ndarray:
    t = Tokens(np.array([0, len(b)]), b)
    return emissions(m.weights, *t.features())


def long_text(b: np.ndarray, m: Model, size: int = PIECE) -> tuple[np.ndarray, int, int]:
    """(sums of the label probabilities, words, runs) of one text, piece by piece: forward over all pieces keeping a message each, then backward."""
    trans = np.exp(m.moves - m.moves.max()).astype(np.float32)
    pieces = _pieces(b, size)
    into: list[np.ndarray | None] = []  # message before each piece
    now = None
    for a, z in pieces:
        into.append(now)
        for x in _psi(_piece_emissions(b[a:z], m)):
            step = x if now is None else (now @ trans) * x
            now = step / step.sum()
    sums, words, runs = np.zeros(len(m.labels)), 0, 0
    beta, behind = np.ones(len(m.labels), np.float32), None  # message from behind the piece; first label behind it
    for (a, z), start in zip(reversed(pieces), reversed(into)):
        psi = _psi(_piece_emissions(b[a:z], m))
        if not len(psi):
            continue
        alpha, now = np.empty_like(psi), start
        for i, x in enumerate(psi):
            step = x if now is None else (now @ trans) * x
            now = alpha[i] = step / step.sum()
        p = np.empty_like(psi)
        for i in range(len(psi) - 1, -1, -1):
            p[i] = alpha[i] * beta
            beta = trans @ (psi[i] * beta)
            beta /= beta.sum()
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        sums += p.sum(0, dtype=np.float64)
        words += len(p)
        runs += 1 + int((best[1:] != best[:-1]).sum()) - int(behind is not None and behind == best[-1])
        behind = best[0]
    return sums, words, runs


def _psi(e: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(e - e.max(1, keepdims=True), -60, 0)).astype(np.float32) if len(e) else e


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", extra: tuple[Column, ...] = ()) -> DataFrame:
    """id, extra columns, lang_pred, score, n_words, n_runs (stretches of words with one most probable label)."""
    src = docs.select(F.col(text_col).alias("_dl_text"), id_col, *extra)
    kept = src.schema.fields[1:]
    sent = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by BITS and the number of languages

    def one_long(col: pa.Array, m: Model) -> tuple[list[str], list[float], np.ndarray, np.ndarray]:
        _, b = string_buffers(col)
        sums, words, runs = long_text(b, m)
        real = words and any(c.isalpha() for a, z in _pieces(b, PIECE) for c in bytes(b[a:z]).decode(errors="ignore"))
        k = int(sums.argmax())
        return [m.labels[k] if real else UNKNOWN], [round(float(min(1.0, sums[k] / words)), 6) if real else 0.0], np.array([words]), np.array([runs])

    def label(col: pa.Array, m: Model) -> tuple[list[str], list[float], np.ndarray, np.ndarray]:
        off, b = string_buffers(col)
        if len(off) == 2 and len(b) > 4 * PIECE:
            return one_long(col, m)
        es, firsts, base, at = [], [], 0, 0
        while at < len(off) - 1:  # features take much memory a byte: about 1 MB of text at a time
            to = max(at + 1, int(np.searchsorted(off, off[at] + (1 << 20), side="right")) - 1)
            t = Tokens(off[at : to + 1] - off[at], b[off[at] : off[to]])
            es.append(emissions(m.weights, *t.features()))
            firsts.append(t.first[:-1] + base)
            base += len(t.start)
            at = to
        first = np.append(np.concatenate(firsts), base)
        p, _, _ = forward_backward(np.concatenate(es), m.moves, first)
        n = np.diff(first)
        sums = np.zeros((len(n), len(m.labels)))
        some = np.flatnonzero(n)
        if len(some):
            sums[some] = np.add.reduceat(p.astype(np.float64), first[:-1][some])
        best = p.argmax(1) if len(p) else np.zeros(0, np.int64)
        change = np.ones(len(best), bool)
        change[1:] = best[1:] != best[:-1]
        change[first[:-1][some]] = True
        runs = np.zeros(len(n), np.int64)
        if len(some):
            runs[some] = np.add.reduceat(change.astype(np.int64), first[:-1][some])
        lang, score = [], []
        ascii_letters = np.add.reduceat(np.append(_LETTER[b] & (b < 128), False).astype(np.int64), np.minimum(off[:-1], len(b))) if len(off) > 1 else []
        for i in range(len(n)):
            real = n[i] and (ascii_letters[i] > 0 or any(c.isalpha() for c in bytes(b[off[i] : off[i + 1]]).decode()))
            k = int(sums[i].argmax()) if real else -1
            lang.append(m.labels[k] if real else UNKNOWN)
            score.append(round(float(min(1.0, sums[i][k] / n[i])), 6) if real else 0.0)
        return lang, score, n, runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in slices(batches, "_dl_text", 4 * PIECE):
            if m is None:
                lang, score, n, runs = [UNKNOWN] * b.num_rows, [0.0] * b.num_rows, np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            else:
                lang, score, n, runs = label(b.column(0), m)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(1, b.num_columns)), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(n.astype(np.int64)), pa.array(runs)],
                [*b.schema.names[1:], "lang_pred", "score", "n_words", "n_runs"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return src.mapInArrow(run, f"{schema}, lang_pred string, score double, n_words long, n_runs long")


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the documents that are not held out, predict all."""
    got = sample(docs.filter(~held_out), id_col, text_col, lang_col)
    model = fit([t for t, _ in got], [x for _, x in got]) if got else None
    return predict(docs, model, id_col, text_col, (held_out.alias("held_out"),))
