"""Secret scans: candidate strings, judged by a random forest.

Candidates are the parts of words that look like credentials by themselves (a known prefix, or 16 or more characters
with digits among them), or that follow a telling word and an assignment, or stand as a password in a URL. A word may
hold several; only words that are e-mail addresses hold none. An assigned value is taken whole: to its closing
quote, or else to the next comma, semicolon, ampersand or bracket, less repeated marks at its end. Each candidate gets features:
length, how likely its characters follow each other in ordinary words, how much of it is made of dictionary
words, path marks, neighbouring words. The dictionary is learned from all texts (the DICTIONARY words that stand in most
documents, beside some fixed pieces), and so are the transitions of characters.

A small random forest, trained on the driver from a table of labelled findings (at most MOST_FINDINGS rows, chosen by
their hashes; by default a table made from rules, the same every time), removes false positives. Its trees
are laid out as constant arrays that column expressions walk down, so scoring stays in DataFrames: no Python runs on executors.

Null and empty texts have no findings; repeated rows are scanned each for itself; an empty table gives no rows;
other columns pass through `redact`; rows without an id keep their text there.
"""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, words

MOST_FINDINGS = 6000
#: Words of the learned dictionary.
DICTIONARY = 400
MASK = "[SECRET]"
#: Words that announce credentials, and words that announce samples.
TELLING = r"(?i)(api[_-]?key|secret|token|passw(or)?d|passwd|pwd|credential|auth|bearer|access[_-]?key|private[_-]?key|client[_-]?secret)"
SAMPLE = r"(?i)(example|sample|dummy|placeholder|changeme|your[_-]|xxxx|test|fake|demo|lorem|todo|none|null)"
#: Prefixes by which issuers mark their keys.
ISSUED = r"(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+|glpat-[A-Za-z0-9_-]{20})"
#: Pieces of ordinary words and identifiers.
_FIXED = (
    "the and ing tion ment able user name file path data test code main java python http www com org net value string number index page image config server client public static class return version release example sample placeholder password secret token change your here key mail host local home src lib build docs html json text table column query order product item list with from this that for not are was have will into over under"
).split()
_PLAIN = r"[A-Za-z0-9+/_.~-]"
_OPEN = lambda p: re.sub(r"\((?!\?)", "(?:", p.replace("(?i)", ""))
_TOLD = rf"(?<=(?i:{_OPEN(TELLING)}).{{0,3}}[=:]"
#: Values in a word, each with the text between the one before and itself: issued keys, passwords in URLs, assigned values, plain runs that are no names.
_VALUES = (
    rf"""(.*?)({_OPEN(ISSUED)}|(?<=://[^/:@]{{0,64}}:)[^/@]{{4,}}(?=@)|{_TOLD}["'`])[^"'`]{{8,}}(?=["'`])"""
    rf"""|{_TOLD})(?=[^"'`,;&<>(){{}}\[\]]{{8}})[^"'`,;&<>(){{}}\[\]]*[A-Za-z0-9](?:={{1,2}}|[!#$%^*](?![!#$%^*]))?"""
    rf"""|(?:(?!{_OPEN(ISSUED)}){_PLAIN}){{8,}}+(?!["']?[=:]{{1,2}}["']?{_PLAIN})(?:={{1,2}}(?!["']?{_PLAIN}))?)"""
)
_URL_PASSWORD = r"://[^/:@]*:$"
_MAIL = r"(?i)^\W*(?:(?:e-?mail|mailto)[:=])?\W*[\w.%+-]+@[\w-]+(?:\.[\w-]+)+(?:[,;<>]+[\w.%+-]+@[\w-]+(?:\.[\w-]+)+)*\W*$"
#: Stands in for the name when it is a word of its own.
_NAME = "token="

@dataclass(frozen=True)
class Lexicon:
    """What ordinary words are made of: a pattern of dictionary words, and log-likelihoods of one character after another (28 x 28: letters, digits, the rest)."""

    words: str
    moves: tuple[float, ...]


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    forest: tuple[tuple, ...]


def _code(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else 26 if c.isdigit() else 27


def lexicon(counts: list[tuple[str, int]]) -> Lexicon:
    """From words and how many documents hold each."""
    seen = np.full((28, 28), 0.5)
    for word, n in [*counts, *((w, 1) for w in _FIXED)]:
        codes = [_code(c) for c in word.lower()]
        for x, y in zip(codes, codes[1:]):
            seen[x, y] += math.log1p(n)
    moves = np.log(seen / seen.sum(1, keepdims=True))
    learned = sorted({w for w, _ in counts if len(w) > 3} | set(_FIXED), key=lambda w: (-len(w), w))
    return Lexicon("(?i)(?:" + "|".join(map(re.escape, learned)) + ")", tuple(round(float(m), 4) for m in moves.reshape(-1)))


def learn_words(docs: DataFrame, text_col: str = "text") -> list[tuple[str, int]]:
    """The DICTIONARY words of four letters or more that stand in most documents, counted over all of them."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(r"(?<![\p{L}\p{N}])(\p{L}{4,20})(?![\p{L}\p{N}])"), 1))
    counts = docs.select(F.explode(found).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return [(r["w"], r["n"]) for r in counts.orderBy(F.desc("n"), "w").limit(DICTIONARY).collect()]


FEATURES = ("length", "digits", "uppers", "kinds", "transitions", "distinct", "hexlike", "dictionary", "vowels", "slashes", "dots", "telling", "assigned", "quoted", "sample", "issued", "all_digits")


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def candidates(w: Column) -> Column:
    """Array of (i, word, value, before, o) of the candidates in each word; word: the text between the value and what comes before it in its word; before: the three words ahead, joined by spaces; o: where in the word the value starts."""

    def look(x: Column, i: Column) -> Column:
        before = F.concat_ws(" ", F.get(w, i - 3), F.get(w, i - 2), F.get(w, i - 1))
        bare = F.length(x) >= 16
        strong = lambda v: v.rlike(ISSUED) | (v.rlike(r"\d") & (v.rlike(r"[A-Za-z]") | v.rlike(r"\d{16}")) & v.rlike(r"[A-Za-z0-9+/_~-]{16}"))
        after = x.rlike(r"[0-9]") & before.rlike(r"[=:]\W*$") & before.rlike(TELLING)
        told = (F.length(x) >= 8) & (x.rlike(TELLING + r".{0,3}[=:]") | x.rlike(r"://[^/:@]*:[^/@]{4,}@") | after)

        def parts(known: Column) -> Column:
            named = F.when(known, F.concat(F.lit(_NAME), x)).otherwise(x)
            found = F.arrays_zip(F.regexp_extract_all(named, F.lit(_VALUES), 1).alias("gap"), F.regexp_extract_all(named, F.lit(_VALUES), 2).alias("value"))

            def part(p: Column, k: Column) -> Column:
                gap = F.when(known & (k == 0), F.substring(p["gap"], len(_NAME) + 1, 1 << 30)).otherwise(p["gap"])
                url = p["gap"].rlike(_URL_PASSWORD)
                keep = strong(p["value"]) | url | p["gap"].rlike(TELLING + r".{0,3}[=:]")
                ahead = F.when(url, F.concat(before, F.lit(" password"))).otherwise(before)
                return lambda o: F.when(keep, F.struct(i.alias("i"), gap.alias("word"), p["value"].alias("value"), ahead.alias("before"), o.alias("o")))

            def all_parts(f: Column) -> Column:
                # Values and the text between them fill the word from its start.
                at = lambda k: F.aggregate(F.slice(f, 1, k), F.when(known, -len(_NAME)).otherwise(0), lambda acc, q: acc + F.length(q["gap"]) + F.length(q["value"]))
                return F.filter(F.transform(f, lambda p, k: part(p, k)(at(k) + F.length(p["gap"]))), lambda c: c.isNotNull())

            whole = F.array(F.struct(i.alias("i"), x.alias("word"), x.alias("value"), before.alias("before"), F.lit(0).alias("o")))
            return F.transform(F.array(found), lambda f: F.when(F.size(f) == 0, whole).otherwise(all_parts(f)))[0]

        return F.when(((bare & strong(x)) | told) & ~x.rlike(_MAIL), F.transform(F.array(after), parts)[0])

    return F.flatten(F.filter(F.transform(w, look), lambda c: c.isNotNull()))


def _likelihood(value: Column, lex: Lexicon) -> Column:
    """Mean log-likelihood of each character after the one before."""
    moves = F.array(*(F.lit(m) for m in lex.moves))
    code = lambda c: F.when((c >= "a") & (c <= "z"), F.ascii(c) - 97).when((c >= "0") & (c <= "9"), 26).otherwise(27)
    codes = F.transform(F.filter(F.split(F.lower(value), ""), lambda c: c != ""), code)

    def mean(x: Column) -> Column:
        n = F.size(x)
        each = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.coalesce(F.get(moves, F.get(x, i - 1) * 28 + F.get(x, i)), F.lit(0.0)))
        return F.aggregate(each, F.lit(0.0), lambda acc, m: acc + m) / F.greatest(n - 1, F.lit(1))

    return F.transform(F.array(codes), mean)[0]


def features(value: Column, word: Column, before: Column, lex: Lexicon) -> dict[str, Column]:
    n = F.greatest(F.length(value), F.lit(1))
    ahead = F.concat_ws(" ", before, F.regexp_replace(word, r"[^=:]*$", ""))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, r"\d+", "9"), r"[a-z]+", "a"), r"[A-Z]+", "B"), r"[^9aB]+", "_")
    distinct = F.size(F.array_distinct(F.split(value, "")))
    out = {
        "length": n, "digits": _count(value, r"\d") / n, "uppers": _count(value, r"[A-Z]") / n, "kinds": (F.length(kinds) - 1) / n, "transitions": _likelihood(value, lex), "distinct": distinct / F.least(n, F.lit(40)),
        "hexlike": value.rlike(r"^[0-9a-fA-F]+$"), "dictionary": _count(value, lex.words) / n, "vowels": _count(value, r"[aeiouAEIOU]") / n, "slashes": _count(value, r"/"), "dots": _count(value, r"\."),
        "telling": ahead.rlike(TELLING), "assigned": ahead.rlike(r"[=:]\W*$"), "quoted": word.rlike("[\"'`]"), "sample": F.concat_ws(" ", ahead, value).rlike(SAMPLE), "issued": value.rlike(ISSUED), "all_digits": value.rlike(r"^\d+$"),
    }
    return {k: F.round(v.cast("double"), 6) for k, v in out.items()}


def labelled_findings(n: int = 4000, seed: int = 11) -> list[tuple[str, str, str, int]]:
    """(value, word, before, label): made-up findings, half of them true."""
    r = random.Random(seed)
    hexes, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    syllables = "the and ing tion ment able user name file path data code main index page order item list with from un der ion ver sch en er le la que eau cion ado".split()
    pick = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
    names = "token secret api_key apikey password access_key client_secret auth_token TOKEN API_KEY".split()
    out = []
    for _ in range(n // 2):
        kind = r.random()
        value = (
            pick(hexes, r.choice((32, 40, 64))) if kind < 0.35 else pick(hexes.upper(), r.choice((32, 40))) if kind < 0.45 else "AKIA" + pick(alnum[:26] + "0123456789", 16) if kind < 0.55
            else "ghp_" + pick(alnum, 36) if kind < 0.65 else pick(alnum + "+/", r.choice((24, 32, 44))) if kind < 0.9 else pick(alnum + "-_", r.randint(12, 20))
        )
        told = r.random() < 0.85 or kind >= 0.9
        name, q, after = r.choice(names), r.choice(('"', "'", "", '"')), r.choice(("", "", ",", ";", "!!", "###", "$$$"))
        if told and r.random() < 0.6:
            out.append((value, f"{q}{value}{q}{after}", f"{word()} {name} {r.choice('=:')}", 1))
        elif told:
            out.append((value, f"{name}{r.choice('=:')}{q}{value}{q}{after}", f"{word()} {word()} {word()}", 1))
        elif kind < 0.45:
            out.append((value, f"{q}{value}{q}", f"{word()} {name} {word()}", 1))
        else:
            out.append((value, f"{q}{value}{q}{after}", f"{word()} {word()} {word()}", 1))
    for _ in range(n - n // 2):
        kind = r.random()
        value = (
            pick("0123456789", r.choice((16, 17, 18, 20))) if kind < 0.2 else "/".join(word() for _ in range(r.randint(3, 6))) + f"/v{r.randint(1, 99)}.{r.choice(('py', 'java', 'html'))}" if kind < 0.4
            else "-".join(word() for _ in range(r.randint(3, 5))) + f"-{r.randint(1, 2030)}" if kind < 0.55 else "_".join(word() for _ in range(r.randint(3, 5))) + str(r.randint(0, 99)) if kind < 0.7
            else r.choice(("your_api_key_here1", "changeme12345678", "xxxxxxxxxxxxxxxx0000", "example-token-0123456789", "test_secret_placeholder1")) if kind < 0.85
            else f"2024-{r.randint(10, 12)}-{r.randint(10, 28)}T{r.randint(10, 23)}-{r.randint(10, 59)}-00" if kind < 0.92 else word().capitalize() + word().capitalize() + word().capitalize() + word() + str(r.randint(1, 9))
        )
        told = r.random() < (0.3 if kind < 0.7 else 0.8 if kind < 0.85 else 0.2)
        name, q, after = r.choice(names), r.choice(('"', "'", "", "")), r.choice(("", "", ",", ".", "!!", "###", "$$$"))
        before = f"{word()} {name} {r.choice('=:')}" if told else f"{word()} {r.choice((word(), 'file', 'path', 'see', 'number'))} {r.choice((word(), 'in', '=', ':', 'at'))}"
        out.append((value, f"{q}{value}{q}{after}", before, 0))
    return out


def _tree(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int) -> tuple:
    """(feature, threshold, left, right) by the best split of some features, or a leaf's share of true findings."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(y) < 8:
        return (round(share, 4),)
    best = (len(y) * share * (1 - share) - 1e-9, None, None)
    for f in rng.choice(x.shape[1], 5, replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        if not len(cut):
            continue
        left, n = t[cut - 1], len(y)
        cost = left * (1 - left / cut) + (t[-1] - left) * (1 - (t[-1] - left) / (n - cut))
        k = int(np.argmin(cost))
        if cost[k] < best[0]:
            best = (float(cost[k]), int(f), float((v[cut[k] - 1] + v[cut[k]]) / 2))
    if best[1] is None:
        return (round(share, 4),)
    side = x[:, best[1]] <= best[2]
    return best[1], best[2], _tree(x[side], y[side], rng, depth - 1), _tree(x[~side], y[~side], rng, depth - 1)


FINDING = "value string, word string, before string, label int"


def train(spark: SparkSession, docs: DataFrame | None = None, findings: DataFrame | list[tuple[str, str, str, int]] | None = None, trees: int = 15, depth: int = 5, seed: int = 5, text_col: str = "text") -> Model:
    """A lexicon from all docs (else from fixed words only), and a random forest from labelled findings; features come from the same expressions as in scans."""
    lex = lexicon(learn_words(docs, text_col) if docs is not None else [])
    rows = findings if isinstance(findings, DataFrame) else spark.createDataFrame(findings if findings is not None else labelled_findings(), FINDING)
    some = rows.select("value", "word", "before", F.col("label").cast("int").alias("label")).orderBy(F.xxhash64("value", "word", "before"), "value", "word", "before", "label").limit(MOST_FINDINGS)
    got = some.select("label", *(c.alias(k) for k, c in features(F.col("value"), F.col("word"), F.col("before"), lex).items())).collect()
    x, y = np.array([r[1:] for r in got], float), np.array([r[0] for r in got], float)
    rng = np.random.default_rng(seed)
    forest = []
    for _ in range(trees):
        drawn = rng.integers(0, len(y), len(y))
        forest.append(_tree(x[drawn], y[drawn], rng, depth))
    return Model(lex, tuple(forest))


def _nodes(tree: tuple, out: list[tuple]) -> int:
    """Lay a tree out as rows (feature, threshold, left, right, share); leaves have feature -1. Index of its root."""
    at = len(out)
    out.append((-1, 0.0, at, at, tree[0]) if len(tree) == 1 else None)
    if len(tree) > 1:
        left, right = _nodes(tree[2], out), _nodes(tree[3], out)
        out[at] = (tree[0], tree[1], left, right, 0.0)
    return at


def _score(forest: list[tuple], x: Column) -> Column:
    """Mean share of true findings over the leaves that the features (an array) reach. The forest is a constant, not code."""
    rows: list[tuple] = []
    roots = [_nodes(t, rows) for t in forest]
    depth = 1 + max(_depth(t) for t in forest)
    columns = [F.array(*(F.lit(r[i]) for r in rows)) for i in range(5)]
    feature, edge, left, right, share = columns

    def step(at: Column, _: Column) -> Column:
        f = F.get(feature, at)
        return F.when(f < 0, at).when(F.get(x, F.greatest(f, F.lit(0))) <= F.get(edge, at), F.get(left, at)).otherwise(F.get(right, at))

    levels = F.array(*(F.lit(i) for i in range(depth)))
    reached = F.transform(F.array(*(F.lit(r) for r in roots)), lambda root: F.get(share, F.aggregate(levels, root, step)))
    return F.aggregate(reached, F.lit(0.0), lambda acc, v: acc + v) / len(forest)


def _depth(tree: tuple) -> int:
    return 0 if len(tree) == 1 else 1 + max(_depth(tree[2]), _depth(tree[3]))


def _places(text: Column, found: Column) -> Column:
    """Where the value of each candidate starts in the text: 0-based. What lies between two candidates is measured once, so the text is gone through once."""
    # Words with the white space behind them; white space ahead of the first is a chunk of its own.
    chunks = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")

    def walk(parts: Column) -> Column:
        lead = F.when(F.get(parts, F.lit(0)).rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)

        def step(acc: Column, c: Column) -> Column:
            word = acc["at"] + F.length(F.array_join(F.slice(parts, acc["i"] + lead + 1, c["i"] - acc["i"]), ""))
            return F.struct(c["i"].alias("i"), word.alias("at"), F.concat(acc["out"], F.array(word + c["o"])).alias("out"))

        first = F.when(lead == 1, F.length(F.get(parts, F.lit(0)))).otherwise(0)
        start = F.struct(F.lit(0).alias("i"), first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(found, start, step, lambda acc: acc["out"])

    return F.transform(F.array(chunks), walk)[0]


def findings(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """id, word_index, start (of the value in the text, 0-based), length, value_sha256, score, is_secret of every candidate."""
    step = docs.select(F.col(id_col), F.col(text_col).alias("_dl_text"), words(F.col(text_col)).alias("_dl_w"))
    step = step.select(id_col, "_dl_text", candidates(F.col("_dl_w")).alias("_dl_c")).filter(F.size("_dl_c") > 0)
    step = step.select(id_col, F.explode(F.arrays_zip(F.col("_dl_c").alias("c"), _places(F.col("_dl_text"), F.col("_dl_c")).alias("at"))).alias("x"))
    return _judged(step.select(id_col, "x.c", "x.at"), model, threshold).select(
        id_col, F.col("c.i").alias("word_index"), F.col("at").alias("start"), F.length("c.value").alias("length"), F.sha2("c.value", 256).alias("value_sha256"), "score", "is_secret"
    )


def _judged(rows: DataFrame, model: Model, threshold: float) -> DataFrame:
    made = features(F.col("c.value"), F.col("c.word"), F.col("c.before"), model.lexicon)
    score = F.transform(F.array(F.array(*(made[k] for k in FEATURES))), lambda x: _score(list(model.forest), x))[0]
    return rows.withColumn("score", F.round(score, 6)).withColumn("is_secret", F.col("score") >= threshold)


def redact(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """All documents with all their columns; each secret in the text gives way to MASK.

    Candidates are few: they are judged apart, and the values found go back to their documents by a join on the id
    (null ids keep their text).
    """
    step = docs.select(F.col(id_col).alias("_dl_id"), words(F.col(text_col)).alias("_dl_w")).select("_dl_id", candidates(F.col("_dl_w")).alias("_dl_c"))
    rows = step.filter(F.size("_dl_c") > 0).select("_dl_id", F.explode("_dl_c").alias("c"))
    hits = _judged(rows, model, threshold).filter("is_secret").select("_dl_id", F.col("c.value").alias("v")).distinct()
    # Longer values first: one may lie within another.
    per = hits.groupBy("_dl_id").agg(F.reverse(F.array_sort(F.collect_list(F.struct(F.length("v").alias("n"), F.col("v").alias("v"))))).alias("_dl_hits"))
    joined = docs.join(materialize(per), docs[id_col] == F.col("_dl_id"), "left")
    masked = F.aggregate("_dl_hits", F.col(text_col), lambda text, h: F.replace(text, h["v"], F.lit(MASK)))
    return joined.select(*(F.when(F.col("_dl_hits").isNull(), F.col(c)).otherwise(masked).alias(c) if c == text_col else F.col(c) for c in docs.columns))
