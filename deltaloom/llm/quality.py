"""Quality rules: base rules, then robust multivariate outliers per language and source.

Every document gets a vector of transformed statistics (mean word length, symbols per word, repeated lines,
repeated words). For each language and source the minimum-covariance-determinant estimate is fitted over all its
documents that pass the base rules: from three starts (medians with absolute deviations, the plain moments, the moments of
what lies around the medians) concentration steps go on, the h = (n + p + 1) / 2 nearest documents giving the next mean and
covariance; after two steps the start of the least determinant goes on until the determinants stand still. All documents
within a chi-square quantile of it give the estimate. It holds while junk is less than half of a group. A
document is rejected if its squared Mahalanobis distance exceeds a chi-square quantile.

DataFrame functions only. Vectors are whole thousandths, so sums are exact whatever the order of tasks. The h nearest
are found from counts of distances on a logarithmic scale, 64 steps a power of e, and take in all at the last step.
Groups of fewer than MIN_GROUP documents have too few for a covariance of their own: they share the estimate
of all such groups of their language. Groups are joined as rows; nothing is collected but one sum a step.

Null text has no words and fails the base rules; null language or source is a group of its own; an empty table
gives no rows; repeated rows are judged each for itself; columns other than those named pass through `screen`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_SPACE, materialize, release, words

SYMBOLS = "#*$%&|<>"
DIMS = ("length", "symbols", "lines", "repeats")
#: Least standard deviation of each dimension, in thousandths: statistics that are mostly zero have no spread of their own.
FLOORS = (50, 150, 30, 100)
#: Share of the nearest documents in a concentration step: half is what withstands most junk.
COVERED = 0.5
#: Share of normal data within the distance up to which documents count in the last estimate.
REWEIGHTED = 0.975
MIN_GROUP = 50
#: Upper tail of the chi-square distribution beyond which a vector is an outlier.
TAIL = 1e-6
#: All starts make so many steps, then the best one goes on until a step changes the logarithms of the determinants by
#: TOLERANCE on average, or after MOST_STEPS in all; some six do.
STEPS_OF_ALL, MOST_STEPS, TOLERANCE = 2, 25, 1e-3
_BY = ["_dl_lang", "_dl_group"]


def _chi2(x: float, half: int) -> float:
    """Distribution function of chi-square with 2 * half degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(half))


def chi2_quantile(upper: float, dims: int = len(DIMS)) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 1 - _chi2(mid, dims // 2) > upper else (lo, mid)
    return lo


def consistency(covered: float, dims: int = len(DIMS)) -> float:
    """Factor by which the covariance of the nearest share of normal data is too small."""
    return covered / _chi2(chi2_quantile(1 - covered, dims), dims // 2 + 1)


def repeated_words(w: Column) -> Column:
    """Number of words in 3-word windows that the text has twice or more."""
    n = F.size(w)
    grams = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))).otherwise(F.array().cast("array<bigint>"))

    def covered(sorted_pairs: Column) -> Column:
        last = F.size(sorted_pairs) - 1
        same = F.filter(
            sorted_pairs,
            lambda x, i: ((i > 0) & (F.get(sorted_pairs, i - 1)["g"] == x["g"])) | ((i < last) & (F.get(sorted_pairs, i + 1)["g"] == x["g"])),
        )
        at = F.sort_array(F.transform(same, lambda x: x["i"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(at, start, lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(acc["end"], p)).cast("long").alias("n"), (p + 3).alias("end")), lambda acc: acc["n"])

    pairs = lambda g: F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
    # Most texts repeat no window, and a hash set sees it at once; a sort finds the places in the others. The one-element arrays name values that are used again.
    count = lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(F.transform(F.array(pairs(g)), covered)[0])
    return F.transform(F.array(grams), count)[0]


def with_stats(docs: DataFrame, text_col: str = "text", into: str = "s") -> DataFrame:
    """Add a struct of the statistics; all other columns stay."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")
    step = docs.withColumn("_dl_w", words(F.col(text_col))).withColumn("_dl_l", lines)
    size = F.size("_dl_w").cast("long")
    step = step.withColumn(
        into,
        F.struct(
            size.alias("n_words"),
            F.length(F.translate(text, WORD_SPACE, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size("_dl_l").cast("long").alias("n_lines"),
            (F.size("_dl_l") - F.size(F.array_distinct("_dl_l"))).cast("long").alias("n_dup_lines"),
            repeated_words(F.col("_dl_w")).alias("n_repeat_words"),
        ),
    )
    return step.drop("_dl_w", "_dl_l")


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def vector(s: Column) -> list[Column]:
    """The transformed statistics of a struct, in whole thousandths."""
    n = F.greatest(s["n_words"], F.lit(1))
    forms = (
        F.log(F.greatest(s["word_chars"], F.lit(1)) / n),
        F.log(1 + 20 * s["n_symbols"] / n),
        s["n_dup_lines"] / (s["n_lines"] + 10),
        s["n_repeat_words"] / n,
    )
    return [F.round(1000 * f).cast("long").alias(d) for f, d in zip(forms, DIMS)]


#: Tables with a row for each group (three while it is fitted) are broadcast up to this many rows, else joined by a shuffle.
BROADCAST_GROUPS = 50_000


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_GROUPS else df


def _keys(lang: str, source: str) -> list[Column]:
    return [F.coalesce(F.col(lang), F.lit("\x00")).alias("_dl_lang"), F.coalesce(F.col(source), F.lit("\x00")).alias("_dl_source")]


def _distance(v: list[Column]) -> Column:
    """Squared distance by forward substitution with the Cholesky factor in columns l_i_j and means m_i.

    Each solved coordinate is named by the lambda of a one-element array: used several times, computed once.
    """

    def solve(i: int, y: list[Column]) -> Column:
        if i == len(v):
            return sum((x * x for x in y[1:]), y[0] * y[0])
        rest = v[i] - F.col(f"m_{i}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * y[j]
        return F.transform(F.array(rest / F.col(f"l_{i}_{i}")), lambda x: solve(i + 1, [*y, x]))[0]

    return solve(0, [])


def _factor(params: DataFrame) -> DataFrame:
    """Cholesky factor of the covariance columns c_i_j, the squares of the floors added to its diagonal, and ld, the logarithm of its determinant."""
    p = len(DIMS)
    for i in range(p):
        for j in range(i + 1):
            at = F.col(f"c_{i}_{j}") + (float(FLOORS[i] ** 2) if i == j else 0.0)
            for k in range(j):
                at = at - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            params = params.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(at, F.lit(1.0))) if i == j else at / F.col(f"l_{j}_{j}"))
    keys = [c for c in (*_BY, "_dl_start") if c in params.columns]
    params = params.withColumn("ld", 2 * sum((F.log(f"l_{i}_{i}") for i in range(1, p)), F.log("l_0_0")))
    return params.select(*keys, "ld", *(f"m_{i}" for i in range(p)), *(f"l_{i}_{j}" for i in range(p) for j in range(i + 1)))


def _estimate(near: DataFrame, factor: float, by: list[str]) -> DataFrame:
    """Mean and covariance, times the factor, of each group's rows."""
    sums = near.groupBy(*by).agg(
        F.count("*").alias("n"), *(F.sum(d).alias(f"s_{i}") for i, d in enumerate(DIMS)),
        *(F.sum(F.col(DIMS[i]) * F.col(DIMS[j])).alias(f"p_{i}_{j}") for i in range(len(DIMS)) for j in range(i + 1)),
    )
    n = F.col("n")
    means = sums.withColumns({f"m_{i}": F.col(f"s_{i}") / n for i in range(len(DIMS))})
    return means.withColumns({f"c_{i}_{j}": factor * (F.col(f"p_{i}_{j}") / n - F.col(f"m_{i}") * F.col(f"m_{j}")) for i in range(len(DIMS)) for j in range(i + 1)})


def _edges(far: DataFrame, by: list[str]) -> DataFrame:
    """Distance _d of the h-th nearest row of each group, h = (n + p + 1) / 2, from the counts of the distinct distances."""
    counts = far.groupBy(*by, "_d").agg(F.count("*").alias("n"))
    within = F.sum("n").over(Window.partitionBy(*by).orderBy("_d"))
    total = F.sum("n").over(Window.partitionBy(*by))
    half = F.least(total, F.floor((total + len(DIMS) + 1) * COVERED))
    return counts.withColumns({"_within": within, "_half": half}).filter("_within >= _half").groupBy(*by).agg(F.min("_d").alias("_edge"))


def _starts(rows: DataFrame, n_groups: int) -> DataFrame:
    """Three first estimates of every group."""
    middle = rows.groupBy(*_BY).agg(*(F.percentile(d, F.lit(0.5)).alias(f"m_{i}") for i, d in enumerate(DIMS)))
    away = rows.join(_small(middle, n_groups), _BY).groupBy(*_BY).agg(
        *(F.first(f"m_{i}").alias(f"m_{i}") for i in range(len(DIMS))), *(F.percentile(F.abs(F.col(d) - F.col(f"m_{i}")), F.lit(0.5)).alias(f"a_{i}") for i, d in enumerate(DIMS))
    )
    away = materialize(away)
    medians = away.withColumns({f"c_{i}_{j}": F.pow(1.4826 * F.col(f"a_{i}"), 2) if i == j else F.lit(0.0) for i in range(len(DIMS)) for j in range(i + 1)})
    around = rows.join(_small(away, n_groups), _BY)
    for i, d in enumerate(DIMS):
        around = around.filter(F.abs(F.col(d) - F.col(f"m_{i}")) <= 2 * F.greatest(1.4826 * F.col(f"a_{i}"), F.lit(FLOORS[i])))
    out = [_factor(medians), _factor(_estimate(rows, 1.0, _BY)), _factor(_estimate(around, 1.0, _BY))]
    return out[0].withColumn("_dl_start", F.lit(0)).unionByName(out[1].withColumn("_dl_start", F.lit(1))).unionByName(out[2].withColumn("_dl_start", F.lit(2)))


def concentrate(rows: DataFrame, n_groups: int) -> DataFrame:
    """The estimate of least determinant of each group (_dl_lang, _dl_group) of rows: its logarithm ld, means and Cholesky factor."""
    by = [*_BY, "_dl_start"]
    model, last, per_group = materialize(_starts(rows, n_groups)), None, 3
    for k in range(MOST_STEPS):
        # Distances on a logarithmic scale of 64 steps a power of e: a bounded number of distinct values a group.
        far = rows.join(_small(model, per_group * n_groups), _BY).select(*by, *DIMS, F.floor(64 * F.log(_distance([F.col(d) for d in DIMS]) + 1e-3)).alias("_d"))
        near = far.join(_small(_edges(far, by), per_group * n_groups), by).filter(F.col("_d") <= F.col("_edge"))
        was, model = model, materialize(_factor(_estimate(near, consistency(COVERED), by)))
        release(was)
        if k + 1 == STEPS_OF_ALL:  # the start that is ahead by now goes on alone
            kept = [c for c in model.columns if c not in by]
            was, model = model, materialize(model.groupBy(*_BY).agg(F.min_by(F.struct(*kept), F.struct("ld", "_dl_start")).alias("b")).select(*_BY, "b.*"))
            release(was)
            by, per_group, last = _BY, 1, None
        # Sums of whole numbers over the same rows are the same, so a step that changes nothing is seen for sure.
        now = model.agg(F.sum(F.round(1e6 * F.col("ld")).cast("decimal(38,0)"))).first()[0]
        if per_group == 1 and (now is None or last is not None and abs(last - now) <= 1e6 * TOLERANCE * n_groups):
            break
        last = now
    return model


def fit(stats: DataFrame, lang: str = "lang", source: str = "source") -> tuple[DataFrame, DataFrame, int]:
    """(groups, model, n): which group each language and source belongs to, each group's mean and Cholesky factor, rows of groups.

    stats: lang, source and the struct s of every document, read several times over: give a written table.
    """
    base = stats.filter(~base_failed(F.col("s"))).select(*_keys(lang, source), *vector(F.col("s")))
    pooled = F.when(F.col("n") >= MIN_GROUP, F.col("_dl_source")).otherwise("\x01")
    groups = materialize(base.groupBy("_dl_lang", "_dl_source").agg(F.count("*").alias("n")).withColumn("_dl_group", pooled).drop("n"))
    n_groups = groups.count()
    rows = materialize(base.join(_small(groups, n_groups), ["_dl_lang", "_dl_source"]).drop("_dl_source"))
    raw = concentrate(rows, n_groups)
    # Half of a group estimates roughly; all that lies within reach of it estimates well, and still takes no junk in.
    within = rows.join(_small(raw, n_groups), _BY).filter(_distance([F.col(d) for d in DIMS]) <= chi2_quantile(1 - REWEIGHTED))
    model = materialize(_factor(_estimate(within, consistency(REWEIGHTED), _BY)))
    release(raw)
    release(rows)
    return groups, model, n_groups


def score(stats: DataFrame, groups: DataFrame, model: DataFrame, n_groups: int, lang: str = "lang", source: str = "source", tail: float = TAIL) -> DataFrame:
    """Add base_failed, distance (null if the base rules failed) and kept to rows with the struct s."""
    keys = _keys(lang, source)
    joined = stats.withColumns({"_dl_lang": keys[0], "_dl_source": keys[1]}).join(_small(groups, n_groups), ["_dl_lang", "_dl_source"], "left").join(_small(model.drop("ld"), n_groups), _BY, "left")
    edge = chi2_quantile(tail)

    def verdict(x: Column) -> Column:
        failed = base_failed(x)
        far = F.when(~failed, F.transform(F.array(F.struct(*vector(x))), lambda v: _distance([v[d] for d in DIMS]))[0])
        return F.transform(F.array(F.round(far, 6)), lambda d: F.struct(failed.alias("base_failed"), d.alias("distance"), (~failed & F.coalesce(d <= edge, F.lit(True))).alias("kept")))[0]

    # The lambda names the statistics: texts are gone through once, however often a verdict looks at them.
    both = F.transform(F.array("s"), lambda x: F.struct(x.alias("s"), verdict(x).alias("v")))[0]
    judged = joined.withColumn("_dl_v", both)
    return judged.select(*(F.col("_dl_v.s").alias(c) if c == "s" else F.col(c) for c in stats.columns), "_dl_v.v.base_failed", "_dl_v.v.distance", "_dl_v.v.kept")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance of every document."""
    stats = materialize(with_stats(docs.select(id_col, text_col, lang, source), text_col).drop(text_col))
    groups, model, n = fit(stats, lang, source)
    out = score(stats, groups, model, n, lang, source)
    return out.select(id_col, *(f"s.{x}" for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), "base_failed", "kept", "distance")


def screen(docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that pass, with all their columns. The second pass computes the statistics again rather than shuffle the texts."""
    stats = materialize(with_stats(docs.select(text_col, lang, source), text_col).drop(text_col))
    groups, model, n = fit(stats, lang, source)
    row = docs.select(F.struct("*").alias("_dl_row"), F.col(text_col).alias("_dl_text"), F.col(lang).alias("_dl_by_lang"), F.col(source).alias("_dl_by_source"))
    judged = score(with_stats(row, "_dl_text").drop("_dl_text"), groups, model, n, "_dl_by_lang", "_dl_by_source")
    return judged.filter("kept").select("_dl_row.*")
