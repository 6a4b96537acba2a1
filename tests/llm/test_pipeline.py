"""The stages in a row on a small table with nulls, copies, long texts, benchmark passages and secrets; each against brute force on its own input."""

import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from deltaloom.llm import quality, secrets
from deltaloom.llm.common import materialize, release_all

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
KEY = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


def _tables():
    r = random.Random(21)
    vocab = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(600)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(0, say(40)), (1, say(60)), (2, None), (3, "too short"), (4, "")]
    texts = [say(r.randint(60, 200)) for _ in range(60)]
    base = texts[3].split()
    base[30] = "edit"
    texts += [texts[0], texts[1], texts[1] + " tail", " ".join(base), None, "", " \n ", "few words", say(4000), say(50) + " " + items[0][1] + " " + say(50), items[1][1], " ".join(w + "###" for w in say(90).split())]
    texts += [f'{say(60)} token = "{KEY}" {say(40)}', "same line of words\n" * 40]
    rows = [(i * 2, t, None if i > 60 and i % 4 == 0 else "en", "s" if i % 7 else None, len(t) if t else 0) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5]], items


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rows, items = _tables()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _near(rows, k=5):
    """Documents that stay of each group of near copies: pairs of all, by their shingles."""
    sets = {}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[p : p + k]) for p in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i for i in sets if root(i) == i}


def _leaks(text, item):
    a, b = (re.findall(r"[^\W_]+", (x or "").lower()) for x in (text, item))
    grams = lambda w: Counter(tuple(w[p : p + 5]) for p in range(len(w) - 4))
    if min(len(a), len(b)) < 5:
        return False
    best = 0
    for p in range(max(1, len(a) - len(b) + 1)):
        g, h = grams(a[p : p + len(b)]), grams(b)
        best = max(best, sum((g & h).values()) / sum((g | h).values()))
    return best >= 0.8


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    _, items = _tables()
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        was, docs = docs, materialize(stage(spark, docs, sf))
        seen[name] = (was, docs)
        if name != "best_fit_packing":
            assert docs.columns == was.columns
    was, now = map(_rows, seen["quality_rules"])
    judged = {r["doc_id"]: r["kept"] for r in quality.judge(seen["quality_rules"][0]).collect()}
    assert now == [r for r in was if judged[r[0]]] and any("###" in (r[1] or "") for r in was) and not any("###" in r[1] for r in now)
    was, now = map(_rows, seen["near_dedup"])
    left = _near(was)
    assert {r[0] for r in now} == left and len(now) == len(left) < len({r[0] for r in was}) and set(now) <= set(was)
    was, now = map(_rows, seen["decontamination"])
    assert now == [r for r in was if not any(_leaks(r[1], t) for _, t in items)] and len(was) - len(now) == 2
    was, now = map(_rows, seen["secret_scan"])
    assert [r[0] for r in now] == [r[0] for r in was] and all(r[4] == len(r[1]) for r in now)
    for a, b in zip(was, now):
        assert (b[1] == a[1].replace(KEY, secrets.MASK)) and b[2:4] == a[2:4]
    assert any(KEY in r[1] for r in was)
    was, pieces = seen["best_fit_packing"]
    full, got = defaultdict(list), defaultdict(int)
    for r in pieces.collect():
        full[r["sequence_id"]].append((r["offset"], r["length"]))
        got[r["doc_id"]] += r["length"]
    assert set(got) == {r["doc_id"] for r in was.collect()}
    for places in full.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert release_all(spark) > 0 and release_all(spark) == 0


def test_empty_tables(spark, sf, tmp_path):
    d = str(tmp_path)
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").limit(0).write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
