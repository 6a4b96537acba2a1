"""Parts that need no Spark, against brute force."""

import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deltaloom.llm import chat, html, language, packing, suffix
from deltaloom.llm.grams import Words, shingle_sets
from deltaloom.llm.minhash import bands, signatures
from deltaloom.llm.repeats import Kind, Units, merged


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(2, 5), min_size=0, max_size=80))
def test_suffix_array_and_prefixes(values):
    s = np.asarray([*values, 0], np.int64)
    sa = suffix.suffix_array(s, 6)
    want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
    assert sa.tolist() == want
    plcp = suffix.permuted_prefixes(s, sa)
    for r in range(1, len(s)):
        i, j, n = want[r], want[r - 1], 0
        while max(i, j) + n < len(s) and s[i + n] == s[j + n] and s[i + n] > suffix.SEPARATOR:
            n += 1
        assert plcp[i] == n


def test_prefixes_stop_at_separators():
    s = np.asarray([5, 6, 7, 1, 5, 6, 7, 1, 5, 6, 8, 1, 0], np.int64)
    plcp = suffix.permuted_prefixes(s, suffix.suffix_array(s, 9))
    assert max(plcp[[0, 4]]) == 3


TEXTS = ["", "a", " a  b\n", "The THE the the the", "a b c d e a b c d", "é à\x0bx\x0cy  z", None]


def test_words_and_sets():
    w = Words(pa.array(TEXTS, pa.string()), lower=True)
    for i, t in enumerate(TEXTS):
        found = re.findall(r"[^\x20\x09-\x0D]+", (t or ""))
        a, z = w.first[i], w.first[i + 1]
        got = [bytes(w.bytes[s:e]).decode() for s, e in zip(w.start[a:z], w.end[a:z])]
        assert got == found
    d, _ = shingle_sets(w, 4)
    assert np.bincount(d, minlength=len(TEXTS)).tolist() == [0, 1, 1, 1, 5, 2, 0]


def test_words_that_a_polynomial_hash_cannot_tell_apart():
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    words = [a, b, a[:16], b[:16], "ab", "ba", "a", "a\0", "a" * 32, "a" * 33, "a" * 31, "x" * 100]
    w = Words(pa.array([" ".join(words)]))
    assert len(set(w.hash.tolist())) == len(words)
    again = Words(pa.array(["pad " + " ".join(reversed(words))]))
    assert again.hash[1:].tolist() == w.hash[::-1].tolist()


def test_signature_similarity_follows_the_sets():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 400, np.uint64)
    other = np.concatenate([base[:360], r.integers(0, 1 << 63, 40, np.uint64)])  # similarity 360 / 440
    d = np.concatenate([np.zeros(400, int), np.ones(400, int)])
    sig = signatures(d, np.concatenate([np.sort(base), np.sort(other)]), 2)
    assert abs((sig[0] == sig[1]).mean() - 360 / 440) < 0.1
    keys = bands(sig)
    assert (keys[0] == keys[1]).any()


@pytest.mark.parametrize("kind", [Kind(True, 4, 2), Kind(False, 8, 3)])
def test_equal_windows_have_equal_minimizers(kind):
    r = random.Random(5)
    texts = ["".join(r.choice("ab ") for _ in range(r.randint(0, 60))) for _ in range(60)]
    u = Units(pa.array(texts), kind)
    marks, first, n = u.paths()
    seen, total = {}, 0
    for mark, a, k in zip(marks, first, n):
        for t in range(a, a + k):
            window = bytes(u.bytes[t : t + kind.k]) if not kind.words else b" ".join(bytes(u.bytes[u.start[t] : u.end[t + kind.k - 1]]).split())
            assert seen.setdefault(window, mark) == mark
            total += 1
    assert total == sum(max(0, x - kind.k + 1) for x in np.diff(u.first))


def test_merged():
    assert merged([(5, 7), (0, 2), (2, 3), (6, 9)]) == [(0, 3), (5, 9)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "s>", "/", "[INST", "]", "a", "|end|>", "é\n"]), max_size=12).map("".join), st.sampled_from(["user", "assistant", "</s>", ""]))
def test_chat_round_trip(text, role):
    piece, a, z = chat.format_turn(role, text)
    assert list(chat.read_turns(piece)) == [(role, text)]
    assert chat.unescape(piece[a:z]) == text
    assert not any(c in piece[a:z] for c in chat.CONTROL)


@pytest.mark.parametrize(
    "record,turns",
    [
        ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
        ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\n\nx"), ("assistant", "o")]),
        ({"instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
        ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}]}, [("system", "s"), ("user", "u")]),
        ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}, [("user", "h"), ("assistant", "g")]),
        ({"unknown": 1}, []),
        ({}, []),
        ("text", []),
    ],
)
def test_layouts(record, turns):
    name, got = chat.canonical(record)
    assert got == turns and (name is not None) == bool(turns)


PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href="/x">Menu</a></li></ul></nav>
<div class="sidebar">Side <b>bar</b></div><div id="cookie-notice">We use cookies</div><form><label>Name</label><input></form>
<article><h1>Head &amp; line</h1><p>First <b>para</b>graph,<br>with a   break and enough words to count as text of the page.</p><p>Short.</p>
<p>Third&nbsp;one &lt;b&gt; is a long paragraph again, so that the ratio of text to tags is high.<p>Unclosed paragraph that ends with the next.</p></article>
<section class="comments"><p>I am a reader comment that is rather long, and yet no part of the article at all.</p></section><footer>Foot &copy;</footer></body></html>"""


def test_main_text():
    assert html.extract_text(PAGE).split("\n") == [
        "Head & line", "First paragraph, with a break and enough words to count as text of the page.", "Short.",
        "Third one <b> is a long paragraph again, so that the ratio of text to tags is high.", "Unclosed paragraph that ends with the next.",
    ]
    for empty in (None, "", "<p></p>", "<script>x</script>"):
        assert html.extract_text(empty) == ""
    assert html.extract_text("plain text") == "plain text"
    assert html.extract_text("<div class=ad>x</div><div><p>only text here</p></div>") == "only text here"


def _least_bins(counts, size):
    """The lower bound of Martello and Toth: long pieces need bins of their own, and the rest must fit beside the middle ones."""
    best = 0
    for a in range(size // 2 + 1):
        long = sum(k for n, k in counts.items() if n > size - a)
        middle = sum(k for n, k in counts.items() if size / 2 < n <= size - a)
        room = middle * size - sum(n * k for n, k in counts.items() if size / 2 < n <= size - a)
        short = sum(n * k for n, k in counts.items() if a <= n <= size / 2)
        best = max(best, long + middle + max(0, -(-(short - room) // size)))
    return best


def test_packing_plan_uses_all_and_fits():
    r = random.Random(1)
    counts = {r.randint(1, 100): r.randint(1, 50) for _ in range(40)}
    left = dict.fromkeys(counts, 0)
    bins = 0
    for times, pattern in packing.plan(counts, 100):
        assert sum(n * k for n, k in pattern) <= 100
        bins += times
        for n, k in pattern:
            left[n] += k * times
    assert left == counts
    assert bins <= _least_bins(counts, 100) * 1.02 + 2


def test_fullest_is_full_when_it_can_be():
    assert packing.fullest({7: 1, 5: 2, 3: 1, 2: 4}, 10) in ([(7, 1), (3, 1)],)
    assert sum(n * k for n, k in packing.fullest({6: 3, 4: 1, 5: 1}, 10)) == 10


def test_tokens_equal_the_library():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    r = random.Random(2)
    pieces = ["The", "THE,", "don't", "Été", " ", "\n", "\x1c", "\x01", " ", " ", "á", "İ", "ΣΣ", "123", "<|endoftext|>", "\U0001f600", "中文", "x" * 50, "\x85", "́", "'s"]
    for _ in range(300):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 12)))
        want = np.asarray(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert packing.token_bytes(path, text) == want, repr(text)


def test_forward_backward_sums_over_all_labellings():
    import itertools

    r = np.random.default_rng(0)
    e, moves = r.normal(size=(5, 3)), r.normal(size=(3, 3))
    p, _, _ = language.forward_backward(e.astype(np.float32), moves, np.array([0, 3, 5]))
    for a, z in ((0, 3), (3, 5)):
        want = np.zeros((z - a, 3))
        for y in itertools.product(range(3), repeat=z - a):
            w = np.exp(sum(e[a + i, c] for i, c in enumerate(y)) + sum(moves[i, j] for i, j in zip(y, y[1:])))
            for i, c in enumerate(y):
                want[i, c] += w
        assert np.allclose(p[a:z], want / want.sum(1, keepdims=True), atol=1e-4)


def test_code_switched_words_are_told_apart():
    en = "the quick brown fox jumps over the lazy dog and then runs away with this thing".split()
    de = "der schnelle braune fuchs springt ueber den faulen hund und rennt dann nicht weg".split()
    r = random.Random(4)
    texts = [" ".join(r.choice(w) for _ in range(60)) for w in (en, de) for _ in range(12)]
    m = language.fit(texts, ["en"] * 12 + ["de"] * 12)
    raw = " ".join(en[:6] + de[:6]).encode()
    t = language.Tokens(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))
    p, _, _ = language.forward_backward(language.emissions(m.weights, *t.features()), m.moves, t.first)
    assert [m.labels[k] for k in p.argmax(1)] == ["en"] * 6 + ["de"] * 6


@pytest.mark.parametrize("size", [1, 7, 64, 500, 100_000])
def test_long_texts_in_pieces_are_as_in_one(size):
    r = random.Random(6)
    en, de = "the quick brown fox jumps over this dog".split(), "der schnelle braune fuchs springt nicht weg".split()
    m = language.fit([" ".join(r.choice(w) for _ in range(60)) for w in (en, de) for _ in range(6)], ["en"] * 6 + ["de"] * 6)
    text = "  ".join(" ".join(r.choice(w) for _ in range(r.randint(3, 30))) for w in (en, de, en, ["wort" * 40], de))
    b = np.frombuffer(text.encode(), np.uint8)
    t = language.Tokens(np.array([0, len(b)]), b)
    p, _, _ = language.forward_backward(language.emissions(m.weights, *t.features()), m.moves, t.first)
    best = p.argmax(1)
    sums, words, runs = language.long_text(b, m, size)
    assert words == len(p) and runs == 1 + int((best[1:] != best[:-1]).sum())
    assert np.allclose(sums, p.sum(0, dtype=np.float64), rtol=1e-3, atol=1e-3)


def test_many_languages_are_all_learned():
    r = random.Random(9)
    langs = [f"l{i}" for i in range(40)]
    own = {x: ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(8)] for x in langs}
    m = language.fit([" ".join(r.choice(own[x]) for _ in range(60)) for x in langs], langs)
    assert m.labels == tuple(sorted(langs)) and m.weights.size <= language.MOST_WEIGHTS
    for x in langs:
        raw = " ".join(own[x]).encode()
        t = language.Tokens(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))
        p, _, _ = language.forward_backward(language.emissions(m.weights, *t.features()), m.moves, t.first)
        assert m.labels[int(p.sum(0).argmax())] == x


@pytest.mark.parametrize("bad", ["<![foo[x]]>", "<![x>", "<![ x ]>", "<![>", "<![1]>", "<![endif]>", "<![CDATA[x]]>"])
def test_text_after_a_malformed_section(bad):
    assert html.extract_text(f"<p>one {bad} two</p>{bad}<p>three</p>").replace("  ", " ").split("\n") == ["one two", "three"]


LONG = "This is a sentence of the main text that goes on for quite a while, as those of articles do. " * 4


def test_teaser_cards_do_not_replace_the_main_text():
    page = "".join(f"<article><p>Teaser {i} with some words to read about it</p></article>" for i in range(3))
    got = html.extract_text(f"<body><div id=content>{''.join(f'<p>{i} {LONG}</p>' for i in range(6))}</div><div>{page}</div></body>")
    assert all(f"{i} {LONG.strip()}" in got.split("\n") for i in range(6))


def test_short_parts_and_siblings_stay():
    parts = [6, 1, 1]
    for tag in ("article", "div"):
        page = "".join(f"<{tag}>{''.join(f'<p>{k} {i} {LONG}</p>' for i in range(n))}</{tag}>" for k, n in enumerate(parts))
        got = html.extract_text(f"<body>{page}</body>").split("\n")
        assert got == [f"{k} {i} {LONG.strip()}" for k, n in enumerate(parts) for i in range(n)]
    page = f"<div>{''.join(f'<p>{i} {LONG}</p>' for i in range(9))}</div><div><p>last {LONG}</p></div>"
    assert f"last {LONG.strip()}" in html.extract_text(f"<body>{page}</body>").split("\n")


@pytest.mark.parametrize("name", ["site has-sidebar", "content-with-sidebar", "no-sidebar", "layout with-header", "main-content no-comments", "two-col side-by-side", "page sidebar"])
def test_names_of_wrappers_do_not_skip_the_page(name):
    text = [f"{i} {LONG.strip()}" for i in range(4)]
    inner = "".join(f"<p>{x}</p>" for x in text)
    for body in (f"<article>{inner}</article>", f"<div>{inner}</div>"):
        got = html.extract_text(f"<body><div class='{name}'>{body}<div class=sidebar><p>{LONG}</p></div></div></body>")
        assert got.split("\n") == text


def _article(inside):
    return html.extract_text(f"<body><nav><a href=/>Menu</a></nav><article><h1>Head</h1><p>{LONG}</p>{inside}<p>Last {LONG}</p></article><footer>Foot</footer></body>").split("\n")


WHOLE = ["Head", LONG.strip(), f"Last {LONG.strip()}"]


@pytest.mark.parametrize(
    "part",
    [
        f"<article class=comment><p>{LONG}</p></article>", f"<article class='advert'><p>{LONG}</p></article>", f"<section id=comments><article><p>{LONG}</p></article></section>", f"<div class='ad-slot ad-300x250'>{LONG}</div>",
        f"<div class=relatedPosts><p>{LONG}</p></div>", "<div role=navigation><a>x</a></div>", f"<div class=newsletter-signup><p>{LONG}</p></div>", "<div class=notice>See <a>this</a></div>", f"<p hidden>{LONG}</p>",
        "<span style='display: none'>gone</span>", "<aside><p>aside</p></aside>", f"<div aria-label='Post comments'>{LONG}</div>",
    ],
)
def test_boilerplate_inside_an_article_goes(part):
    assert _article(part) == WHOLE


@pytest.mark.parametrize("name", ["side-effects", "social-science", "search-results-analysis", "share-price", "commentary", "related-work", "menu-prices-study", "no-ads", "has-comments"])
def test_names_that_merely_hold_such_a_word_stay(name):
    assert _article(f"<div class='{name}'><p>Short.</p><p>In {LONG}</p></div>") == [*WHOLE[:2], "Short.", f"In {LONG.strip()}", WHOLE[2]]


def test_ambiguous_names_follow_the_ratios():
    assert _article(f"<section class=notice><p>In {LONG}</p></section>") == [*WHOLE[:2], f"In {LONG.strip()}", WHOLE[2]]


def test_headers():
    page = f"<header><h2>Site</h2><p>{LONG}</p></header><article><header><h1>Own headline</h1></header><p>{LONG}</p><footer>tags</footer></article>"
    assert html.extract_text(page).split("\n") == ["Own headline", LONG.strip()]


def test_articles_among_comments():
    page = f"<main><p>{LONG}</p></main><div class=comments>{f'<article><p>comment {LONG}</p></article>' * 5}</div>"
    assert html.extract_text(page) == LONG.strip()
    assert html.extract_text(f"<div class='page sidebar'><article><p>{LONG}</p></article></div>") == LONG.strip()
    assert html.extract_text(f"<div class=comments><p>only {LONG}</p></div>") == f"only {LONG.strip()}"


@pytest.mark.parametrize("unit", ["<div>", "<div>x", "<b><p>", "<article>x", "<li><i>", "<table><td>x", "<span class=ad>x</b>"])
def test_time_follows_the_length_of_a_page(unit):
    import time

    took = []
    for n in (4000, 16000):
        best = 9.0
        for _ in range(3):
            began = time.process_time()
            html.extract_text(unit * n)
            best = min(best, time.process_time() - began)
        took.append(best)
    assert took[1] < 9 * took[0] + 0.05


def _plain_extract(page):
    """The main text of pages of one simple layout, by cutting the article out of the markup."""
    import html as std

    body = page[page.index("<article>") + 9 : page.index("</article>")]
    parts = re.split(r"</?(?:p|h1)>", body)
    return "\n".join(x for x in (re.sub(r"\s+", " ", std.unescape(re.sub(r"</?b>", "", p.replace("<br>", " ")))).strip() for p in parts) if x)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_pages_of_the_tables(sf):
    import pyarrow.parquet as pq

    path = Path(f"/root/testdata/{sf}/pages.parquet")
    if not path.is_file():
        pytest.skip("no test tables")
    pages = [x for x in pq.read_table(path, columns=["html"]).column(0).to_pylist() if x and re.search(r"<article>.*</article>", x, re.S)]
    assert pages
    for page in pages:
        assert html.extract_text(page) == _plain_extract(page)
