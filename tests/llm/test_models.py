"""The chain CRF against enumeration, and page extraction on pages written by hand."""

import itertools
import math
import random
import time

import numpy as np
import pytest

from quillon.llm import html_text, line_quality, quality_cnn
from quillon.llm.crf import ChainCRF


def weights(crf, x, y):
    """The unnormalised log weight of one labelling."""
    total = crf.first[y[0]] + sum(crf.emit[f, s] for fs, s in zip(x, y) for f in fs)
    return total + sum(crf.move[a, b] for a, b in zip(y, y[1:]))


def likelihood(crf, xs, ys, l2):
    total = 0.0
    for x, y in zip(xs, ys):
        z = np.logaddexp.reduce([weights(crf, x, s) for s in itertools.product((0, 1), repeat=len(x))])
        total += weights(crf, x, y) - z
    return total / sum(map(len, xs)) - l2 / 2 * sum((w**2).sum() for w in (crf.emit, crf.move, crf.first))


def some_crf(seed, n=5):
    r = np.random.default_rng(seed)
    crf = ChainCRF(n)
    crf.emit[:], crf.move[:], crf.first[:] = r.normal(size=(n, 2)), r.normal(size=(2, 2)), r.normal(size=2)
    return crf


def some_sequences(seed, k=4, n=5):
    r = random.Random(seed)
    xs = [[[f for f in range(n) if r.random() < 0.5] for _ in range(r.randint(1, 7))] for _ in range(k)]
    return xs, [[r.randint(0, 1) for _ in x] for x in xs]


@pytest.mark.parametrize("seed", range(20))
def test_viterbi_is_the_best_of_all_labellings(seed):
    crf, (xs, _) = some_crf(seed), some_sequences(seed)
    for x in xs:
        best = max(itertools.product((0, 1), repeat=len(x)), key=lambda y: weights(crf, x, y))
        assert tuple(crf.decode(x)) == best
    assert crf.decode([]) == []


def test_ties_go_to_one():
    assert ChainCRF(1).decode([[0], [0], []]) == [1, 1, 1]


def test_training_climbs_the_exact_likelihood():
    xs, ys = some_sequences(1, k=30)
    crf = ChainCRF(5)
    seen = []
    for epochs in (1, 10, 60, 400):
        crf = ChainCRF(5).fit(xs, ys, epochs=epochs, rate=0.05)
        seen.append(likelihood(crf, xs, ys, 1e-3))
    assert seen == sorted(seen)
    # At the top of the likelihood its slope is nothing in any direction.
    for w in (crf.emit, crf.move, crf.first):
        for at in np.ndindex(w.shape):
            held = w[at]
            w[at] = held + 1e-4
            up = likelihood(crf, xs, ys, 1e-3)
            w[at] = held - 1e-4
            down = likelihood(crf, xs, ys, 1e-3)
            w[at] = held
            assert abs(up - down) / 2e-4 < 2e-3


def test_the_first_step_goes_up_the_slope():
    xs, ys = some_sequences(3, k=10)
    moved = ChainCRF(5).fit(xs, ys, epochs=1, rate=1e-3)
    crf = ChainCRF(5)
    for w, to in ((crf.emit, moved.emit), (crf.move, moved.move), (crf.first, moved.first)):
        for at in np.ndindex(w.shape):
            w[at] = 1e-5
            up = likelihood(crf, xs, ys, 1e-3)
            w[at] = -1e-5
            slope = (up - likelihood(crf, xs, ys, 1e-3)) / 2e-5
            w[at] = 0
            if abs(slope) > 1e-6:
                assert math.copysign(1, slope) == math.copysign(1, to[at])


def test_verdicts_by_enumeration():
    """The share of content, and so the verdict, from the best of all labellings of short texts."""
    crf = line_quality.trained()
    r = random.Random(2)
    kinds = ["This is an ordinary sentence, with some more words in it.", "home | about | contact | login | search", "### $$$ *** %%% &&& ###", "", "BUY NOW!! BUY NOW!! BUY NOW!!", "Short line", "Another sentence follows here, and it is of some length as well."]
    for _ in range(40):
        lines = [r.choice(kinds) + (f" {r.randrange(99)}" if r.random() < 0.3 else "") for _ in range(r.randint(1, 8))]
        text = "\n".join(lines).encode()
        rows, features, _ = line_quality.sequence(text)
        best = max(itertools.product((0, 1), repeat=len(rows)), key=lambda y: weights(crf, features, y))
        sizes = [len("".join(x.split())) for x in lines]
        share = sum(s for s, y in zip(sizes, best) if y) / sum(sizes) if sum(sizes) else 0.0
        *_, failed, content, kept = line_quality.measure(text, crf)
        assert content == share and kept == (not failed and share >= line_quality.CONTENT_SHARE)


#: Pages written by hand, in structures of their own, each with its article's text.
PAGES = [
    (
        """<!doctype html><html><head><title>Harbour news</title><meta name=x content="a > b"></head><body>
        <header class="site-header"><a href="/">Harbour Gazette</a><nav><ul><li><a href=/n>News</a><li><a href=/s>Sport</a></ul></nav></header>
        <main><article><h1>The ferry is back</h1><p class=lead>After a winter of repairs, the ferry between the two islands runs again.</p>
        <p>The company says that it will leave <em>every hour</em>, from six in the morning until ten at night.</p>
        <blockquote><p>&ldquo;We have waited long enough,&rdquo; said a shopkeeper.</p></blockquote></article></main>
        <footer><p>&copy; 2021 Harbour Gazette. All rights reserved.</p><ul><li><a href=/p>Privacy policy</a></ul></footer></body></html>""",
        "The ferry is back After a winter of repairs, the ferry between the two islands runs again. The company says that it will leave every hour, from six in the morning until ten at night. “We have waited long enough,” said a shopkeeper.",
    ),
    (
        """<html><body><div id="navbar"><a href="/">Home</a> | <a href="/recipes">Recipes</a></div>
        <div class="cookie-banner"><p>We use cookies to make this site better.</p><button>Accept</button></div>
        <div class="post-body"><h1>Lentil soup</h1><p>This soup takes half an hour, and most of that is waiting.</p>
        <ul><li>Wash two cups of red lentils.</li><li>Fry an onion, with cumin, until it is soft.</li></ul>
        <p>Serve it with lemon.</p></div>
        <div class="sidebar"><h3>Popular recipes</h3><ul><li><a href=/1>Bean stew</a></li><li><a href=/2>Flat bread</a></li></ul></div>
        <section id="comments"><h3>Comments</h3><div class="comment"><p>I made it yesterday, and it was lovely.</p></div></section>
        <script>document.write("<p>not text</p>")</script></body></html>""",
        "Lentil soup This soup takes half an hour, and most of that is waiting. Wash two cups of red lentils. Fry an onion, with cumin, until it is soft. Serve it with lemon.",
    ),
    (
        """<html><head><meta charset=utf-8><title>Euler</title>
        <article><h2>On a famous identity</h2><p>The identity <math><mi>e</mi><mo>=</mo><mn>0</mn></math> is short, and many people like it.</p>
        <p>It joins five numbers in one line.</p><object data=x.svg>A drawing of the unit circle, with an angle.</object></article>
        <aside class="related"><h3>More</h3><ul><li><a href=/a>Prime numbers</a></ul></aside>""",
        "On a famous identity The identity e=0 is short, and many people like it. It joins five numbers in one line. A drawing of the unit circle, with an angle.",
    ),
    (
        """<html><body><nav class=menu><ul><li><a href=/>Start</a><li><a href=/b>Blog</a><li><a href=/c>Contact</a></ul></nav>
        <script src=x.js /></script>
        <article><h1>Walking in the rain</h1><p>Rain is <b>not</b> bad weather, if you have the right coat.<br>I have walked in it for years.
        <p>In spring the paths are soft, and there is nobody else.</article>
        <form action=/search><label>Search the site</label><input name=q><button>Go</button></form>
        <div class=advertisement><p>Buy our boots, they are the best boots.</p></div>
        <footer>Copyright 2020, the author</footer>""",
        "Walking in the rain Rain is not bad weather, if you have the right coat. I have walked in it for years. In spring the paths are soft, and there is nobody else.",
    ),
]


@pytest.mark.parametrize("n", range(len(PAGES)))
def test_pages_written_by_hand(n):
    page, text = PAGES[n]
    assert html_text.main_text(page, html_text.trained()) == text


def texts(page):
    return [b.text for b in html_text.blocks(page)]


def test_odd_tags():
    assert texts('<p>a <a title="x > y" href=\'>\'>b</a> c<p>d') == ["a b c", "d"]
    assert texts("<p title=\"x>one</p><p>two's</p>") == ["one", "two's"]
    assert texts("1 < 2 <3 and <") == ["1 < 2 <3 and <"]
    assert texts("a <b") == ["a <b"] and texts("a<!-- b <p>c") == ["a"] and texts("a<!x") == ["a"]
    assert texts("<script src=x />var a;</script>b") == ["b"] and texts("a<style>b") == ["a"]
    assert texts("<textarea>a<p>b</textarea><p>c") == ["c"] and texts("<iframe><p>b<iframe>c") == ["b c"]
    assert texts("<svg><text>a</text></svg><audio>b</audio><xmp>c</xmp><canvas>d</canvas>") == ["ab", "c", "d"]
    assert texts("<head><title>t</title><p>a") == ["a"] and texts("<template><p>a</p></template><p>b") == ["b"]
    assert texts("<select><option>a</select>b<button>c</button>d") == ["b", "d"]


@pytest.mark.parametrize("page", ["<a " * 350_000, "<a " * 350_000 + ">", '<a b="' * 150_000 + ">", "<a b='\"" * 150_000 + "\">", "<div>" * 20_000 + "x<p>" * 20_000, "<div>x" * 20_000, "<div>" * 20_000 + "</foo>x" * 20_000, "<i><div>" + "<b>x" * 20_000 + "</i>" * 20_000, "<textarea>x" * 100_000, "<!" * 400_000, "<" * 1_000_000, "<script>" * 100_000, "<p>x<script>" + "</script" * 100_000,  "<b " * 100_000 + 'x="  >  "'], ids=range(14))
def test_pages_are_read_in_linear_time(page):
    began = time.thread_time()
    html_text.blocks(page)
    assert time.thread_time() - began < 8  # a quadratic reading takes minutes


def plain_score(net, text):
    """The network as its docstring has it, a byte and a chunk at a time."""
    x = list(text) + [0] * (quality_cnn.WIDTH - len(text))
    out = np.array([np.concatenate([net.embed[b] for b in x[i : i + quality_cnn.WIDTH]]).astype(np.float64) @ net.filters for i in range(len(x) - quality_cnn.WIDTH + 1)])
    half = quality_cnn.CHUNK // 2
    tops = np.array([out[i : i + 2 * half].max(axis=0) for i in range(0, max(len(out) - half, 1), half)])
    act = np.maximum(tops + net.bias, 0)
    return float(1 / (1 + np.exp(-(np.concatenate((act.mean(axis=0), act.max(axis=0))) @ net.last + net.last_bias[0]))))


def some_net():
    net = quality_cnn.ByteCNN(3)
    r = np.random.default_rng(4)
    net.last[:], net.bias[:], net.last_bias[:] = r.normal(size=len(net.last)) / 9, r.normal(size=len(net.bias)), 0.2
    return net


@pytest.mark.parametrize("n", [1, 5, 6, 7, 8, 511, 512, 513, 517, 518, 1000, 1001, 1029, 1030, 2500, 70_001])
def test_scores_against_a_plain_network(n):
    net = some_net()
    text = random.Random(n).randbytes(n)
    assert abs(net.score(text) - plain_score(net, text)) < 1e-4
    changed = [bytes([*text[:-1], b]) for b in range(256)]
    if n <= 1001:
        assert len({net.score(t) for t in changed}) > 1  # the last byte is read
    tops, places = net.pooled(text)
    assert np.allclose(tops, net.pooled(text, where=False)[0]) and places.max() <= max(n - quality_cnn.WIDTH, 0)


def test_gradients_by_differences():
    net = some_net()
    text, label = random.Random(1).randbytes(1700), 1
    loss = lambda: -math.log(net.score(text))
    for p, g in zip(net.params(), net.grads(text, label)):
        flat = np.abs(g).ravel()
        for i in np.argsort(-flat)[:5]:
            at = np.unravel_index(i, p.shape)
            held = p[at]
            p[at] = held + 1e-3
            up = loss()
            p[at] = held - 1e-3
            down = loss()
            p[at] = held
            assert abs((up - down) / 2e-3 - g[at]) < 0.05 * abs(g[at]) + 2e-3
