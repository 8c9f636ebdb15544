"""The chain against enumeration of all labellings; blocks of unusual markup; training bounds."""

import itertools
import time

import numpy as np
import pytest

from sluice.llm import htmlcrf
from sluice.llm.htmlcrf import Chain, Likelihood, extract, features, leaf_blocks, train, train_chain


def texts(page):
    return [b.text for b in leaf_blocks(page)]


@pytest.mark.parametrize("page,want", [
    ("<p>a</p><!--><p>b</p><p>c</p>", ["a", "b", "c"]),
    ("<p>a</p><!---><p>b</p><!-- x --><p>c</p>", ["a", "b", "c"]),
    ("<p>a</p><!-- x --!><p>b</p><!-- y -- > --><p>c</p>", ["a", "b", "c"]),
    ("<p>a</p><!----><p>b</p><!-- <!-- --><p>c</p>", ["a", "b", "c"]),
    ("<p>a</p><!-- never ends <p>b</p>", ["a"]),
    ("<p>a</p></ ignored><p>b</p></><p>c</p>", ["a", "b", "c"]),
    ("<div><p>a</p><select><option>o</div><p>b</p><p>c</p>", ["a", "o", "b", "c"]),
    ("<p>a</p><select><option>o<p>b</p><p>c</p>", ["a", "o", "b", "c"]),
    ("<body><p>a</p><noscript><p>b</p></body>", ["a", "b"]),
    ("<p>a</p><select><option>o</select><p>b</p>", ["a", "b"]),
    ("<div><p>a</p><object><div>in</div><p>x</p></object><p>b</p></div>", ["a", "b"]),
    ("<div>a<canvas>x<canvas>y</canvas>z</canvas>b</div>", ["ab"]),
    ("<div>a<template><p>b</p></div><div>c<template>x</template>d</div>", ["a", "b", "cd"]),
    ("<p>a</p><textarea>b<p>c</p>", ["a b", "c"]),
    ("<title>t<p>b</p>", ["t", "b"]),
    ("<p>a</p><script>if (a<b) x='<p>no</p>'", ["a"]),
    ("<div>a<select><canvas><object>b</div><p>c</p>", ["a", "b", "c"]),
    ("<head><title>t</title><body><p>a</p>", ["a"]),
])
def test_nothing_is_lost_behind_unusual_markup(page, want):
    assert [t for x in texts(page) for t in x.split()] == [t for x in want for t in x.split()]


def test_elements_that_never_end_take_linear_time():
    page = "<div>" + "<p>x</p><select><option>a</option><canvas><object><template><noscript>" * 4000
    t0 = time.perf_counter()
    assert len(texts(page)) >= 8000
    assert time.perf_counter() - t0 < 20


def chain(seed, slots=12):
    rng = np.random.default_rng(seed)
    return Chain(rng.normal(size=(slots, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))


def score(c, feats, ys):
    s = c.scores(feats)
    return c.first[ys[0]] + sum(s[t, y] for t, y in enumerate(ys)) + sum(c.move[a, b] for a, b in zip(ys, ys[1:]))


def pages(seed, n=4):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        size = int(rng.integers(1, 9))
        out.append(([rng.integers(0, 12, int(rng.integers(1, 5))).tolist() for _ in range(size)], rng.integers(0, 2, size).tolist()))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_viterbi_is_the_best_of_all_labellings(seed):
    c = chain(seed)
    for feats, _ in pages(seed, 8):
        best = max(itertools.product((0, 1), repeat=len(feats)), key=lambda ys: score(c, feats, ys))
        assert score(c, feats, c.decode(feats)) == pytest.approx(score(c, feats, best))
    assert c.decode([]) == []


@pytest.mark.parametrize("seed", range(4))
def test_likelihood_and_gradient_by_enumeration(seed):
    c, data, l2 = chain(seed), pages(seed), 0.01
    total = sum(len(y) for _, y in data)
    value, grads = Likelihood(data, l2)(c.emit, c.move, c.first)
    want, counts = 0.0, [np.zeros((12, 2)), np.zeros((2, 2)), np.zeros(2)]
    for feats, gold in data:
        every = list(itertools.product((0, 1), repeat=len(feats)))
        w = np.array([score(c, feats, ys) for ys in every])
        z = np.log(np.exp(w).sum())
        want += z - score(c, feats, gold)
        for ys, p in [*zip(every, np.exp(w - z)), (gold, -1.0)]:
            counts[2][ys[0]] += p
            for f, y in zip(feats, ys):
                np.add.at(counts[0][:, y], f, p)
            for a, b in zip(ys, ys[1:]):
                counts[1][a, b] += p
    theta = [c.emit, c.move, c.first]
    assert value == pytest.approx(want / total + l2 / 2 * sum((x * x).sum() for x in theta))
    for g, n, x in zip(grads, counts, theta):
        assert g == pytest.approx(n / total + l2 * x)


def test_gradient_by_finite_differences():
    c, fit = chain(9), Likelihood(pages(9), 0.01)
    _, grads = fit(c.emit, c.move, c.first)
    for x, g in zip((c.emit, c.move, c.first), grads):
        for i in np.ndindex(x.shape):
            x[i] += 1e-5
            up = fit(c.emit, c.move, c.first)[0]
            x[i] -= 2e-5
            down = fit(c.emit, c.move, c.first)[0]
            x[i] += 1e-5
            assert g[i] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_windows_add_up(monkeypatch):
    """A chain in windows is as many chains: their likelihoods add up."""
    c, (feats, ys) = chain(3), ([[i % 12] for i in range(20)], [i // 7 % 2 for i in range(20)])
    monkeypatch.setattr(htmlcrf, "WINDOW", 8)
    got = Likelihood([(feats, ys)], 0.0)(c.emit, c.move, c.first)
    parts = Likelihood([(feats[a:a + 8], ys[a:a + 8]) for a in (0, 8, 16)], 0.0)(c.emit, c.move, c.first)
    assert got[0] == parts[0] and all((a == b).all() for a, b in zip(got[1], parts[1]))


def test_one_long_page_does_not_rule_training(spark):
    rows = [(i, f"<body><nav>menu {i}</nav><article><p>Text {i} is here.</p><p>And here.</p></article></body>") for i in range(60)]
    cells = "".join(f"<td>{i}</td>" for i in range(30_000))
    small = spark.createDataFrame(rows, "page_id long, html string")
    long_ = spark.createDataFrame(rows + [(99, f"<article><table><tr>{cells}</tr></table></article>")], "page_id long, html string")
    train(small)
    t0 = time.perf_counter()
    train(small)
    t1 = time.perf_counter()
    a, b = (train(long_, max_page_bytes=1 << 20).emit for _ in range(2))
    t2 = time.perf_counter()
    assert (t2 - t1) / 2 < (t1 - t0) + 5
    assert (a == b).all()
    assert len(leaf_blocks(long_.where("page_id = 99").first().html)) == 30_000


def test_the_sample_is_the_same_on_every_run(spark):
    rows = [(i % 70, f"<body><div>x{i}</div><article><p>Text {i}.</p></article></body>") for i in range(400)] * 2
    df = spark.createDataFrame(rows, "page_id long, html string")
    a, b = train(df.repartition(7), max_pages=50), train(df.repartition(3), max_pages=50)
    assert (a.emit == b.emit).all()


def test_accuracy_without_marks(spark):
    """Pages whose article, nav, footer and class marks are made plain divs keep their main text."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.select("page_id", "url", "html").collect()

    def bare(page):
        for tag in ("article", "nav", "footer"):
            page = page.replace(f"<{tag}>", "<div>").replace(f"</{tag}>", "</div>")
        return page.replace(' class="ad"', "")
    model = train(pages)
    want = {r.page_id: r.text for r in extract(pages, model).collect()}
    got = {r.page_id: r.text for r in extract(spark.createDataFrame([(r.page_id, r.url, bare(r.html)) for r in rows],
                                                                    "page_id long, url string, html string"), model).collect()}
    truth = {r.page_id: [b.text for b in leaf_blocks(r.html) if "article" in b.path] for r in rows}
    assert all(want[i] == "\n".join(t) for i, t in truth.items())
    kept = sum(len(set(got[i].split("\n")) & set(t)) for i, t in truth.items())
    extra = sum(len(set(got[i].split("\n")) - set(t)) for i, t in truth.items())
    n = sum(len(set(t)) for t in truth.values())
    print(f"without marks: {kept} of {n} main blocks kept, {extra} others")
    assert kept >= 0.98 * n and extra <= 0.02 * n


def test_features_hidden_ancestors_differ():
    blocks = leaf_blocks("<article><p class='x'>Hello there.</p></article>")
    assert features(blocks) != features(blocks, hide=True)
    assert train_chain([]).decode([[1], [2]]) == [0, 0]
