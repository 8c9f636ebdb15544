"""Spelling variants against all pairs; the signatures against all edits."""

import random
import re
import zlib
from collections import Counter

import pytest

from sluice.llm import variants
from sluice.llm.queries import op12_spelling_variants
from sluice.llm.variants import near_pairs, signatures, spelling_variants

SCHEMA = "doc_id long, text string, word string, n string, `a.b` int"


def words_of(docs, min_length, min_count, every):
    total = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if n >= min_count and len(w) >= min_length}


def edits(w, letters):
    for i in range(len(w) + 1):
        yield from (w[:i] + c + w[i:] for c in letters)
        if i < len(w):
            yield w[:i] + w[i + 1:]
            yield from (w[:i] + c + w[i + 1:] for c in letters)


def brute(words, ratio):
    letters, out = sorted(set("".join(words))), {}
    for w, n in words.items():
        near = {e for e in edits(w, letters) if e in words and e != w}
        best = min(near, key=lambda e: (-words[e], e), default=None)
        out[w] = (best if best is not None and words[best] >= ratio * n else None, n, len(near))
    rows = {}
    for w, (form, n, k) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows[w] = (form, root, n, k, None if form is None else words[form])
    return rows


def got(df):
    rows = [(r.word, (r.form, r.root, r.n, r.n_near, r.form_n)) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def corpus(seed=3):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abeénÿ×") for _ in range(rng.randint(3, 9))) for _ in range(60)]
    docs = [(None, None), (None, "Hello hello HELLO"), (1, ""), (1, "x" * 400 + " " + "x" * 399 + " " + "x" * 399)]
    for i in range(120):
        ws = []
        for _ in range(rng.randint(5, 60)):
            w = rng.choice(stems[:1 + int(len(stems) * rng.random() ** 2)])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w) + 1)
                w = rng.choice([w[:k] + rng.choice("abeé") + w[k:], w[:k] + w[k + 1:], w[:k] + "n" + w[k + 1:]]) or "a"
            ws.append(w.capitalize() if rng.random() < 0.3 else w)
        docs.append((i % 90, " ".join(ws) + rng.choice(["", "日本 Œuvre", "\x00\n-a"])))
    return docs


@pytest.fixture(scope="module")
def docs():
    return corpus()


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "clash", "clash", 7) for i, t in docs], SCHEMA)


@pytest.mark.parametrize("kw", [dict(min_length=5, min_count=3, drop_every=97), dict(min_length=1, min_count=1, parts=3, drop_every=3),
                                dict(min_length=3, min_count=2, parts=5, ratio=3)])
def test_against_all_edits(spark, docs, kw):
    want = brute(words_of(docs, kw["min_length"], kw["min_count"], kw.get("drop_every")), kw.get("ratio", 2))
    assert got(spelling_variants(frame(spark, docs).repartition(4), **kw)) == want
    assert any(v[0] for v in want.values()) and any(v[3] > 3 for v in want.values())


def test_chains_are_followed_to_their_end(spark):
    counts = {"aaaaa": 3, "aaaaab": 6, "aaaaabb": 12, "aaaaabbb": 24, "aaaaabbbb": 48, "aaaaabbbbb": 96, "aaaaabbbbbb": 191}
    docs = [(1, " ".join(" ".join([w] * n) for w, n in counts.items()))]
    rows = got(spelling_variants(frame(spark, docs)))
    assert rows == brute(counts, 2)
    assert rows["aaaaa"][:2] == ("aaaaab", "aaaaabbbbb")


def test_small_blocks_and_empty_tables(spark, docs, monkeypatch):
    monkeypatch.setattr(variants, "SLICE_BYTES", 20)
    assert got(spelling_variants(frame(spark, docs))) == brute(words_of(docs, 5, 3, None), 2)
    assert spelling_variants(frame(spark, []), drop_every=97).collect() == []
    assert spelling_variants(frame(spark, [(1, None), (2, "- 5")])).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(frame(spark, docs), ratio=1)
    with pytest.raises(ValueError):
        near_pairs(spark.createDataFrame([], "word string, n long"), parts=2)


def test_repeated_ends(spark):
    """The rows of a word are one, whatever tie there is."""
    docs = [(1, "kabel " * 3 + "kabal " * 6 + "kabul " * 6)]
    assert got(spelling_variants(frame(spark, docs))) == {
        "kabel": ("kabal", "kabal", 3, 2, 6), "kabal": (None, "kabal", 6, 2, None), "kabul": (None, "kabul", 6, 2, None)}


@pytest.mark.parametrize("parts", [3, 4, 6])
def test_every_edit_shares_a_signature(parts):
    rng = random.Random(parts)
    for _ in range(60):
        w = "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
        near = sorted(set(edits(w, "abcdeéz")) - {w, ""})
        words = [x.encode("latin-1") for x in [w, *near]]
        held = [{True: set(), False: set()} for _ in words]
        for sig, longer, at in signatures(words, parts, 1):
            for s, i in zip(sig.tolist(), at.tolist()):
                held[i][longer].add(s)
        for i, e in enumerate(near, 1):
            if len(e) == len(w):
                assert held[0][False] & held[i][False], (w, e)
            else:
                a, b = (0, i) if len(e) > len(w) else (i, 0)
                assert held[a][False] & held[b][True], (w, e)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op12_spelling_variants(spark, sf)) == brute(words_of(docs, 5, 3, 97), 2)
