"""Source divergence against its definition in plain integers, with small blocks, shards and sums."""

import random
import re
from collections import Counter, defaultdict

import pytest

from sluice.llm import divergence as m
from sluice.llm.divergence import divergence

SCHEMA = "text string, lang string, source string, term string, `count` int, V string"


def brute(docs, min_docs, top):
    df, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        terms = [re.sub("[A-Z]", lambda c: c.group().lower(), t) for t in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        df[lang].update(set(terms))
        count[lang, source].update(terms)
    rows = []
    for lang, source in sorted(groups):
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        sources = sorted(s for g, s in groups if g == lang)
        v = len(kept)
        held = {s: sum(count[lang, s][t] for t in kept) for s in sources}

        def p(t, s):
            c = count[lang, s][t] if s is not None else sum(count[lang, x][t] for x in sources)
            n = held[s] if s is not None else sum(held.values())
            return 1 + 1_000_000_000 * (c + 2) // (n + 2 * v)

        def f(a, b):
            return (a - b) ** 2 // (a + b)
        pairs = [(s, sum(f(p(t, source), p(t, s)) for t in kept)) for s in sources if s != source]
        own = [(t, f(p(t, source), p(t, None))) for t in kept if count[lang, source][t] and p(t, source) > p(t, None)]
        for part, found, last in (("pair", pairs, None), ("term", own, top)):
            for rank, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))[:last], 1):
                rows.append((lang, source, part, item, value, rank))
    return sorted(rows)


def corpus(seed=1):
    rng = random.Random(seed)
    docs = [(None, None, None), ("A a b_c", None, None), ("", "xx", "s1"), (None, "xx", "s2"), ("5 + 5", "xx", "s3"), ("alone", "yy", "s1")]
    for _ in range(260):
        lang, source = rng.choice(["en", "en", "de", "", "🜁"]), rng.choice(["s0", "s0", "s0", "s1", "é", "z", None])
        pool = ["the", "The", "naïve", "日本", "x" * 300, "a\x00b", "über", "😀"] + [f"w{chr(97 + i)}" for i in range(20)]
        docs.append((rng.choice([" ", "\n", "7"]).join(rng.choices(pool, k=rng.randint(0, 40))), lang, source))
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(*d, "clash", 7, "clash") for d in docs], SCHEMA)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("min_docs,top", [(10, 10), (1, 3), (40, 2)])
def test_against_definition(spark, min_docs, top):
    docs = corpus()
    assert got(divergence(frame(spark, docs).repartition(5), min_docs=min_docs, top=top)) == brute(docs, min_docs, top)


def test_small_blocks(spark, monkeypatch):
    for name, value in dict(BLOCK_TERMS=30, TASK_PAIRS=2, CHUNK_PAIRS=5, SLICE_BYTES=16).items():
        monkeypatch.setattr(m, name, value)
    docs = corpus(2)
    df = divergence(frame(spark, docs).repartition(3), min_docs=3, top=4)
    assert got(df) == brute(docs, 3, 4)


def test_terms_do_not_leave_a_shard_early(spark, monkeypatch):
    """A frequent term whose rows of many runs span Arrow batches is one row."""
    monkeypatch.setattr(m, "BLOCK_TERMS", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        docs = [("the cat", "en", f"s{i % 3}") for i in range(60)]
        assert got(divergence(frame(spark, docs).repartition(4))) == brute(docs, 10, 10)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table(spark):
    assert divergence(frame(spark, [])).collect() == []


def test_shares_are_exact_for_large_counts(spark):
    big = 8_999_999_999_999_999_999
    n, v = big - 7, 3
    got = spark.sql(f"SELECT {m._share('c', 'N')} AS p FROM (SELECT {n - 2}L AS c, {n}L AS N, {v}L AS V)").first().p
    assert got == 1 + 10 ** 9 * n // (n + 2 * v)
