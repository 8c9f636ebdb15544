"""Each operator against its plain definition on small frames: nulls, empty and long texts, ties, repeats."""

import random

import pytest
from brute import contaminated, cut_repeats, near_duplicates, quality_counts, sha, shingles
from pyspark.sql import functions as F

from sluice.llm import suffix
from sluice.llm.bpe import Decoder, Encoder, Utf8Machine, byte_bpe, load_ranks
from sluice.llm.chat import link_quotations
from sluice.llm.decontam import MultiIndex, contamination, decontaminated
from sluice.llm.graph import components
from sluice.llm.htmlcrf import extract, leaf_blocks
from sluice.llm.htmlcrf import train as train_crf
from sluice.llm.langid import identify
from sluice.llm.langid import train as train_lang
from sluice.llm.neardup import banding
from sluice.llm.neardup import near_duplicates as near
from sluice.llm.quality import quality_rules
from sluice.llm.tokencount import PreTokens, token_counts
from sluice.llm.toxicity import toxicity

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, id string, `a.b` int"


def vocabulary(name):
    with open(P.path(name), "rb") as f:
        return f.read()


def corpus(seed=1, n=60):
    """(doc_id, text): copies, near copies, shared passages, null, empty, blank, short and long texts."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(k):
        return " ".join(rng.choice(vocab) for _ in range(k)).capitalize() + "."
    passage, base = prose(70), [prose(80) for _ in range(5)]
    texts = [None, "", " \n\t", "One", "one", "Two words", "two\twords", "x" * 700, prose(6000), "é" * 300, "é" * 299]
    texts += [b for b in base for _ in range(3)]
    for b in base:
        for edits in (1, 2, 4, 9):
            w = b.split()
            for _ in range(edits):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w))
    while len(texts) < n:
        texts.append(prose(30) + "\n" + passage + "\n" + prose(rng.randint(1, 60)))
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, "clash", "clash", 7) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- near duplicates -------------------------------------------------------------------

@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, rows, k, percent):
    want = near_duplicates(rows, k, percent)
    got = {r.doc_id: r for r in near(docs, k=k, percent=percent).collect()}
    assert set(got) == set(want)
    for i, (sizes, comp) in want.items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (sizes[0], comp, comp == i)


def test_near_duplicates_blocks(spark, monkeypatch):
    """A bucket split into many blocks gives the same components."""
    import sluice.llm.neardup as m
    monkeypatch.setattr(m, "BLOCK_MEMBERS", 3)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(50):
        w = list(base)
        for _ in range(rng.randint(1, 8)):
            w[rng.randrange(150)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in near(frame(spark, rows), k=3, percent=85).collect()}
    assert got == {i: c for i, (_, c) in near_duplicates(rows, 3, 85).items()}


def test_near_duplicates_null_ids_and_repeats(spark):
    t = "a b c d e f g"
    got = near(frame(spark, [(None, t), (None, t), (5, t), (5, t), (3, t), (9, "q")]), k=3, percent=85).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [
        (-1, -1, True), (-1, -1, True), (3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True)]


def test_near_duplicates_rows_that_share_an_id(spark):
    """Rows of one id are one node: what any of its texts is linked with is reachable."""
    a, b = "a b c d e f g h", "q r s t u v w x"
    got = near(frame(spark, [(3, a), (5, a), (4, b), (5, b), (6, "y z")]), k=3, percent=85).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (4, 3), (5, 3), (5, 3), (6, 6)]


def test_banding():
    assert banding(85) == banding(80) == (24, 5)
    for percent in (1, 5, 10, 30, 50, 60, 70, 90, 100):
        bands, rows = banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 1e-4
    with pytest.raises(ValueError):
        banding(0)


def test_near_duplicates_low_threshold(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        w = [f"t{i}_{j}" for j in range(60)]
        v = w[:33 + i % 12] + [f"u{i}_{j}" for j in range(27 - i % 12)]
        rng.shuffle(v)
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    got = {r.doc_id: r.component_id for r in near(frame(spark, rows), k=1, percent=40).collect()}
    assert got == {i: c for i, (_, c) in near_duplicates(rows, 1, 40).items()}


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 50), (100, 60), (7, 7), (60, 50)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(31)}, 100: 50, 60: 50, 50: 50}


# --- substrings ---------------------------------------------------------------------------

def cut(df, **kw):
    return suffix.repeated_substrings(df, **kw).select("doc_id", "n_bytes", "spans", "kept").collect()


def check_cut(df, rows, length):
    got = {}
    for r in cut(df, length=length, q=min(64, length // 3)):
        got.setdefault(r.doc_id, []).append((r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), bytes(r.kept)))
    want = {}
    for (i, _), x in zip(rows, cut_repeats([t for _, t in rows], length)):
        want.setdefault(i, []).append(x)
    assert got == want


@pytest.mark.parametrize("length", [200, 40])
def test_substrings(docs, rows, length):
    check_cut(docs, rows, length)


def test_substrings_refined_by_spark(spark, monkeypatch):
    """Buckets too large for a task are halved by Spark down to single offsets; segments of long texts overlap."""
    monkeypatch.setattr(suffix, "BUCKET_ROWS", 2)
    monkeypatch.setattr(suffix, "SEGMENT", 500)
    rows = corpus(3, 50)
    check_cut(frame(spark, rows), rows, 100)


def test_substrings_repeated_rows(spark):
    t = "abcdefghij" * 3 + "".join(chr(97 + i % 26) for i in range(0, 700, 7))
    got = cut(frame(spark, [(1, t), (1, t), (None, "z" * 100), (2, None)]), length=50, q=16)
    assert sorted((r.doc_id or 0, len(r.kept)) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 0)]


# --- decontamination ----------------------------------------------------------------------

def test_contamination(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(400)]

    def prose(k):
        return " ".join(rng.choice(vocab) for _ in range(k))
    items = [(i, prose(rng.randint(5, 40))) for i in range(25)] + [(90, "tiny item"), (91, None), (92, ""), (93, "solo")]
    docs = [(0, None), (1, ""), (2, prose(4000)), (3, "A Tiny, ITEM here"), (4, "tiny-item"), (5, "tiny other item")]
    for i, (_, t) in enumerate(items[:25]):
        w = t.split()
        if i % 3 == 1 and len(w) > 20:
            w[len(w) // 2] = "changed"
        if i % 3 == 2:
            w = w[:len(w) // 2]
        docs.append((10 + i, prose(rng.randint(0, 50)) + " " + ", ".join(w).upper() + ". " + prose(rng.randint(0, 50))))
    docs.append((50, items[0][1]))
    want = contaminated(docs, items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, docs)
    for block in (20_000, 7):
        got = {(r.doc_id, r.item_id): r.similarity for r in contamination(df, bench, block=block).collect()}
        assert got == pytest.approx(want)
    clean = decontaminated(df, bench)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert contamination(df, bench.limit(0)).count() == 0 and decontaminated(df, bench.limit(0)).count() == len(docs)


@pytest.mark.parametrize("direct", [True, False])
def test_multi_index_finds_all_within_radius(monkeypatch, direct):
    import numpy as np

    from sluice.llm import decontam
    if not direct:
        monkeypatch.setattr(decontam, "DIRECT_ITEMS", 0)
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 16, (500, decontam.BLOCKS), dtype=np.uint16)
    index = MultiIndex(prints, 63)
    for p in prints[:40]:
        for flips in (63, 62, 30):
            one = p.copy()
            for b in rng.choice(256, flips, replace=False).tolist():
                one[b // 16] ^= np.uint16(1 << b % 16)
            far = np.bitwise_count(prints ^ one).sum(axis=1)
            assert index.search(one).tolist() == np.flatnonzero(far <= 63).tolist()
    with pytest.raises(ValueError):
        MultiIndex(prints, 64)


def test_index_selects_and_misses_next_to_nothing():
    """20,000 items: the share of them that a lookup returns, and recall of windows at the threshold."""
    import numpy as np

    from sluice.llm.common import mix
    from sluice.llm.decontam import simhash, spread
    rng = np.random.default_rng(7)
    m, n = 46, 20_000
    words = mix(rng.integers(0, 2 ** 63, (n, m), dtype=np.uint64))
    prints = np.concatenate([simhash(spread(w.ravel()).reshape(len(w), m, -1).sum(axis=1)) for w in np.array_split(words, 40)])
    index = MultiIndex(prints, 63)
    found, share = 0, []
    for i in range(400):
        window = words[i].copy()
        window[:5] = mix(rng.integers(0, 2 ** 63, 5, dtype=np.uint64))  # similarity 41 / 51 = 0.804
        one = simhash(spread(window).sum(axis=0)[None, :])[0]
        share.append(len(index.candidates(one)) / n)
        found += i in index.search(one)
    print(f"share of items looked at {np.mean(share):.3f}, recall {found / 400:.4f}")
    assert np.mean(share) < 0.2 and found >= 0.99 * 400


def test_decontaminated_in_blocks(spark):
    """A benchmark of several blocks: one job each, any columns pass through, repeated rows each."""
    rng = random.Random(6)
    items = [(i, " ".join(f"i{i}w{j}" for j in range(12))) for i in range(20)]
    docs = [(i % 30, " ".join(f"d{rng.randrange(999)}" for _ in range(20)) + (" " + items[i % 20][1] if i % 3 == 0 else "")) for i in range(60)]
    docs += [(None, None), (None, items[0][1]), (7, ""), (7, "")]
    df, bench = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    one, many = decontaminated(df, bench), decontaminated(df, bench, block=6)
    assert many.columns == df.columns
    assert sorted(map(repr, many.collect())) == sorted(map(repr, one.collect()))
    assert one.count() == 60 - 20 + 3


# --- byte-level BPE -----------------------------------------------------------------------

STRANGE = ["", "  a  b\n\n c", "'s've 12²½ \x1c x y", " " * 300 + "x", "a" * 2000, "ab" * 300, "😀é日本語 中文 👨‍👩", "\x00\x01",
           "a<|endoftext|>b", "naïve coöp ΑΒΓ жук"]


def test_bpe_matches_library(spark):
    import tiktoken
    data = vocabulary("byte_bpe_multi_50k.tiktoken")
    ranks = load_ranks(data)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = STRANGE + [t or "" for _, t in corpus(4)]
    got = {r.doc_id: r for r in byte_bpe(frame(spark, enumerate(texts)), data, piece_ids=5).collect()}
    import numpy as np
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t)
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids
        assert got[i].n_tokens == len(ids) and got[i].decoded == t


def test_transducer_forgets_and_compiles_anew(monkeypatch):
    import sluice.llm.bpe as m
    monkeypatch.setattr(m, "CACHE_STEPS", 50)
    monkeypatch.setattr(m, "CACHE_PIECES", 20)
    data = vocabulary("byte_bpe_multi_50k.tiktoken")
    import tiktoken
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(data), special_tokens={})
    e, text = Encoder(load_ranks(data)), "unforgettable " * 3 + "zxqj kwyjibo antidisestablishmentarianism 12345"
    assert e.ids(text).tolist() == library.encode_ordinary(text)


def test_streaming_decoder():
    ranks = {bytes([i]): i for i in range(256)}
    d = Decoder(ranks)
    text = "aé€😀z"
    assert "".join(d.stream([b] for b in text.encode())) == text
    assert list(d.stream([[0xE2], [0x82], [0xAC]])) == ["€"]
    assert "".join(d.stream([[0xE2, 0x82], [0x41]])) == b"\xe2\x82A".decode("utf-8", "replace")
    m = Utf8Machine()
    for bad in (b"\xc0", b"\xed\xa0", b"\xf5", b"\xe0\x80", b"\x80"):
        assert m.run(0, bad) == 8


# --- token counts -------------------------------------------------------------------------

@pytest.mark.parametrize("hot", [5, 100_000])
def test_token_counts(spark, hot):
    from tokenizers import Tokenizer
    data = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_str(data.decode())
    texts = [None, *STRANGE, *[t for _, t in corpus(6)], "x y z"]
    rows = list(enumerate(texts)) + [(0, "x y z"), (0, "x y z")]
    got = token_counts(frame(spark, rows), data, limit=20, hot=hot).collect()
    want = [(i, len((t or "").encode()), n, n > 20) for i, t in rows
            for n in [len(library.encode(t or "", add_special_tokens=False).ids)]]
    assert sorted(map(tuple, got)) == sorted(want)


def test_pre_tokens_agree_with_library_over_code_points():
    p = PreTokens(vocabulary("byte_bpe_50k.json"))
    for lo in range(0, 0x3000, 7):
        s = f"a{chr(lo)}1 {chr(lo + 3)}b" if not 0xD800 <= lo < 0xE000 else "a"
        assert p.split(s)[0] == [s[a:b] for _, (a, b) in p.slow.pre_tokenize_str(s)]


# --- quality, language, toxicity ------------------------------------------------------------

def test_quality_counts(docs, rows, spark):
    rep = "a b c d e f g h " * 3 + "i"
    extra = [(900, rep), (901, "l one\nl one\n\n \nl two\nl one"), (902, "#* $%& |<> x" * 9)]
    got = {r.doc_id: r for r in quality_rules(docs.union(frame(spark, extra))).collect()}
    for i, t in rows + extra:
        n, chars, symbols, dup, rep = quality_counts(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep), i
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n) and not (r.base_failed and r.kept)


def test_quality_divergence(spark):
    rng = random.Random(1)
    words = ["the", "of", "and", "to", "in"] * 6 + [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100)]
    good = [(i, " ".join(rng.choice(words) for _ in range(120)) + ".") for i in range(60)]
    bad = [(100, "%%% ### 123 $$ " * 3 + " ".join(f"{rng.random():.9f}" for _ in range(90))), (101, "q7 " * 10)]
    got = {r.doc_id: r for r in quality_rules(frame(spark, good + bad)).collect()}
    assert all(got[i].kept for i, _ in good) and not got[100].kept
    assert got[101].word_distance is None and got[101].char_distance is None


def test_language(spark):
    rng = random.Random(3)
    kinds = {"aa": "abcde", "bb": "vwxyz", "cc": "éñüßø"}
    rows = [(i, "".join(rng.choice(kinds[lang] + " ") for _ in range(80)) + kinds[lang][0], lang)
            for i, lang in enumerate(list(kinds) * 60)]
    rows += [(1000, None, "aa"), (1001, "", None), (1002, "123 !?", "bb"), (1003, "ABCDE " * 9, None), (None, "vwxyz", "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = identify(df, train_lang(df)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and all(by[i].lang_pred == lang for i, _, lang in rows[:180])
    assert [by[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 for r in got)
    none = df.where("doc_id < 0")
    assert identify(df, train_lang(none)).where("lang_pred != 'und'").count() == 0 and identify(none, train_lang(df)).count() == 0


def many_languages(spark, n=70):
    rng = random.Random(8)
    rows = []
    for i in range(4 * n):
        own = [f"{chr(97 + i % n % 26)}{chr(97 + i % n // 26)}{x}" for x in "abc"]
        rows.append((i, " ".join(rng.choice(own + ["the", "longer", "words", "2.5"]) for _ in range(30 + i % 50)), f"x{i % n}"))
    rows += [(900, "The long" * 40, None), (901, None, "x1"), (901, "", "x2"), (902, "longwords " * 60, "only long"), (902, "longwords " * 60, "only long")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_quality_of_many_languages(spark, tmp_path):
    import duckdb
    from compare import assert_same

    from sluice.llm.queries import ORACLE_SQL
    df = many_languages(spark)

    def got(**kw):
        return sorted((tuple(-1 if x is None else x for x in r) for r in quality_rules(df, **kw).collect()))
    many, few = got(), got(max_languages=100)
    assert len(many) == len(few) == df.count()
    assert all(a == pytest.approx(b) for a, b in zip(many, few))
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    assert_same(quality_rules(df).drop("char_distance", "word_distance"), con, ORACLE_SQL["op5_quality_rules"])


def test_language_of_many(spark, monkeypatch):
    import sluice.llm.langid as m
    monkeypatch.setattr(m, "TASK_LANGUAGES", 5)
    df = many_languages(spark)
    one = sorted((r.doc_id, r.lang_pred, r.score) for r in identify(df, train_lang(df)).collect())
    blocks = sorted((r.doc_id, r.lang_pred, r.score) for r in identify(df, train_lang(df, max_languages=9)).collect())
    assert [x[:2] for x in blocks] == [x[:2] for x in one] and len(one) == df.count()
    assert [x[2] for x in blocks] == pytest.approx([x[2] for x in one])


def test_toxicity(spark):
    rng = random.Random(4)
    plain = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        w = [rng.choice(plain) for _ in range(40)]
        bad = i % 8 == 0
        if bad:
            w[3], w[20] = rng.choice(["vile", "rotten"]), "rotten"
        rows.append((i, " ".join(w)))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    rows += [(900, None), (901, ""), (901, ""), (None, "vile rotten")]
    labels += [(0, 1, 0), (None, 1, 1), (2, 1, None)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity(frame(spark, rows), lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    right = sum(by[i].predicted == int(i % 8 == 0) for i in range(600) if by[i].held_out)
    assert right >= 0.98 * sum(by[i].held_out for i in range(600))
    assert by[901].predicted == 0
    assert toxicity(frame(spark, rows), lab.limit(0)).where("predicted = 1").count() == 0


# --- pages ----------------------------------------------------------------------------------

def test_leaf_blocks():
    page = ("<!-- <p>no</p> --><html><head><title>t</title><style>p{}</style></head><body><nav><a href='x>y'>Home</a></nav>"
            "<div class=ad>Buy</div><article id=m><h1>A&amp;amp; B</h1><p><b>One\n <i>t</i>wo<br><p>Three<ul><li>x<li>y</ul>"
            "<script>if (a<b) '</p>'</script>tail</article></b><footer>&copy; f")
    got = leaf_blocks(page)
    assert [b.text for b in got] == ["Home", "Buy", "A&amp; B", "One two", "Three", "x", "y", "tail", "© f"]
    assert got[4].path[-1] == "p" and got[4].path.count("p") == 1 and got[0].linked == 4 and got[1].marks == ("ad",)
    assert [b.text for b in leaf_blocks("<head><title>x</title><meta y><body><p title=it's>a</p><p>b")] == ["a", "b"]
    assert leaf_blocks(None) == [] and leaf_blocks("") == [] and leaf_blocks("<p>") == [] and leaf_blocks("a < b")[0].text == "a < b"


@pytest.mark.parametrize("raw", [
    '<script>var s="<!--";</script>', "<script>if (a<b) x(); // don't</script>", "<style>/* <a title=' */</style>",
    "<textarea><!-- <p></textarea>", "<svg><title>a<b '</title><style><!--</style></svg>", "<script>i<n && '</script >"])
def test_raw_text_ends_at_its_end_tag(raw):
    page = f"<html><head>{raw}<title>t</title></head><body><nav>Home</nav>{raw}<article><p>One</p><p>it's</p></article><footer>f</footer><!-- c -->"
    got = leaf_blocks(page)
    assert [b.text for b in got] == ["Home", "One", "it's", "f"]
    assert [b.path[-2:] for b in got[1:]] == [("article", "p"), ("article", "p"), ("body", "footer")]


def test_formulas_are_text():
    page = "<p>Let <math><mi>x</mi><mo>&gt;</mo><semantics><mn>2</mn><annotation>x>2</annotation></semantics></math> hold.</p><p>So"
    assert [b.text for b in leaf_blocks(page)] == ["Let x>2 hold.", "So"]


def test_extract(spark):
    s = "This is a sentence of the article that goes on for a while, and then it ends."
    side = '<nav><ul><li><a href="/">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
    rows = [(i, f"u{i}", f"<html><body>{side}<div class='ad'>Buy now!</div><article><h1>Title {i}</h1>" + f"<p>{s}</p>" * (i % 5 + 1)
             + "</article><div class='comments'><p>I like this very much.</p></div><footer>&copy; site</footer></body></html>")
            for i in range(40)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", side), (None, "u", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r.page_id: r.text for r in extract(df, train_crf(df)).collect()}
    for i in range(40):
        assert got[i] == "\n".join([f"Title {i}"] + [s] * (i % 5 + 1))
    assert got[100] == got[101] == got[102] == "" and got[None] == got[0]


# --- conversations ----------------------------------------------------------------------------

def test_quotations(spark):
    rows = [(1, 0, "user", "Hello there.\nHow are  you?\n\nSecond para line."),
            (1, 1, "assistant", "> hello there.\n> How are you?\nI am fine."),
            (1, 2, "user", "> > Hello there.\n> I am fine.\nGood.\n\n> How are you?\nMore"),
            (1, 3, "user", "> no such line\nreply"), (1, 4, "user", ">> Second para line.\r\nagain\r\n"),
            (1, 4, "user", "> Good.\ndup"), (2, 0, "user", None), (2, 1, "user", "> Hello there.\nx"),
            (None, 1, "user", "> a"), (3, None, "x", "y"), (4, 0, "user", "> later\na"), (4, 1, "user", "later")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("own", F.lit(1))
    got = sorted(((r.conv_id or 0, r.position, r.turn, r.parent_turn, r.root_turn, r.depth, r.n_quotes, r.text)
                  for r in link_quotations(df).collect()), key=lambda x: x[:2])
    assert got == [
        (0, 1, 1, None, 1, 0, 1, ""),
        (1, 1, 0, None, 0, 0, 0, rows[0][3]), (1, 2, 1, 0, 0, 1, 1, "I am fine."),
        (1, 3, 2, 1, 0, 2, 3, "Good.\n\nMore"), (1, 4, 4, 2, 0, 3, 1, "again"), (1, 5, 4, 2, 0, 3, 1, "dup"),
        (1, 6, 3, None, 3, 0, 1, "reply"),
        (2, 1, 0, None, 0, 0, 0, ""), (2, 2, 1, None, 1, 0, 1, "x"), (3, 1, None, None, None, 0, 0, "y"),
        (4, 1, 0, None, 0, 0, 1, "a"), (4, 2, 1, None, 1, 0, 0, "later")]


def test_quotation_of_some_paragraphs(spark):
    rows = [(1, 0, "user", "First one\nin two lines.\n\nSecond one, also\nin two lines.\n\nThird."), (1, 1, "user", "Other."),
            (1, 2, "user", "> First one in\n> two lines.\n>\n> Second one,\n> also in two lines.\nYes.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: (r.parent_turn, r.root_turn, r.position, r.text) for r in link_quotations(df).collect()}
    assert got == {0: (None, 0, 1, rows[0][3]), 2: (0, 0, 2, "Yes."), 1: (None, 1, 3, "Other.")}


def quotations(seed=9):
    """Random conversations of nested, shortened and re-wrapped quotations."""
    rng, rows = random.Random(seed), []
    for conv in range(14):
        texts = []
        for turn in range(9):
            out = []
            for _ in range(rng.randint(1, 4)):
                if texts and rng.random() < 0.6:
                    quoted = rng.choice(texts)
                    how = rng.random()
                    if how < 0.4:  # some of its paragraphs, words wrapped anew
                        some = [p.split() for p in quoted.split("\n\n")][:rng.randint(1, 3)]
                        mark = rng.choice(["> ", ">> "])
                        for i, words in enumerate(some):
                            out += ([mark.strip()] if i else []) + [mark + " ".join(words[j:j + 2]) for j in range(0, len(words), 2)]
                    else:
                        out += [rng.choice(["> ", ">", ">> ", "> > "]) + x.upper() for x in quoted.split("\n")[:rng.randint(1, 5)]]
                out.append(rng.choice(["yes", "no\n\nmaybe", f"line {rng.randint(0, 5)}  here", "", f"one two {conv}\nthree\n\nfour five {turn}"]))
            texts.append("\n".join(out))
            rows.append((conv, turn, rng.choice(["user", None]), texts[-1] if rng.random() < 0.95 else None))
    return rows


def test_quotations_sql(spark, tmp_path):
    """The registered SQL gives the same threads and sources."""
    import duckdb
    from compare import assert_same

    from sluice.llm.queries import ORACLE_SQL
    df = spark.createDataFrame(quotations(), "conv_id long, turn long, role string, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c/*.parquet')")
    assert_same(link_quotations(df), con, ORACLE_SQL["op4_chat_formatting"])


def test_quotations_brute_force(spark):
    """Own texts, the source of every passage and the threads, read line by line."""
    import re

    def norm(t):
        return re.sub(r"\s+", " ", t.lower()).strip(" ")

    def parts(t):
        return [[t], re.split(r"\n[ \t]*\n", t), t.split("\n")]
    rows, want = quotations(4), {}
    own, passages = {}, {}
    for conv, turn, _, text in rows:
        mine, runs = [], []
        for line in (text or "").split("\n"):
            marks = re.match(r"[ \t]*(?:>[ \t]*)+", line)
            level, body = (marks.group().count(">"), line[marks.end():]) if marks else (0, line)
            if runs and runs[-1][0] == level:
                runs[-1][1].append(body)
            else:
                runs.append((level, [body]))
        mine = "\n".join("\n".join(b) for n, b in runs if n == 0)
        quoting = any(n for n, _ in runs)
        own[conv, turn] = mine.strip() if quoting else text or ""
        passages[conv, turn] = [(n, "\n".join(b)) for n, b in runs if n]
    parent = {}
    for (conv, turn), found in passages.items():
        sources = []
        for at, (level, text) in enumerate(found):
            best = None
            for rank, some in enumerate(parts(text)):
                keys = {norm(x) for x in some} - {""}
                hits = [t for (c, t), o in own.items() if c == conv and t < turn
                        and keys & {norm(x) for group in parts(o) for x in group}]
                if hits:
                    best = (level, at, rank, -max(hits))
                    break
            sources.append(best)
        known = [b for b in sources if b]
        parent[conv, turn] = -min(known)[3] if known else None
        want[conv, turn] = ",".join("-" if b is None else str(-b[3]) for b in sources)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r for r in link_quotations(df).collect()}
    assert any("," in w and "-" not in w for w in want.values())
    for key, r in got.items():
        assert (r.sources, r.parent_turn, r.text, r.n_quotes) == (want[key], parent[key], own[key], len(passages[key])), key
        root, depth = key[1], 0
        while parent[key[0], root] is not None:
            root, depth = parent[key[0], root], depth + 1
        assert (r.root_turn, r.depth) == (root, depth)


def test_runs_of_many_lines_take_linear_time(spark):
    import time
    took = []
    for n in (4000, 16000):
        text = "\n".join("> q" if i % 2 else "own" for i in range(n))
        df = spark.createDataFrame([(1, 1, "u", text)], "conv_id long, turn long, role string, text string")
        link_quotations(df.limit(0)).collect()
        t0 = time.perf_counter()
        from sluice.llm.chat import parse
        rows = parse(df.withColumnsRenamed({"conv_id": "conv"}))
        assert rows.select(F.size("passages")).first()[0] == n // 2
        took.append(time.perf_counter() - t0)
    assert took[1] < 8 * took[0] + 2


# --- empty tables -------------------------------------------------------------------------------

def test_empty_tables(spark):
    docs = empty(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert near(docs).count() == 0 and suffix.repeated_substrings(docs).count() == 0
    assert byte_bpe(docs, vocabulary("byte_bpe_multi_50k.tiktoken")).count() == 0
    assert token_counts(docs, vocabulary("byte_bpe_50k.json")).count() == 0
    assert quality_rules(docs).count() == 0 and toxicity(docs, labels).count() == 0
    assert identify(docs, train_lang(docs)).count() == 0
    assert contamination(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(pages, train_crf(pages)).count() == 0
    assert link_quotations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_shingles_helper():
    assert shingles("A b", 3) == {("a", "b")} and sha(b"")[:4] == "e3b0"
