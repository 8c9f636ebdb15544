"""Packing: ids against the tokenizers library, placement against item-by-item best-fit, capacities, defined cases."""

import random
import sys
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm import packing
from sluice.llm.packing import Capacity, TokenIds, best_fit, pack, sequences, token_pieces
from sluice.llm.queries import op11_best_fit_packing, tokenizer_file

pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, length string, offset string, `a.b` int"
ODD = ["", " ", "Don't DON'T it's we'LL", "x²³ 1234 ½", "<|endoftext|>a<|startoftext|> <|ENDOFTEXT|>", "İstanbul ΣΑΣ ŉ ſ ﬁ",
       "é Å ọ̈", "日本語 テキスト 한국어", "a\x1cb\x85c\xa0d", "😀🇩🇪👨‍👩‍👧", "ÀÉÎ ñ Œœ ß ª º µ", "a" * 3000, "!?!'s--''t", " x y",
       "\x00\x01\x7f", "_a_b__c", "١٢٣ ४५", "ﷺ ؀", "Å ậ"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_str(tokenizer_file("word_bpe_49k.json").decode())


@pytest.fixture(scope="module")
def ids():
    return TokenIds(tokenizer_file("word_bpe_49k.json"))


def test_ids_equal_the_library(library, ids):
    rng = random.Random(4)
    pool = [chr(c) for c in range(0x250)] + list("’“”–—…€'s't <|endoftext|> \n\t日é😀́")
    texts = ODD + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    for t in texts:
        assert array("I", ids(t)).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_ids_of_sliced_texts_and_full_caches(library, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_CHARS", 7)
    monkeypatch.setattr(packing, "CACHE_BYTES", 2000)
    small, text = TokenIds(tokenizer_file("word_bpe_49k.json")), " ".join(ODD) + "\n" + "word's and Worte " * 50
    for _ in range(3):
        assert array("I", small(text)).tolist() == library.encode(text, add_special_tokens=False).ids


def test_plain_and_odd_texts_share_one_cache_limit(library, monkeypatch):
    assert packing.CACHE_BYTES <= 96 << 20  # for each worker, beside its executor's heap
    monkeypatch.setattr(packing, "CACHE_BYTES", 400_000)
    rng, most = random.Random(6), 0
    small = TokenIds(tokenizer_file("word_bpe_49k.json"))
    for k in range(400):
        text = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(20))
        text = text if k % 2 else f"語 {text}"  # the character that sends a text past the fast splitter
        assert array("I", small(text)).tolist() == library.encode(text, add_special_tokens=False).ids
        held = [d for c in (small.words, small.pieces) for d in (c, c.old)]
        most = max(most, sum(sys.getsizeof(x) + sys.getsizeof(y) for d in held for x, y in d.items()))
    assert small.words and small.pieces.old
    assert 100_000 < most <= 400_000


def in_column(ids, texts):
    return [array("I", x).tolist() for x in ids.texts(pa.array(texts, pa.string()))]


@pytest.mark.parametrize("size", [64, 4 << 20])
def test_ids_of_a_column_equal_the_library(library, ids, monkeypatch, size):
    monkeypatch.setattr(packing, "TEXT_BYTES", size)
    monkeypatch.setattr(packing, "WORD_ROWS", 50)
    rng = random.Random(8)
    pools = [[chr(c) for c in range(0x180)] + list("’“”–—…€'s't \n\t日é😀\u0301\u0338\u0331") + ["<|endoftext|>"],
             list("aehinostuÀÉßéñ÷×'' ,.1"), list("The cat's ÉTÉ, l'eau HÌ!'s (a1b2)\u0331"), list("ABab <>|=") + ["<|startoftext|>", "<|endof", "text|>"]]
    texts = [None, *ODD, "<|endof", "text|> <|endoftext|>", "", "b" * 70 + " " + "é" * 40, "x" * 64, "É" * 32, "word " * 100, "<|endoftext|> " * 30]
    texts += ["".join(rng.choice(p) for _ in range(rng.randint(0, 60))) for p in pools for _ in range(700)]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert in_column(ids, texts) == want
    assert in_column(ids, []) == [] and in_column(ids, [None, ""]) == [[], []]
    assert [array("I", x).tolist() for x in ids.texts(pa.array(["no", *texts[:40]]).slice(1))] == want[:40]
    monkeypatch.setattr(ids, "merges", None)  # as under another tokenizer
    assert in_column(ids, texts[:60]) == want[:60]


def test_new_words_do_not_ask_the_tokenizer_each(library):
    rng, own = random.Random(11), TokenIds(tokenizer_file("word_bpe_49k.json"))

    class Asked:
        times, model = 0, own.model

        def tokenize(self, word):
            Asked.times += 1
            return Asked.model.tokenize(word)
    own.model = Asked()
    texts = [" ".join("".join(rng.choice(["th", "Er", "ción", "É", "an", "ss", "ß", "q"]) for _ in range(rng.randint(1, 12)))
                      + rng.choice(["", ",", ".", "!?", " 1984"]) for _ in range(50)) for _ in range(200)]
    assert in_column(own, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert Asked.times == 0  # text by text it is asked 7,909 times


def test_a_long_run_without_white_space_is_sliced(library, ids, monkeypatch):
    monkeypatch.setattr(packing, "TEXT_BYTES", 100)
    sizes, block = [], ids._block
    monkeypatch.setattr(ids, "_block", lambda text, at: sizes.append(len(text)) or block(text, at))
    rng = random.Random(5)
    for pool in ("0123456789abcdef", "ab''s.,", "1É's-é9"):
        text = "".join(rng.choice(pool) for _ in range(3000))
        assert in_column(ids, [text]) == [library.encode(text, add_special_tokens=False).ids]
    assert max(sizes) < 300


def test_pairs_of_one_slot():
    letters = [chr(c) for c in range(256)]
    vocab = {c: i for i, c in enumerate(letters)} | {f"{c}$": 256 + i for i, c in enumerate(letters)}
    pairs = [(a, b) for a in "abcd" for b in "abcd"] + [(a, f"{b}$") for a in "abcd" for b in "abcd"]
    vocab |= {a + b: 512 + i for i, (a, b) in enumerate(pairs)}
    merges = packing.Merges({"vocab": vocab, "merges": [f"{a} {b}" for a, b in pairs], "end_of_word_suffix": "$"}, letters)
    a, b = (np.repeat(np.arange(-1, 512), 513).astype(np.int32), np.tile(np.arange(-1, 512), 513).astype(np.int32))
    want = {(vocab[x], vocab[y]): i for i, (x, y) in enumerate(pairs)}
    merges._slot = lambda key: np.full(len(key), merges.mask - 1)  # every pair begins at one slot
    merges.keys[:], merges.ranks[:] = -1, merges.NONE
    for k, (x, i) in enumerate(want.items()):
        at = (merges.mask - 1 + k) & merges.mask
        merges.keys[at], merges.ranks[at] = x[0] << 32 | x[1], i
    assert {(x, y): r for x, y, r in zip(a.tolist(), b.tolist(), merges.rank(a, b).tolist()) if r != merges.NONE} == want


def test_another_tokenizer_is_read_by_the_library_alone():
    from tokenizers import Tokenizer
    data = tokenizer_file("byte_bpe_50k.json")
    lib, own = Tokenizer.from_str(data.decode()), None
    try:
        own = TokenIds(data)
    except ValueError:
        return  # refused (post-processing)
    for t in ODD:
        assert array("I", own(t)).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def plainly(lengths, cap, weights):
    """Item by item: the open sequence that fits and leaves the smallest weighted norm (ties: the oldest)."""
    bins = []
    for n in sorted((n for n, c in lengths.items() for _ in range(c)), reverse=True):
        x = np.array([n, 1, n * n])
        fits = [(float(((b - x) / cap) ** 2 @ weights), i) for i, b in enumerate(bins) if (b >= x).all()]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append(cap.copy())
        bins[i] -= x
    return bins


@pytest.mark.parametrize("capacity", [Capacity(100), Capacity(100, 4), Capacity(100, 50, 3600), Capacity(100, 5, 5000)])
@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_by_classes(capacity, score):
    rng, cap = random.Random(9), capacity.vector()
    for _ in range(15):
        lengths = {rng.randint(1, 60): rng.randint(1, 40) for _ in range(25)}
        weights = np.array([1.0, 0.5, 0.25])
        segments, n = best_fit(lengths, capacity, score=score, weights=tuple(weights))
        used = defaultdict(lambda: np.zeros(3, np.int64))
        places = defaultdict(list)
        seen = defaultdict(int)
        for length, first, until, each, seq, off in segments.tolist():
            assert first == seen[length]
            seen[length] = until
            for rank in range(first, until):
                s, k = divmod(rank - first, each)
                used[seq + s] += (length, 1, length * length)
                places[seq + s].append((off + k * length, length))
        assert dict(seen) == lengths and len(used) == n
        assert all((u <= cap).all() for u in used.values())
        for p in places.values():
            p.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(p, p[1:])) and p[0][0] == 0
        if score == "norm":
            assert n == len(plainly(lengths, cap, weights))
        tokens = sum(a * b for a, b in lengths.items())
        assert n >= -(-tokens // capacity.tokens)


def test_many_short_items_fill_sequences():
    segments, n = best_fit({1: 100_000, 7: 30_000, 4096: 5}, Capacity())
    assert n == 5 + -(-(100_000 + 210_000) // 4096)
    with pytest.raises(ValueError):
        best_fit({4097: 1})
    with pytest.raises(ValueError):
        best_fit({50: 1}, Capacity(100, 10, 2499))


def check(rows, docs, library, capacity):
    want = {}
    for i, t in docs:
        all_ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.setdefault(i, []).extend((k, s, len(all_ids[s:s + capacity]), zlib.crc32(array("I", all_ids[s:s + capacity]).tobytes()))
                                      for k, s in enumerate(range(0, len(all_ids), capacity)))
    got, at = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        at[r.sequence_id].append((r.offset, r.length))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}
    for v in at.values():
        v.sort()
        assert v[0][0] == 0 and sum(n for _, n in v) <= capacity
        assert all(a + n == b for (a, n), (b, _) in zip(v, v[1:]))
    return len(at), sum(n for v in at.values() for _, n in v)


def test_defined_cases(spark, library):
    docs = [*enumerate(ODD), (None, None), (None, "a b"), (3, "again"), (3, "again"), (7, None), (99, "wort " * 9000)]
    frame = spark.createDataFrame([(i, t, "clash", "clash", 7) for i, t in docs], SCHEMA).repartition(5)
    pieces = token_pieces(frame, tokenizer_file("word_bpe_49k.json"), capacity=64)
    packed = pack(pieces.withColumn("offset", F.lit("old")).withColumn("ids_crc32", F.crc32("ids")), capacity=Capacity(64))
    check(packed.collect(), docs, library, 64)
    for r in sequences(packed).collect():
        assert len(r.ids) == 4 * r.length == 4 * sum(d.length for d in r.documents)
    assert pack(token_pieces(frame.limit(0), tokenizer_file("word_bpe_49k.json"))).collect() == []
    extra = pack(spark.createDataFrame([(None, 1), (5, 2), (0, 3)], "length int, `a.b` int"), capacity=Capacity(5, 2)).collect()
    assert len(extra) == 3 and len({r.sequence_id for r in extra}) == 2
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(70,)], "length int"), capacity=Capacity(64))


def test_only_the_items_are_written(spark, monkeypatch):
    kinds = []
    monkeypatch.setattr(packing, "stage", lambda df, kind, make=packing.stage: kinds.append(kind) or make(df, kind))
    items = spark.range(300).selectExpr("id", "id % 7 AS length").repartition(4)
    rows = pack(items, capacity=Capacity(12)).collect()
    assert kinds == ["pack-items"]
    assert sorted(r.id for r in rows) == list(range(300))
    assert len({(r.sequence_id, r.offset) for r in rows if r.length}) == sum(1 for r in rows if r.length)


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n, tokens = check(op11_best_fit_packing(spark, sf).collect(), docs, library, 4096)
    assert n <= -(-tokens // 4096) + 1
