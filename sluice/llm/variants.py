"""Spelling variants: words that differ by one code point, each linked to its most frequent near form.

Words are runs of Latin letters (A-Z lowered). Two words are near if exactly one inserted, deleted
or replaced code point separates them. A near pair is found by PartEnum signatures:

1. A word's letters are a multiset, seen as a binary vector over (letter, occurrence). One edit
   changes one or two of its components, so near words are at a Hamming distance of at most 2.
2. The components are partitioned into `parts`, and each way to leave two parts out is enumerated.
   Vectors that differ in two components agree on some enumeration, so its content is an exact
   signature. One edit also leaves one half of the positions untouched: the signature is joined
   with the letters of that half, once for each half, and with the length class.
3. Words of equal signatures are joined (Spark's sort-merge join, whose hot signatures the adaptive
   planner splits) and verified by edit distance in the join itself; only near pairs leave it.

In class m are the words of m letters and, as the longer side, those of m + 1; the untouched half is
the first m // 2 letters or the last m - m // 2. Signatures are 64-bit hashes: equal ones are
candidates only.

The forms are followed to their ends by pointer doubling; counts grow at least by `ratio` with each
step, so chains are as long as the logarithm of the largest count, and rounds the logarithm of that.

Defined cases: null text has no words; a null id counts as the text ''; repeated rows count each;
extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _power, done, mix, pick, salts, stage, worker_state

_U = np.uint64
#: Distinct words that a task holds before it hands them on.
TASK_WORDS = 400_000
#: Bytes of one text that are split at a time; cuts are made between runs.
SLICE_BYTES = 1 << 22
#: Letters of Latin-1 (one byte each there): A-Z lowered, a-z and U+00C0 to U+00FF kept, others separate.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> Iterator[list[bytes]]:
    """Lower-cased runs of letters of a text in lists of bounded size, as Latin-1 bytes."""
    raw = text.encode("latin-1", "replace").translate(_LETTERS)  # one byte for each code point
    a = 0
    while a < len(raw):
        b = raw.find(b" ", a + SLICE_BYTES) if len(raw) - a > SLICE_BYTES else -1
        b = len(raw) if b < 0 else b
        yield raw[a:b].split()
        a = b


def _counter(min_length: int, drop_every: int | None):
    def run(batches):
        worker_state("variants")
        total: dict[bytes, int] = {}

        def out():
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            got = pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return got
        get = total.get
        for batch in batches:
            for i in range(batch.num_rows):
                key = zlib.crc32(((batch.column("id")[i].as_py() or "") + ":").encode())
                for words in runs(batch.column("text")[i].as_py() or ""):
                    for w, n in Counter([w for w in words if len(w) >= min_length]).items():
                        if drop_every:
                            h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), key)
                            if not h % drop_every:
                                at = h % len(w)
                                w = w[:at] + w[at + 1:]
                                if len(w) < min_length:
                                    continue
                        total[w] = get(w, 0) + n
                    if len(total) > TASK_WORDS:
                        yield out()
        if total:
            yield out()
    return run


def word_counts(docs: DataFrame, *, min_length: int = 5, min_count: int = 3, drop_every: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: words of at least min_length letters that occur at least min_count times.

    drop_every: plants misspellings: a run whose CRC-32 h of `<id>:<run>` is divisible by it loses its
    letter h % length."""
    texts = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("string").alias("id"), "text")
    return (texts.mapInArrow(_counter(min_length, drop_every), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def signatures(words: list[bytes], parts: int, min_length: int) -> Iterator[tuple[np.ndarray, bool, np.ndarray]]:
    """(signature, whether as the longer side, word index) arrays of words given as Latin-1 bytes."""
    size = np.array([len(w) for w in words], np.int64)
    stop = np.cumsum(size)
    start = stop - size
    flat = np.frombuffer(b"".join(words), np.uint8)
    owner = np.repeat(np.arange(len(words)), size)
    with np.errstate(over="ignore"):
        # components: letters in order within each word, numbered among equals
        letter = np.sort(owner.astype(np.int64) * 256 + flat)
        new = np.ones(len(letter), bool)
        new[1:] = letter[1:] != letter[:-1]
        nth = np.arange(len(letter)) - np.maximum.accumulate(np.where(new, np.arange(len(letter)), 0))
        letter &= 255
        value, part = mix((letter * 65536 + nth + 1).astype(_U)), (letter + 7 * nth) % parts
        content = [mix(np.add.reduceat(np.where(part == k, value, _U(0)), start) + c) for k, c in enumerate(salts(parts, 51))]
        left_out = [sum((c for k, c in enumerate(content) if k not in out), np.zeros(len(words), _U)) + _U(i)
                    for i, out in enumerate(combinations(range(parts), 2))]
        up, down = _power(len(flat) + 1)
        total = np.zeros(len(flat) + 1, _U)
        np.cumsum(salts(256, 52)[flat] * up[:len(flat)], out=total[1:])
        for longer in (False, True):
            m = size - longer
            ok = np.flatnonzero(m >= min_length)
            half = m // 2
            for side, (a, b) in enumerate([(start, start + half), (stop - (m - half), stop)]):
                kept = mix((total[b] - total[a]) * down[a] + m.astype(_U) * _U(2) + _U(side))
                for content_left in left_out:
                    yield mix(kept ^ content_left)[ok], longer, ok


def _signed(parts: int, min_length: int):
    def run(batches):
        worker_state("variants")
        for batch in batches:
            if not batch.num_rows:
                continue
            word, n = batch.column("word"), batch.column("n")
            for sig, longer, at in signatures([w.encode("latin-1") for w in word.to_pylist()], parts, min_length):
                index = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig.view(np.int64)), pa.array(np.full(len(at), longer)), word.take(index), n.take(index)],
                    names=["sig", "longer", "word", "n"])
    return run


def near_pairs(words: DataFrame, *, parts: int = 4, min_length: int = 1) -> DataFrame:
    """u, u_n, v, v_n: every pair of near words of `words` (word, n; distinct words of Latin-1 letters of
    at least min_length), once."""
    if parts < 3:
        raise ValueError("two parts are left out of each signature, so at least 3 are needed")
    signed = stage(words.mapInArrow(_signed(parts, min_length), "sig long, longer boolean, word string, n long"), "signatures")
    a = signed.where("not longer").select("sig", F.col("word").alias("u"), F.col("n").alias("u_n"))
    b = signed.select("sig", "longer", F.col("word").alias("v"), F.col("n").alias("v_n"))
    more = F.char_length(b["v"]) - F.char_length(a["u"])
    order = F.when(b["longer"], more == 1).otherwise((more == 0) & (a["u"] < b["v"]))  # each pair one way round
    near = order & (F.levenshtein(a["u"], b["v"], 1) == 1)
    pairs = a.join(b, (a["sig"] == b["sig"]) & near).select("u", "u_n", "v", "v_n").distinct()
    out = stage(pairs, "near-pairs")
    done(words.sparkSession, signed)
    return out


def _ends(hops: DataFrame) -> DataFrame:
    """word, root: where the hops (word, next) of each word end, for acyclic hops."""
    now = stage(hops, "hops")
    while True:
        far = now.select(F.col("word").alias("next"), F.col("next").alias("far"))
        jumped = stage(now.join(far, "next", "left").select("word", F.coalesce("far", "next").alias("next"),
                                                            F.col("far").isNotNull().alias("moved")), "hops")
        done(hops.sparkSession, now)
        if jumped.where("moved").isEmpty():
            return jumped.select("word", F.col("next").alias("root"))
        now = jumped


def spelling_variants(docs: DataFrame, *, min_length: int = 5, min_count: int = 3, ratio: int = 2, parts: int = 4,
                      drop_every: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word (`word_counts`).

    form: the near word of the largest count (ties: the smallest in code-point order) if that is at
    least ratio times the word's; root: where following forms ends."""
    if ratio < 2:
        raise ValueError("forms must be at least twice as frequent, or following them may not end")
    words = stage(word_counts(docs, min_length=min_length, min_count=min_count, drop_every=drop_every,
                              id_col=id_col, text_col=text_col), "words")
    both = near_pairs(words, parts=parts, min_length=min_length).select(F.explode(F.array(
        F.struct(F.col("u").alias("word"), F.col("v").alias("near"), F.col("v_n").alias("near_n")),
        F.struct(F.col("v").alias("word"), F.col("u").alias("near"), F.col("u_n").alias("near_n")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    near_n = -F.col("best.col1")
    is_form = near_n >= ratio * F.col("n")
    linked = stage(words.join(best, "word", "left").select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, near_n).alias("form_n")), "linked")
    done(docs.sparkSession, words)
    ends = _ends(linked.where("form is not null").select("word", F.col("form").alias("next")))
    return linked.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
