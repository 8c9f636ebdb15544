"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams (1 to 3 code points, lower-cased by a fixed table of the basic
plane, white space runs kept) of every training text by language, over all rows: each task
adds up its own counts and hands on one row per language and occupied bin, and Spark sums
them. The matrix of log-probabilities has 2**BITS rows and a column for each language, so its
size is fixed by the number of languages; it is broadcast, `max_languages` columns at a time. Of more
languages the texts are written once with a row number, every block of columns scores them, and a
row's best language and the sum of its likelihoods are put together from the blocks. Scoring gathers, in numpy, the
rows of the matrix that a batch's n-grams occupy and sums them by document (a sparse product).

Language, source and id are not used for a prediction. The score is the posterior probability
of the predicted language under a prior of equal chances, with the log-likelihood averaged to
`effective` n-grams so that long texts do not all score exactly 1.

Defined cases: null text or a text without a letter is 'und' with score 0. With no training
rows every prediction is 'und', score 0. Rows with a null language or id crc32 fold 0 are not
learned from. Repeated rows count each. Extra columns are ignored.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, mix, pick, salts, stage, table_bytes

BITS = 16
#: Languages whose counts a task holds before it hands them on (0.5 MB each).
TASK_LANGUAGES = 128
_U = np.uint64
_tables: dict[str, np.ndarray] = {}


def _plane() -> tuple[np.ndarray, np.ndarray]:
    """(lower case, is a letter) of every code point."""
    if "low" not in _tables:
        low, letter = np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, bool)
        for i in range(0x110000):
            if 0xD800 <= i < 0xE000:
                continue
            ch = chr(i)
            if unicodedata.category(ch)[0] == "L":
                letter[i] = True
                if len(one := ch.lower()) == 1:
                    low[i] = ord(one)
        _tables.update(low=low, letter=letter)
    return _tables["low"], _tables["letter"]


def _grams(texts: list[str | None]):
    """(bins, document of each, has a letter) over the 1-, 2- and 3-grams of the texts."""
    low, letter = _plane()
    raw = [("" if t is None else t).encode("utf-32-le", "surrogatepass") for t in texts]
    size = np.array([len(r) // 4 for r in raw])
    code = np.frombuffer(b"".join(raw), np.uint32)
    doc = np.repeat(np.arange(len(raw)), size)
    has = np.zeros(len(raw), bool)
    has[doc[letter[code]]] = True
    x = low[code].astype(_U)
    c = salts(3, 61)
    bins, docs = [], []
    with np.errstate(over="ignore"):
        acc = np.zeros(len(x), _U)
        for n in range(3):
            acc = acc[:len(x) - n] + x[n:] * c[n] if len(x) > n else acc[:0]
            same = doc[:len(acc)] == doc[n:] if len(acc) else np.zeros(0, bool)
            bins.append((mix(acc[same] + _U(n)) >> _U(64 - BITS)).astype(np.int64))
            docs.append(doc[:len(acc)][same])
    return bins, docs, has


def _parts(column, limit: int = 1 << 18):
    """Slices of a text column of about `limit` bytes, at least a row each."""
    a, total = 0, 0
    texts = column.to_pylist()
    for i, t in enumerate(texts):
        total += len(t or "")
        if total >= limit:
            yield a, texts[a:i + 1]
            a, total = i + 1, 0
    if a < len(texts):
        yield a, texts[a:]


def _count(batches):
    by: dict[str, np.ndarray] = {}

    def out():
        for lang, n in by.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(n[at], pa.int64())], names=["lang", "bin", "n"])
        by.clear()
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for a, texts in _parts(batch.column("text")):
            bins, docs, _ = _grams(texts)
            here = langs[a:a + len(texts)]
            for lang in set(here):
                if lang not in by and len(by) >= TASK_LANGUAGES:
                    yield from out()
                mine = here == lang
                to = by.setdefault(lang, np.zeros(1 << BITS, np.int64))
                for b, d in zip(bins, docs):
                    to += np.bincount(b[mine[d]], minlength=1 << BITS)
    yield from out()


class Model:
    def __init__(self, langs: list[str], logp: np.ndarray):
        self.langs, self.logp = langs, logp

    def blocks(self):
        """Models of some of the languages each, in their order."""
        yield self

    def predict(self, texts: list[str | None], effective: int = 50) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        best, _, rest, has = self.likelihoods(texts, effective)
        return [self.langs[i] if ok else "und" for i, ok in zip(best, has)], np.where(has, 1 / rest, 0.0)

    def likelihoods(self, texts: list[str | None], effective: int = 50):
        """By text: number of the best language, its log-likelihood, the sum of all likelihoods relative to it, has a letter."""
        bins, docs, has = _grams(texts)
        n, k = len(texts), len(self.langs)
        ll, count = np.zeros((n, k)), np.zeros(n)
        for b, d in zip(bins, docs):
            count += np.bincount(d, minlength=n)
            for j in range(k):
                ll[:, j] += np.bincount(d, self.logp[j][b], n)
        ll *= np.where(count > effective, effective / np.maximum(count, 1), 1)[:, None]
        best = np.argmax(ll, axis=1)  # ties: the first language in order
        top = ll.max(axis=1)
        return best, top, np.exp(ll - top[:, None]).sum(axis=1), has


class Blocks:
    """A model of more languages than one matrix holds: their counts stay a table, read block by block."""

    def __init__(self, langs: list[str], counts: DataFrame, smoothing: float, size: int):
        self.langs, self.counts, self.smoothing, self.size = langs, counts, smoothing, size

    def blocks(self):
        for a in range(0, len(self.langs), self.size):
            part = self.langs[a:a + self.size]
            yield _matrix(part, self.counts.where(F.col("lang").between(part[0], part[-1])), self.smoothing)


def _matrix(langs: list[str], counts: DataFrame, smoothing: float) -> Model:
    table = counts.toArrow()  # at most 2**BITS rows a language
    at = {x: i for i, x in enumerate(langs)}
    n = np.zeros((len(langs), 1 << BITS))
    if table.num_rows:
        row = np.array([at[x] for x in table.column("lang").to_pylist()])
        n[row, table.column("bin").to_numpy()] = table.column("n").to_numpy()
    logp = np.log(n + smoothing) - np.log((n + smoothing).sum(axis=1, keepdims=True))
    return Model(langs, logp.astype(np.float32))


def train(docs: DataFrame, *, smoothing: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", max_languages: int = 400) -> Model | Blocks:
    """Counts over all training rows; one matrix holds at most max_languages columns."""
    rows = (pick(docs, id=id_col, text=text_col, lang=lang_col)
            .where(~held_out(F.col("id"))).where("lang is not null and text is not null").select("lang", "text"))
    counts = (rows.mapInArrow(_count, "lang string, bin int, n long")
              .groupBy("lang", "bin").agg(F.sum("n").alias("n")))
    counts = stage(counts, "ngrams")
    langs = sorted((r[0] for r in counts.select("lang").distinct().collect()), key=lambda x: x.encode("utf-8", "surrogatepass"))
    if len(langs) > max_languages:
        return Blocks(langs, counts, smoothing, max_languages)
    return _matrix(langs, counts, smoothing)


def identify(docs: DataFrame, model: Model | Blocks, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    rows = pick(docs, id=id_col, text=text_col)
    if isinstance(model, Blocks):
        return _identify_in_blocks(rows, model)
    shared = table_bytes(docs.sparkSession, model.logp.tobytes())
    langs = model.langs

    def run(batches):
        logp = np.frombuffer(shared.value, np.float32).reshape(len(langs), 1 << BITS)
        own = Model(langs, logp)
        for batch in batches:
            for a, texts in _parts(batch.column("text")):
                pred, score = own.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, len(texts)).cast(pa.int64()), pa.array(pred, pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def _block_scores(shared, langs: list[str]):
    def run(batches):
        own = Model(langs, np.frombuffer(shared.value, np.float32).reshape(len(langs), 1 << BITS))
        for batch in batches:
            for a, texts in _parts(batch.column("text")):
                best, top, total, has = own.likelihoods(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, len(texts)), batch.column("id").slice(a, len(texts)).cast(pa.int64()),
                     pa.array([langs[i] if ok else "und" for i, ok in zip(best, has)], pa.string()), pa.array(top),
                     pa.array(total), pa.array(has)], names=["row", "doc_id", "lang", "top", "total", "has"])
    return run


def _identify_in_blocks(rows: DataFrame, model: Blocks) -> DataFrame:
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "texts")
    found = None
    for i, part in enumerate(model.blocks()):
        shared = table_bytes(rows.sparkSession, part.logp.tobytes())
        one = stage(rows.mapInArrow(_block_scores(shared, part.langs), "row long, doc_id long, lang string, top double, total double, has boolean")
                    .withColumn("block", F.lit(i)), "scores")
        shared.unpersist()
        found = one if found is None else found.union(one)
    # ties: the first language in order, so the first block
    best = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("has").alias("has"),
                                    F.max(F.struct("top", (-F.col("block")).alias("minus"), "lang")).alias("b"),
                                    F.collect_list(F.struct("top", "total")).alias("all"))
    total = F.aggregate(F.array_sort("all"), F.lit(0.0), lambda a, x: a + x.total * F.exp(x.top - F.col("b.top")))
    return best.select("doc_id", F.col("b.lang").alias("lang_pred"), F.when(F.col("has"), 1 / total).otherwise(0.0).alias("score"))
