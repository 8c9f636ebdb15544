"""Toxicity by non-negative positive-unlabelled learning.

Known are some toxic documents (positive) and a mass of texts without a verdict (unlabelled,
toxic ones among them). With the class prior p the risk of a classifier on negatives is
estimated from unlabelled minus positives; the non-negative estimator stops that difference
from falling below zero, which is where a flexible model would start to overfit:

    risk = p * R_pos(+1) + max(0, R_unl(-1) - p * R_pos(-1))

The classifier is linear over hashed words and word beginnings of 4 and 5 bytes, which join the
inflections of a word (presence, lower-cased, ASCII punctuation as separator), trained in numpy by gradient steps; where the second term is negative its
gradient is reversed, as the method prescribes.

Fitting uses at most `max_positive` confirmed toxic rows and `max_unlabelled` other rows, both
drawn evenly by a hash of the row from all training rows (bounds of the sample are these two
parameters); negative verdicts are not used for the fit, only the share of toxic rows among
all labelled training rows as class prior. Scoring covers every row and the whole text.
The sample's words are counted by Spark; the driver gets the counts of words in a hundredth of the
positive rows or more, chooses, and gets of each sample row the chosen words.

Defined cases: null text scores as the empty text. Several labels of one document: the
largest counts; null labels are none. Without confirmed toxic training rows every score is 0.
Repeated rows are scored each; extra columns are passed by. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, blocks, done, held_out, mix, pick, q, ship, stage, table_bytes, utf8, word_table, worker_state

BITS = 20
_SAMPLE = "positive boolean, words array<int>"
_TABLE = word_table(punctuation=True)


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hashed word or word beginning) pairs of a block, in the documents' order."""
    w = Words(data, offsets, _TABLE)
    low = np.concatenate([_TABLE[data], np.zeros(8, np.uint8)]).astype(np.uint64)
    size, out, docs = w.end - w.start, [w.hash], [w.doc]
    for n in (4, 5):
        at = w.start[size > n]
        code = np.zeros(len(at), np.uint64)
        for i in range(n):
            code |= low[at + i] << np.uint64(8 * i)
        out.append(mix(code + np.uint64(n << 56)))
        docs.append(w.doc[size > n])
    doc = np.concatenate(docs)
    order = np.argsort(doc, kind="stable")
    return doc[order], (np.concatenate(out)[order] >> np.uint64(64 - BITS)).astype(np.int64)


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, f = _features(data, offsets)
        hit = np.flatnonzero(self.weights[f])
        pair = np.unique((doc[hit] << BITS) | f[hit])  # presence
        z = np.full(len(offsets) - 1, self.bias)
        np.add.at(z, pair >> BITS, self.weights[pair & (1 << BITS) - 1].astype(float))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _contrast(n_pos: np.ndarray, n_unl: np.ndarray, pos: int, unl: int) -> np.ndarray:
    """z-score of a word's share in positives against unlabelled."""
    a, b = n_pos / max(pos, 1), n_unl / max(unl, 1)
    m = (n_pos + n_unl) / max(pos + unl, 1)
    return (a - b) / np.sqrt(np.maximum(m * (1 - m), 1e-9) * (1 / max(pos, 1) + 1 / max(unl, 1)))


class PuRisk:
    """The non-negative risk of a linear classifier (its bias comes last) on rows of distinct features."""

    def __init__(self, pos: list[np.ndarray], unl: list[np.ndarray], prior: float, size: int, l2: float):
        def sparse(rows):
            return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([*rows, np.zeros(0, int)]).astype(int), len(rows)
        self.pos, self.unl, self.prior, self.size, self.l2 = sparse(pos), sparse(unl), prior, size, l2

    @staticmethod
    def scores(rows, theta: np.ndarray) -> np.ndarray:
        return np.bincount(rows[0], theta[rows[1]], rows[2]) + theta[-1]

    def _back(self, rows, g: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(rows[1], g[rows[0]], self.size), g.sum()) / rows[2]

    def __call__(self, theta: np.ndarray) -> tuple[float, float, np.ndarray]:
        """(risk, its estimated part on negatives, direction of descent times -1): the gradient of the risk, or
        of minus the negative part where that is below zero."""
        def sig(x):
            return 1 / (1 + np.exp(-np.clip(x, -60, 60)))
        p, u, prior = self.pos, self.unl, self.prior
        zp, zu = self.scores(p, theta), self.scores(u, theta)
        # logistic loss: of calling z positive -log s(z), negative -log s(-z)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_neg = self._back(u, sig(zu)) - prior * self._back(p, sig(zp))
        value = prior * np.logaddexp(0, -zp).mean() + max(0.0, negative) + self.l2 / 2 * (theta[:-1] ** 2).sum()
        if negative < 0:
            g = -g_neg
            if self.l2:
                g[:-1] += self.l2 * theta[:-1]
            return float(value), float(negative), g
        g = prior * self._back(p, sig(zp) - 1) + g_neg
        g[:-1] += self.l2 * theta[:-1]
        return float(value), float(negative), g


def choose(words: np.ndarray, count: tuple[np.ndarray, np.ndarray], n_pos: int, n_unl: int, prior: float, *,
           z_least: float = 5.0, max_features: int = 4096, precision: float = 0.75) -> np.ndarray:
    """The hashed words to train on, ascending, from the positive and the unlabelled rows that hold each word; words in
    fewer than `least_rows` positives may be missing. Words that do not tell positives from unlabelled rows
    (|z| < z_least), occur in few positives (copies of one text would do) or whose unlabelled rows are,
    by the class prior, not `precision` positive are left out."""
    z = np.abs(_contrast(count[0], count[1], n_pos, n_unl))
    z[count[0] < least_rows(n_pos)] = 0
    # rows with the word that are positive by the prior, against all rows with it (less one deviation)
    z[prior * count[0] / n_pos < precision * (count[1] - np.sqrt(count[1])) / n_unl] = 0
    rank = np.lexsort((words, -z))[:max_features]
    used = np.sort(words[rank[z[rank] >= z_least]])
    if not len(used):
        every = np.zeros(1 << BITS)
        every[words] = z
        used = np.sort(np.argsort(-every, kind="stable")[:max_features][:64])
    return used


def least_rows(n_pos: int) -> float:
    """Positive rows that a word must occur in."""
    return max(3, 0.01 * n_pos)


def fit(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, used: np.ndarray, *, steps: int = 400,
        rate: float = 0.1, l2: float = 1e-4) -> Model:
    """Train on lists of distinct hashed words, all of them among `used` (ascending); other words have weight 0.

    Last, the decision is put into the widest gap of the unlabelled scores whose rank is within
    half of the class prior, if there is a gap to speak of: estimates of a risk that is a difference
    are biased towards one side on a finite sample, the gap is not."""
    size = 1 << BITS
    if not pos or not unl:
        return Model(np.zeros(size), -60.0)
    risk = PuRisk([np.searchsorted(used, r) for r in pos], [np.searchsorted(used, r) for r in unl], prior, len(used), l2)
    theta, m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    theta[-1] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        _, _, g = risk(theta)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    zu = np.sort(risk.scores(risk.unl, theta))[::-1]
    a, b = int(0.5 * prior * len(zu)), int(1.5 * prior * len(zu)) + 1
    gap = zu[a:b] - zu[a + 1:b + 1][:len(zu[a:b])] if b < len(zu) else np.zeros(0)
    if len(gap) and gap.max() >= 0.5:
        at = a + int(np.argmax(gap))
        theta[-1] -= (zu[at] + zu[at + 1]) / 2
    weights = np.zeros(size)
    weights[used] = theta[:-1]
    return Model(weights, theta[-1])


def _distinct_words(batches):
    worker_state("toxicity")
    for batch in batches:
        data, off = utf8(batch.column("text"))
        for a, b in blocks(off):
            doc, f = _features(data[off[a]:off[b]], off[a:b + 1] - off[a])
            edge = np.searchsorted(doc, np.arange(b - a + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive").slice(a, b - a),
                 pa.array([np.unique(f[s:e]).astype(np.int32) for s, e in zip(edge[:-1], edge[1:])], pa.list_(pa.int32()))],
                names=["positive", "words"])


def _only(used: np.ndarray):
    """Of each row's words those among `used`."""
    def run(batches):
        worker_state("toxicity")
        known = np.zeros(1 << BITS, bool)
        known[used] = True
        for batch in batches:
            words = batch.column("words")
            flat = words.flatten().to_numpy()
            keep = known[flat]
            kept = np.concatenate([[0], np.cumsum(keep)])
            ends = np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy())]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), pa.ListArray.from_arrays(pa.array(kept[ends], pa.int32()), pa.array(flat[keep], pa.int32()))],
                names=["positive", "words"])
    return run


def train(docs: DataFrame, labels: DataFrame, *, max_positive: int = 2500, max_unlabelled: int = 10000,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit from the training rows (those that `held_out` does not set aside)."""
    texts = pick(docs, id=id_col, text=text_col).where(~held_out(F.col("id")))
    known = pick(labels, id=id_col, y=label_col).where("id is not null and y is not null")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    n, n_pos = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("y")), F.lit(0))).first()
    n_docs = texts.count()
    if not n_pos or not n_docs:
        return fit([], [], 0.5, np.zeros(0, np.int64))
    prior = min(max(n_pos / n, 1e-4), 1 - 1e-4)
    even = F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    # ids of the positives: at most about max_positive rows, so a broadcast of known size
    chosen = known.where("y = 1").where(even < max_positive / n_pos).select("id", F.lit(True).alias("positive")).limit(2 * max_positive)
    rows = texts.join(F.broadcast(chosen), "id", "left").withColumn("positive", F.coalesce("positive", F.lit(False)))
    other = F.pmod(F.xxhash64("id", F.lit("unlabelled")), F.lit(1 << 30)) / float(1 << 30) < max_unlabelled / n_docs
    # a positive may also be drawn as an unlabelled row, as the method wants
    sample = stage(rows.where(F.col("positive") | other)
                   .withColumn("positive", F.explode(F.filter(F.array(F.when(F.col("positive"), True), F.when(other, False)),
                                                              lambda x: x.isNotNull())))
                   .select("positive", "text").mapInArrow(_distinct_words, _SAMPLE)
                   .limit(2 * (max_positive + max_unlabelled)), "sample")
    # the words are counted where they are: the driver gets those frequent in positives, then the rows' chosen ones
    one = F.col("positive").cast("long")
    pos, unl = sample.agg(F.coalesce(F.sum(one), F.lit(0)), F.coalesce(F.sum(1 - one), F.lit(0))).first()
    used = np.zeros(0, np.int64)
    if pos and unl:
        counts = (sample.select(one.alias("one"), F.explode("words").alias("word")).groupBy("word")
                  .agg(F.sum("one").alias("pos"), F.sum(1 - F.col("one")).alias("unl"))
                  .where(F.col("pos") >= least_rows(pos)).toArrow())
        word, *count = (counts.column(c).to_numpy() for c in ("word", "pos", "unl"))
        used = choose(word.astype(np.int64), count, pos, unl, prior)
    got = sample.mapInArrow(_only(used), _SAMPLE).toArrow()
    done(docs.sparkSession, sample)
    flag = got.column("positive").to_numpy()
    words = got.column("words").combine_chunks()
    off, flat = words.offsets.to_numpy(), words.values.to_numpy()
    lists = [flat[off[i]:off[i + 1]] for i in range(len(words))]
    return fit([x for x, y in zip(lists, flag) if y], [x for x, y in zip(lists, flag) if not y], prior, used)


def add_scores(df: DataFrame, model: Model, text_col: str = "text", score: str = "score") -> DataFrame:
    """All columns of df and the score of each row's whole text."""
    ship(df.sparkSession)
    names = df.columns
    at = names.index(text_col)
    df = df.toDF(*[f"c{i}" for i in range(len(names))])  # any names pass through
    used = np.flatnonzero(model.weights)
    packed = table_bytes(df.sparkSession, used.astype(np.int64).tobytes() + model.weights[used].tobytes())
    n, bias = len(used), model.bias

    def run(batches):
        worker_state("toxicity")
        weights = np.zeros(1 << BITS, np.float32)
        weights[np.frombuffer(packed.value, np.int64, n)] = np.frombuffer(packed.value, np.float32, n, 8 * n)
        own = Model(weights, bias)
        for batch in batches:
            data, off = utf8(batch.column(at))
            out = [own.scores(data[off[a]:off[b]], off[a:b + 1] - off[a]) for a, b in blocks(off)]
            got = pa.array(np.concatenate(out) if out else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, score])

    from pyspark.sql import types as T
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(score, T.DoubleType())])).toDF(*names, score)


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= 0.5) of every row."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **bounds)
    rows = docs.select(q(id_col).cast("long").alias("doc_id"), q(text_col).alias("text"))
    return add_scores(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                          F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
