"""Source divergence audit: how far the word use of each source is from its language's other sources.

Single-pass in-memory indexing:

1. A task adds the texts it reads to block postings in memory: document frequencies of each language's
   terms, and occurrences for each source. At `BLOCK_TERMS` entries the block is spilled as a
   term-sorted run, one row for each (language, term, source), into Spark's shuffle. The row of a
   term's first source holds its document frequency.
2. Runs are dealt out by the hash of (language, term). Spark's sorter merges the runs of a shard by a
   heap, spilling where they exceed memory; the task folds equal neighbours into frequencies and
   leaves out the terms that too few documents hold. A term has one row of each run and source,
   however frequent it is, and rows are folded as they stream by.
3. A term's smoothed share is p = 1 + floor(10^9 (count + 2) / (N + 2 V)), where N is the group's kept
   occurrences and V the language's kept terms; f(p, q) = floor((p - q)^2 / (p + q)). All is exact.
4. The sum of f over all kept terms of two sources starts as V f(a0, b0), where a0, b0 are the shares
   of terms that they do not hold. Corrections are streamed: for the terms of a, with b's share at
   b0, from a's histogram of shares; for terms of both, from the merged postings. Tasks add the
   corrections of a pair up before they are shuffled, so that no term emits its pairs of sources.

Bounds: a task holds one block, one posting list (at most the sources of a language), or the pair
sums up to `TASK_PAIRS`; sources of a language are few enough that all pairs of them are the result.

Defined cases: null text, lang and source are ''. Repeated rows are documents of their own. A
language without kept terms has pairs of value 0 and no terms; a group without terms takes part with
count 0. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import done, pick, stage, worker_state

#: Postings that a task holds before it spills them as a run.
BLOCK_TERMS = 1_000_000
#: Pairs of sources whose sums a task holds before it hands them on, and pairs added at a time.
TASK_PAIRS, CHUNK_PAIRS = 1_000_000, 2_000_000
#: Bytes of one text that are split at a time; cuts are made between terms.
SLICE_BYTES = 1 << 22
#: What a share of 1 is.
UNIT = 1_000_000_000
# A-Z lowered; a-z and all bytes of characters beyond ASCII kept; the others separate.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0x80 else 32 for c in range(256))
_RUN = "lang string, term string, source string, count long, df long"


def _terms(text: bytes):
    """Terms of a text in lists of bounded size."""
    raw, a = text.translate(_TERM_BYTES), 0
    while a < len(raw):
        b = raw.find(b" ", a + SLICE_BYTES) if len(raw) - a > SLICE_BYTES else -1
        b = len(raw) if b < 0 else b
        yield raw[a:b].split()
        a = b


def _index(batches):
    """Term-sorted runs."""
    worker_state("divergence")
    block: dict[str, dict[str | None, Counter]] = {}
    held = 0

    def spill():
        cols = [[], [], [], [], []]
        for lang, sources in block.items():
            df = sources.pop(None)
            for source, counts in sources.items():
                # a term's document frequency goes with the first source that holds it
                for c, v in zip(cols, ([lang] * len(counts), list(counts), [source] * len(counts), counts.values(),
                                       [df.pop(t, 0) for t in counts])):
                    c += v
        block.clear()
        t = pa.Table.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary()).cast(pa.string()),
                                  pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                                 names=["lang", "term", "source", "count", "df"])
        return t.sort_by([("term", "ascending"), ("lang", "ascending")]).to_batches(max_chunksize=16384)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for i in range(batch.num_rows):
            sources = block.setdefault(batch.column("lang")[i].as_py(), {None: Counter()})
            mine, docs = sources.setdefault(batch.column("source")[i].as_py(), Counter()), sources[None]
            held -= len(mine) + len(docs)
            distinct: set[bytes] = set()
            for terms in _terms(texts[i].as_py()):
                mine.update(terms)
                distinct = distinct.union(terms) if distinct else set(terms)
            docs.update(distinct)
            held += len(mine) + len(docs)
            if held > BLOCK_TERMS:
                yield from spill()
                held = 0
    if held:
        yield from spill()


_FREQUENCY = "lang string, term string, source string, count long, total long, first long"


def _merge(min_docs: int):
    """Frequencies of the terms that at least min_docs documents hold, from sorted rows of runs. total: the
    term's count in its language; first: 1 in one row of each term."""

    def edges(t: pa.Table, names) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for n in names:
            c = t.column(n)
            differs = pc.not_equal(c.slice(1).combine_chunks(), c.slice(0, t.num_rows - 1).combine_chunks())
            new[1:] |= differs.fill_null(True).to_numpy(zero_copy_only=False)
        return new

    def fold(t: pa.Table) -> pa.Table:
        """Equal neighbours as one row."""
        at = np.flatnonzero(edges(t, ("term", "lang", "source")))
        sums = [pa.array(np.add.reduceat(t.column(c).to_numpy(), at)) for c in ("count", "df")]
        rows = t.select(["lang", "term", "source"]).take(pa.array(at))
        return rows.append_column("count", sums[0]).append_column("df", sums[1])

    def run(batches):
        worker_state("divergence")
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = fold(pa.concat_tables([rest, t]).combine_chunks() if rest is not None else t) if t.num_rows else rest
            if t is None:
                continue
            last = int(np.flatnonzero(edges(t, ("term", "lang")))[-1])  # this term may go on
            if last:
                yield from kept(t.slice(0, last).combine_chunks())
            rest = t.slice(last).combine_chunks()
        if rest is not None:
            yield from kept(rest)

    def kept(t: pa.Table):
        start = np.flatnonzero(edges(t, ("term", "lang")))
        of = np.repeat(np.arange(len(start)), np.diff(np.append(start, t.num_rows)))
        total = np.add.reduceat(t.column("count").to_numpy(), start)
        take = np.flatnonzero(np.add.reduceat(t.column("df").to_numpy(), start)[of] >= min_docs)
        first = np.ones(len(take), np.int64)
        first[1:] = of[take[1:]] != of[take[:-1]]
        out = t.drop_columns(["df"]).take(pa.array(take))
        yield from out.append_column("total", pa.array(total[of[take]])).append_column("first", pa.array(first)).to_batches()
    return run


def frequencies(docs: DataFrame, *, min_docs: int = 10, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """lang, term, source, count, total, first: occurrences of each language's terms that at least min_docs of
    its documents hold, by source."""
    texts = pick(docs, text=text_col, lang=lang_col, source=source_col)
    texts = texts.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in texts.columns])
    runs = texts.mapInArrow(_index, _RUN)
    shards = runs.repartition("lang", "term").sortWithinPartitions("term", "lang", "source")
    return shards.mapInArrow(_merge(min_docs), _FREQUENCY)


def _share(count: str, n: str) -> str:
    """SQL of the share of a count among n occurrences and 2 for each of V terms; exact for any long."""
    return (f"1 + (cast({UNIT} as decimal(10, 0)) * cast({count} + 2 as decimal(19, 0)) "
            f"div cast({n} + 2 * V as decimal(19, 0)))")


def _distance(p, q):
    """floor((p - q)^2 / (p + q)) of integer columns or arrays."""
    d = p - q
    return d * d // (p + q)


class _PairSums:
    """Sums of values by pair of (lang, source) groups, held in bounded memory."""

    def __init__(self):
        self.number: dict[tuple[str, str], int] = {}
        self.names: list[tuple[str, str]] = []
        self.codes, self.values = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def groups(self, langs: pa.Array, sources: pa.Array) -> np.ndarray:
        """Numbers of the groups of each row."""
        both = pa.table({"l": langs, "s": sources}).group_by(["l", "s"]).aggregate([])
        for key in zip(both.column("l").to_pylist(), both.column("s").to_pylist()):
            if key not in self.number:
                self.number[key] = len(self.names)
                self.names.append(key)
        ls, ss = langs.dictionary_encode(), sources.dictionary_encode()
        table = np.array([[self.number.get((a, b), -1) for b in ss.dictionary.to_pylist()] for a in ls.dictionary.to_pylist()])
        return table.reshape(len(ls.dictionary), -1)[ls.indices.to_numpy(), ss.indices.to_numpy()]

    def add(self, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> None:
        self.parts.append(((np.minimum(a, b) << 32) | np.maximum(a, b), value))
        self.waiting += len(value)
        if self.waiting > CHUNK_PAIRS:
            self.settle()

    def settle(self) -> None:
        codes = np.concatenate([self.codes, *[c for c, _ in self.parts]])
        values = np.concatenate([self.values, *[v for _, v in self.parts]])
        self.parts, self.waiting = [], 0
        if len(codes):
            order = np.argsort(codes, kind="stable")
            codes = codes[order]
            at = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            self.codes, self.values = codes[at], np.add.reduceat(values[order], at)

    def out(self):
        self.settle()
        for lo in range(0, len(self.codes), 16384):
            a, b = self.codes[lo:lo + 16384] >> 32, self.codes[lo:lo + 16384] & 0xFFFFFFFF
            for one, other in ((a, b), (b, a)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([self.names[i][0] for i in one]), pa.array([self.names[i][1] for i in one]),
                     pa.array([self.names[i][1] for i in other]), pa.array(self.values[lo:lo + 16384])],
                    names=["lang", "source", "item", "value"])
        self.__init__()


_PAIR = "lang string, source string, item string, value long"


def _shared_terms(batches):
    """Corrections from terms that two sources hold: rows are posting lists of (source, p, p of absent terms)."""
    worker_state("divergence")
    sums = _PairSums()
    for batch in batches:
        lists = batch.column("posting")
        size = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        begin = lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
        p, p0 = flat.field("p").to_numpy(), flat.field("p0").to_numpy()
        langs = batch.column("lang").take(pa.array(np.repeat(np.arange(batch.num_rows), size)))
        group = sums.groups(langs, flat.field("source"))
        for k in np.unique(size[size > 1]):
            rows = begin[size == k]
            per = max(1, CHUNK_PAIRS // int(k))
            for lo in range(0, len(rows), per):
                at = rows[lo:lo + per, None] + np.arange(k)
                x, x0, g = p[at], p0[at], group[at]
                for i in range(int(k) - 1):
                    a, a0, b, b0 = x[:, i:i + 1], x0[:, i:i + 1], x[:, i + 1:], x0[:, i + 1:]
                    value = _distance(a, b) - _distance(a, b0) - _distance(a0, b) + _distance(a0, b0)
                    sums.add(np.broadcast_to(g[:, i:i + 1], b.shape).ravel(), g[:, i + 1:].ravel(), value.ravel())
                    if len(sums.codes) > TASK_PAIRS:
                        yield from sums.out()
    yield from sums.out()


def _own_terms(batches):
    """Start values, and corrections from the terms of one source at the other's share of absent terms."""
    worker_state("divergence")
    for batch in batches:
        for r in batch.to_pylist():
            lang, a, v, a0 = r["lang"], r["source"], r["V"], r["p0"]
            names = [o["source"] for o in r["others"] if o["source"] != a]
            if not names:
                continue
            b0 = np.array([o["p0"] for o in r["others"] if o["source"] != a], np.int64)
            own, start = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
            if v:
                at_rest = _distance(np.int64(a0), b0)
                start = v * at_rest
                p, n = np.array([h["p"] for h in r["shares"]], np.int64), np.array([h["n"] for h in r["shares"]], np.int64)
                step = max(1, CHUNK_PAIRS // len(names))
                for lo in range(0, len(p), step):
                    own += (n[lo:lo + step, None] * (_distance(p[lo:lo + step, None], b0) - at_rest)).sum(0)
            same, langs = [a] * len(names), [lang] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(same), pa.array(names), pa.array(start + own)],
                                             names=["lang", "source", "item", "value"])
            yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(names), pa.array(same), pa.array(own)],
                                             names=["lang", "source", "item", "value"])


def divergence(docs: DataFrame, *, min_docs: int = 10, top: int = 10, text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) group.

    part "pair": item is another source of the language, value the sum of f over all kept terms, all
    ranks. part "term": item is a term of the group that it uses more than its language, value f of
    the two shares, `top` ranks. Ranks go by falling value, then by item."""
    names = pick(docs, lang=lang_col, source=source_col)
    every = names.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names.columns]).distinct()
    terms = stage(frequencies(docs, min_docs=min_docs, text_col=text_col, lang_col=lang_col, source_col=source_col), "frequencies")
    by_group = terms.groupBy("lang", "source").agg(F.sum("count").alias("N"))
    by_lang = terms.groupBy("lang").agg(F.sum("first").alias("V"), F.sum("count").alias("N_lang"))
    groups = stage(every.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").select(
        "lang", "source", F.coalesce("N", F.lit(0)).alias("N"), F.coalesce("V", F.lit(0)).alias("V"),
        F.coalesce("N_lang", F.lit(0)).alias("N_lang")).withColumn(
        "p0", F.expr(f"if(V = 0, 0, {_share('0', 'N')})")), "groups")
    shares = stage(terms.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", F.expr(_share("count", "N")).alias("p"), F.expr(_share("total", "N_lang")).alias("q"), "p0"), "shares")
    done(docs.sparkSession, terms)

    value = F.expr("(p - q) * (p - q) div (p + q)")
    ranks = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    best = (shares.where("p > q").select("lang", "source", F.col("term").alias("item"), value.alias("value"))
            .withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= top))

    postings = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("posting"))
    shared = postings.where(F.size("posting") > 1).select("lang", "posting").mapInArrow(_shared_terms, _PAIR)
    histogram = (shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n")).groupBy("lang", "source")
                 .agg(F.collect_list(F.struct("p", "n")).alias("shares")))
    others = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "p0")).alias("others"))
    own = (groups.join(histogram, ["lang", "source"], "left").join(others, "lang")
           .select("lang", "source", "V", "p0", F.coalesce("shares", F.array().cast("array<struct<p: bigint, n: bigint>>")).alias("shares"),
                   "others").mapInArrow(_own_terms, _PAIR))
    pairs = (own.union(shared).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .withColumn("rank", F.row_number().over(ranks)))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").union(
        best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
