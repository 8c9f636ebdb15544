"""Benchmark decontamination: SimHash of item-sized windows, multi-index search, exact check.

Words are runs of characters other than white space and ASCII punctuation, lower-cased.
For every length (in words) that a benchmark item has, the windows of that length in a
document are compared with the items of that length:

1. A window that shares too few 5-word shingles with the whole benchmark cannot reach the
   threshold; this count is exact and spares the fingerprint of nearly all windows.
2. SimHash: 256 bits, each the sign of a weighted sum over the window's shingles (weight: how
   often the shingle occurs in it).
3. Multi-index Hamming search: a fingerprint has 16 blocks of 16 bits. If two fingerprints differ
   in at most `radius` < 64 bits, some block differs in at most three (pigeonhole), so looking up
   every block with up to three flipped bits finds all items within the radius, and a popcount
   refuses the others. A lookup returns about 16 % of unrelated items. At the threshold the
   expected distance is 39 with deviation 6, so 63 overlooks a pair at it with chance 2e-5.
4. The candidates' weighted Jaccard similarity (sum of smaller over sum of larger weights) is
   computed on full shingles; 0.8 or more is a hit.

Items shorter than a shingle match where their whole word sequence occurs. Documents shorter
than an item are one window. The benchmark is broadcast in blocks of at most `block` items,
each block a pass over the documents, so a task's memory does not grow with it. Of a long document
only the stretches around possible windows are fingerprinted, `STRETCH` shingles at a time.

Defined cases: null or wordless texts and items match nothing; a null document or item id is
returned as null; repeated documents are searched each; repeated items hit each (one row for
each different id and text). Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, blocks, mix, pick, salts, ship, stage, table_bytes, utf8, word_table, worker_state

K = 5
_U = np.uint64
_TABLE = word_table(punctuation=True)
_HITS = "doc_id long, item_id long, similarity double, first_word int, n_words int"
#: Bits of a fingerprint, of a block, and flips of a block that are looked up.
BITS, BLOCK_BITS, FLIPS = 256, 16, 3
BLOCKS = BITS // BLOCK_BITS
#: Items up to which blocks are compared one by one instead of by buckets.
DIRECT_ITEMS = 4096
#: Shingles of a document that are fingerprinted at a time.
STRETCH = 1 << 16
_MASKS = np.array([sum(1 << b for b in c) for f in range(FLIPS + 1) for c in combinations(range(BLOCK_BITS), f)], np.int64)


def simhash(bits_sum: np.ndarray) -> np.ndarray:
    """(rows, BITS) sums of +1/-1 -> (rows, BLOCKS) blocks of the fingerprints."""
    return np.packbits(bits_sum > 0, axis=1).view(">u2").astype(np.uint16)


def spread(h: np.ndarray) -> np.ndarray:
    """Each shingle as BITS values of +1 or -1."""
    with np.errstate(over="ignore"):
        words = mix(h[:, None] * salts(BITS // 64, 61)[None, :])
    return np.unpackbits(words.astype(">u8").view(np.uint8).reshape(len(h), -1), axis=1).astype(np.int32) * 2 - 1


class MultiIndex:
    """All stored fingerprints within a radius (below 64) of a query."""

    def __init__(self, prints: np.ndarray, radius: int):
        if not 0 <= radius < BLOCKS * (FLIPS + 1):
            raise ValueError(f"radius must be below {BLOCKS * (FLIPS + 1)}")
        self.prints, self.radius, self.table = prints, radius, None
        if len(prints) > DIRECT_ITEMS:  # for each block its items by value, and where each value begins
            self.table = []
            for block in range(BLOCKS):
                order = np.argsort(prints[:, block], kind="stable").astype(np.int32)
                first = np.searchsorted(prints[order, block], np.arange((1 << BLOCK_BITS) + 1))
                self.table.append((order, first.astype(np.int32)))

    def candidates(self, one: np.ndarray) -> np.ndarray:
        """Items with a block of at most FLIPS flips."""
        if self.table is None:
            return np.flatnonzero((np.bitwise_count(self.prints ^ one) <= FLIPS).any(axis=1))
        found = []
        for (order, first), value in zip(self.table, one.tolist()):
            keys = value ^ _MASKS
            a, n = first[keys], first[keys + 1] - first[keys]
            a, n = a[n > 0], n[n > 0]
            found.append(order[np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] if len(n) else order[:0])
        return np.unique(np.concatenate(found))

    def search(self, one: np.ndarray) -> np.ndarray:
        found = self.candidates(one)
        return found[np.bitwise_count(self.prints[found] ^ one).sum(axis=1) <= self.radius] if len(found) else found


class Index:
    def __init__(self, texts: list[str], percent: int, radius: int):
        data, off = utf8(pa.array(texts, pa.string()))
        w = Words(data, off, _TABLE)
        h, d, _ = w.shingles(K)
        edge = np.searchsorted(d, np.arange(len(texts) + 1))
        self.percent = percent
        self.weights = [Counter(h[a:b].tolist()) for a, b in zip(edge[:-1], edge[1:])]
        # items too short for a shingle, by number of words
        self.short: dict[int, dict[int, list[int]]] = {}
        by_size: dict[int, list[int]] = {}
        for i, n in enumerate(w.count.tolist()):
            if n >= K:
                by_size.setdefault(n - K + 1, []).append(i)
            elif n:
                self.short.setdefault(n, {}).setdefault(int(h[edge[i]]), []).append(i)
        self.sizes = sorted(by_size)
        self.items = {m: np.array(by_size[m]) for m in self.sizes}
        self.search = {}
        for m, items in self.items.items():
            sums = np.stack([spread(h[edge[i]:edge[i + 1]]).sum(axis=0) for i in items])
            self.search[m] = MultiIndex(simhash(sums), radius)
        known = np.unique(np.concatenate([h[edge[i]:edge[i + 1]] for m in self.items.values() for i in m])) if by_size else h[:0]
        self.known = known
        self.bits = 20
        self.filter = np.zeros(1 << self.bits, bool)
        self.filter[(known >> _U(64 - self.bits)).astype(np.int64)] = True
        # shingles shared by a window and an item of m shingles each, at the least
        self.need = {m: max(1, math.ceil(2 * m * percent / (100 + percent) - 1e-9)) for m in self.sizes}
        self.least = min((math.ceil(m * percent / 100 - 1e-9) for m in self.sizes), default=0)

    def hits(self, data: np.ndarray, offsets: np.ndarray):
        """(document, item, similarity, first word, words) of the best window of each pair."""
        w = Words(data, offsets, _TABLE)
        out: dict[tuple[int, int], tuple[float, int, int]] = {}
        self._short_hits(w, out)
        if self.sizes:
            h, d, _ = w.shingles(K)
            maybe = np.flatnonzero(self.filter[(h >> _U(64 - self.bits)).astype(np.int64)])
            at = np.searchsorted(self.known, h[maybe])
            maybe = maybe[self.known[np.minimum(at, len(self.known) - 1)] == h[maybe]]
            many = np.bincount(d[maybe], minlength=w.n_docs)
            hit = np.zeros(len(h), np.int32)
            hit[maybe] = 1
            for doc in np.flatnonzero((many > 0) & (many >= self.least)):
                if w.count[doc] >= K:
                    a, b = np.searchsorted(d, [doc, doc + 1])
                    self._windows(int(doc), h[a:b], hit[a:b], out)
        for (doc, item), (sim, first, n) in sorted(out.items()):
            yield doc, item, sim, first, n

    def _short_hits(self, w: Words, out) -> None:
        for n, items in self.short.items():
            c = salts(K, 77)[:n]
            run = np.zeros(max(0, len(w.hash) - n + 1), _U)
            with np.errstate(over="ignore"):
                for j in range(n):
                    run += w.hash[j:len(run) + j] * c[j]
                run = mix(run + _U(n * 0x51ED27))
            for at in np.flatnonzero(np.isin(run, np.array(list(items), _U))):
                if w.doc[at] == w.doc[at + n - 1]:
                    for i in items[int(run[at])]:
                        out.setdefault((int(w.doc[at]), i), (1.0, int(at - w.first[w.doc[at]]), n))

    def _windows(self, doc: int, h: np.ndarray, hit: np.ndarray, out) -> None:
        count = np.concatenate([[0], np.cumsum(hit)])
        for m in self.sizes:
            size = min(m, len(h))
            need = self.need[m] if size == m else math.ceil(m * self.percent / 100 - 1e-9)
            start = np.flatnonzero(count[size:] - count[:len(h) - size + 1] >= need)
            for s, one in self._prints(h, start, size):
                found = self.search[m].search(one)
                if not len(found):
                    continue
                window = Counter(h[s:s + size].tolist())
                for item in self.items[m][found].tolist():
                    other = self.weights[item]
                    both = sum(min(n, other[x]) for x, n in window.items() if x in other)
                    sim = both / (size + m - both)
                    if 100 * both >= self.percent * (size + m - both) and sim > out.get((doc, item), (0.0,))[0]:
                        out[doc, item] = (sim, s, size + K - 1)

    @staticmethod
    def _prints(h: np.ndarray, start: np.ndarray, size: int):
        """(start, fingerprint) of the windows of a size, a stretch of the document at a time."""
        a = 0
        while a < len(start):
            lo = int(start[a])
            b = max(a + 1, int(np.searchsorted(start, lo + max(STRETCH, 2 * size) - size)))
            at = start[a:b] - lo
            sums = np.zeros((int(at[-1]) + size + 1, BITS), np.int32)
            np.cumsum(spread(h[lo:lo + len(sums) - 1]), axis=0, out=sums[1:])
            yield from zip(start[a:b].tolist(), simhash(sums[at + size] - sums[at]))
            a = b


def _index(raw: bytes, percent: int, radius: int) -> tuple[Index, list]:
    key = (len(raw), zlib.crc32(raw), percent, radius)
    kept = worker_state("decontam")
    if kept.get("key") != key:
        t = pa.ipc.open_stream(raw).read_all()
        kept.update(key=key, index=Index(t.column("text").to_pylist(), percent, radius), ids=t.column("item").to_pylist())
    return kept["index"], kept["ids"]


def contamination(docs: DataFrame, benchmark: DataFrame, *, percent: int = 80, radius: int = 63, block: int = 20_000,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """One row for each document and item with a window of similarity >= percent / 100: doc_id, item_id,
    similarity (of the best window, the first of equals), first_word (0-based), n_words."""
    texts = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), "text")
    found = None
    for shared in _blocks(benchmark, block, item_col, item_text_col):
        def run(batches, shared=shared):
            index, ids = _index(shared.value, percent, radius)
            for batch in batches:
                data, off = utf8(batch.column("text"))
                doc_id = batch.column("id")
                for a, b in blocks(off):
                    rows = [(doc_id[a + d].as_py(), ids[i], sim, first, n)
                            for d, i, sim, first, n in index.hits(data[off[a]:off[b]], off[a:b + 1] - off[a])]
                    if rows:
                        c = list(zip(*rows))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.float64()),
                             pa.array(c[3], pa.int32()), pa.array(c[4], pa.int32())],
                            names=[x.split()[0] for x in _HITS.split(", ")])
        one = texts.mapInArrow(run, _HITS)
        found = one if found is None else found.union(one)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, percent: int = 80, radius: int = 63, block: int = 20_000,
                   text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, without those that `contamination` finds. A benchmark of one block takes
    one pass and no shuffle; of more, the rows are written with a number, each block is searched by a
    job of its own (a worker holds one block's index), and the rows found are joined away."""
    ship(docs.sparkSession)
    names = docs.columns
    at = names.index(text_col)
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])  # any names pass through
    parts = list(_blocks(benchmark, block, item_col, item_text_col))

    def search(shared, clean_rows):
        def run(batches):
            index, _ = _index(shared.value, percent, radius)
            for batch in batches:
                data, off = utf8(batch.column(at if clean_rows else 0))
                clean = np.ones(batch.num_rows, bool)
                for a, b in blocks(off):
                    for d, *_ in index.hits(data[off[a]:off[b]], off[a:b + 1] - off[a]):
                        clean[a + d] = False
                yield batch.filter(pa.array(clean)) if clean_rows else batch.select(["row"]).filter(pa.array(~clean))
        return run
    if len(parts) == 1:
        return docs.mapInArrow(search(parts[0], True), docs.schema).toDF(*names)
    rows = stage(docs.withColumn("row", F.monotonically_increasing_id()), "decontam-rows")
    texts = rows.select(f"c{at}", "row")
    hit = stage(texts.mapInArrow(search(parts[0], False), "row long"), "decontam-hits")
    for shared in parts[1:]:
        hit = hit.union(stage(texts.mapInArrow(search(shared, False), "row long"), "decontam-hits"))
    return rows.join(hit.distinct().hint("merge"), "row", "left_anti").drop("row").toDF(*names)


def _blocks(benchmark: DataFrame, block: int, item_col: str, text_col: str):
    """The benchmark's (item, text) in broadcasts of about `block` items at most."""
    items = (pick(benchmark, item=item_col, text=text_col).where("text is not null")
             .select(F.col("item").cast("long").alias("item"), "text").distinct())
    n = max(1, math.ceil(items.count() / block))
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        table = part.orderBy("item", "text").toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        yield table_bytes(benchmark.sparkSession, sink.getvalue().to_pybytes())
