"""MinHash near-duplicate groups: one-permutation hashing, optimal densification, bands, stars.

A document is the set of its word shingles; two documents are linked when the Jaccard
similarity of the sets reaches a threshold, and linked documents form a component.

1. One pass over the texts writes, per document, a 128-bit key of its word sequence, the set
   size and its band keys. The signature is a one-permutation MinHash: each shingle falls
   into one of `bands * rows` bins and the bin keeps its smallest value. An empty bin copies a
   filled one, found by probing bins in an order that depends on the bin and the attempt alone
   (optimal densification).
2. Documents with the same word sequence are one class (smallest id); only classes go on, so a
   group of copies costs one row after a pre-aggregation, however large it is.
3. Classes that share a band key form a bucket. A bucket proposes the star of its smallest
   member, and of the centres that a class meets it is compared with the one it meets most
   often, so there is at most one candidate pair for each class.
4. Candidates are confirmed on their full shingle sets; the links give components.
5. A star leaves out pairs, and those matter only in buckets whose members now lie in different
   components. Such buckets are compared inside tasks: members are dealt to blocks of bounded
   size, each pair of blocks is one group, full sets are intersected through an inverted index,
   and only links that join two components are handed on (never the pairs). So every pair that
   shares a bucket ends up confirmed, refused or inside one component, and the rows that move
   stay linear in the bucket rows (times the blocks of a bucket). No cap, no link lost after
   the banding.

Banding: a pair of similarity s shares one of b bands of r rows with chance 1-(1-s^r)^b. Bands and
rows follow from the threshold and the chance `miss` to overlook a pair just at it (`banding`): at
0.8 and 0.85 there are 24 bands of 5 rows, which miss with chance 7e-5 and 8e-7.

Defined cases: a null or wordless text has no set: size 0, its own component, kept. Fewer
words than `k`: the whole sequence is the one shingle. A row with a null id cannot name a
component: it is linked with nothing, its component is null and it is kept. Repeated rows are
copies of each other; rows that share an id are one node, linked with all that any of their texts
is linked with. Extra columns are ignored.
"""

from __future__ import annotations

from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, blocks, done, mix, pick, salts, stage, utf8, word_table, worker_state
from .graph import components

_U = np.uint64
_TABLE = word_table()
_SIG = "id long, c1 long, c2 long, n_shingles long, bands array<long>"


def banding(percent: float, miss: float = 1e-4) -> tuple[int, int]:
    """(bands, rows) that overlook a pair at the threshold with chance `miss` at most: as many rows as 64
    bands allow (5 at most), and at least 24 bands."""
    if not (0 < percent <= 100 and 0 < miss < 1):
        raise ValueError("percent is in (0, 100], miss in (0, 1)")
    for rows in (5, 4, 3, 2, 1):
        chance = (percent / 100) ** rows
        bands = 1 if chance >= 1 else ceil(log(miss) / log1p(-chance))
        if bands <= 64 or rows == 1:
            return max(bands, 24), rows


def one_permutation(h: np.ndarray, doc: np.ndarray, n_docs: int, bins: int) -> np.ndarray:
    """Densified one-permutation MinHash: (n_docs, bins); rows without shingles stay at the maximum."""
    empty = np.iinfo(_U).max
    sig = np.full(n_docs * bins, empty, _U)
    cell = doc * bins + ((h >> _U(32)) * _U(bins) >> _U(32)).astype(np.int64)
    with np.errstate(over="ignore"):
        np.minimum.at(sig, cell, mix(h * _U(0xD1342543DE82EF95)) >> _U(1))
    sig = sig.reshape(n_docs, bins)
    filled = sig != empty
    d, b = np.nonzero(~filled & filled.any(axis=1)[:, None])
    values, attempt = sig.copy(), 0
    while len(d):
        attempt += 1
        with np.errstate(over="ignore"):
            probe = (mix(b.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(attempt)) % _U(bins)).astype(np.int64)
        hit = filled[d, probe]
        sig[d[hit], b[hit]] = values[d[hit], probe[hit]]
        d, b = d[~hit], b[~hit]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n_docs, bands) 64-bit keys, different between bands."""
    c, lane = salts(rows, 5), salts(bands, 6)
    with np.errstate(over="ignore"):
        acc = np.zeros((len(sig), bands), _U)
        for j in range(rows):
            acc += sig[:, j::rows][:, :bands] * c[j]
        return mix(mix(acc) + lane[None, :])


def _list(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    off = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat.view(np.int64)))


def _signatures(k: int, bands: int, rows: int):
    def run(batches):
        worker_state("neardup")
        c = salts(2, 21)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids = batch.column("id")
            for a, b in blocks(offsets):
                w = Words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], _TABLE)
                h, d, _ = w.shingles(k)
                edge = np.searchsorted(d, np.arange(w.n_docs + 1))
                size = np.array([len(np.unique(h[s:e])) for s, e in zip(edge[:-1], edge[1:])], np.int64)
                keys = band_keys(one_permutation(h, d, w.n_docs, bands * rows), bands, rows)
                has = w.count > 0
                keys = keys[has]
                # two keys of the word sequence: position-weighted sums of the words' hashes
                content = np.zeros((2, w.n_docs), _U)
                pos = (np.arange(len(w.hash)) - w.first[w.doc]).astype(_U)
                with np.errstate(over="ignore"):
                    for j in range(2):
                        total = np.zeros(len(pos) + 1, _U)
                        np.cumsum(mix(w.hash * c[j] + mix(pos + c[j])), out=total[1:])
                        content[j] = mix(total[w.first[1:]] - total[w.first[:-1]] + w.count.astype(_U) * c[j])
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a), pa.array(content[0].view(np.int64)), pa.array(content[1].view(np.int64)),
                    pa.array(size), _list(keys.ravel(), np.where(has, bands, 0))],
                    names=["id", "c1", "c2", "n_shingles", "bands"])
    return run


def _sets(k: int):
    def run(batches):
        worker_state("neardup")
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in blocks(offsets):
                w = Words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], _TABLE)
                h, d, _ = w.shingles(k)
                edge = np.searchsorted(d, np.arange(w.n_docs + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, b - a),
                    pa.array([np.unique(h[s:e]).tobytes() for s, e in zip(edge[:-1], edge[1:])], pa.binary())],
                    names=["id", "items"])
    return run


def _confirmed(percent: int):
    def run(batches):
        worker_state("neardup")
        for batch in batches:
            su, sv = batch.column("su"), batch.column("sv")
            keep = []
            for i in range(batch.num_rows):
                x, y = np.frombuffer(su[i].as_buffer(), _U), np.frombuffer(sv[i].as_buffer(), _U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(mask), batch.column("v").filter(mask)],
                                             names=["u", "v"])
    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (u, v) whose full sets reach the threshold (sets grow with the data: never broadcast)."""
    sets = sets.hint("merge")
    left = pairs.join(sets.select(F.col("id").alias("v"), F.col("items").alias("sv")), "v")
    both = left.join(sets.select(F.col("id").alias("u"), F.col("items").alias("su")), "u")
    return both.select("u", "v", "su", "sv").mapInArrow(_confirmed(percent), "u long, v long")


#: A block of a bucket holds at most about so many members and shingles.
BLOCK_MEMBERS, BLOCK_SHINGLES = 1500, 2_000_000


def _links_inside(percent: int):
    """Links between different components of one group (a bucket, or two blocks of it)."""
    def run(table: pa.Table) -> pa.Table:
        worker_state("neardup")
        ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
        items = [np.frombuffer(x.as_buffer(), _U) for x in table.column("items").combine_chunks()]
        n, size = len(ids), np.array([len(x) for x in items])
        _, parent = np.unique(table.column("component").to_numpy(), return_inverse=True)
        across = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        _, word = np.unique(np.concatenate(items), return_inverse=True)
        owner = np.repeat(np.arange(n), size)
        order = np.argsort(word, kind="stable")
        post, first = owner[order], np.searchsorted(word[order], np.arange(word.max() + 2))
        edge = np.concatenate([[0], np.cumsum(size)])
        us, vs = [], []
        # a pair of two components has a member outside the largest
        for v in np.flatnonzero(parent != np.argmax(np.bincount(parent))):
            if (parent == parent[0]).all():
                break
            w = word[edge[v]:edge[v + 1]]
            lens = first[w + 1] - first[w]
            at = np.repeat(first[w] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
            both = np.bincount(post[at], minlength=n)
            hit = (parent != parent[v]) & (100 * both >= percent * (size[v] + size - both))
            if across:
                hit &= block != block[v]
            for u in np.flatnonzero(hit):
                if parent[u] != parent[v]:
                    us.append(min(ids[u], ids[v]))
                    vs.append(max(ids[u], ids[v]))
                    parent[parent == parent[u]] = parent[v]
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})
    return run


def near_duplicates(docs: DataFrame, *, k: int = 5, percent: int = 80, miss: float = 1e-4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; see the module's description.

    percent: documents are linked when 100 * |intersection| >= percent * |union|.
    miss: the chance at most to overlook a pair just at the threshold.
    """
    spark = docs.sparkSession
    bands, rows = banding(percent, miss)
    texts = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), "text")
    sig = stage(texts.mapInArrow(_signatures(k, bands, rows), _SIG), "sig")

    usable = sig.where("id is not null and n_shingles > 0")
    classes = stage(usable.groupBy("c1", "c2").agg(
        F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    rows_of = classes.select(F.col("rep").alias("id"), "n", F.explode("bands").alias("bucket"))
    size = stage(rows_of.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"),
        F.min(F.struct("id", "n")).alias("centre")).where("members > 1"), "size")
    member = stage(rows_of.join(size, "bucket").select("bucket", "id", "n", "members", "shingles", "centre"), "buckets")
    done(spark, size)

    ids = member.select("id").distinct()
    sets = stage(texts.join(ids.hint("merge"), "id", "left_semi").mapInArrow(_sets(k), "id long, items binary")
                 .groupBy("id", "items").agg(F.lit(1).alias("one")).drop("one"), "sets")
    done(spark)
    met = (member.where("id != centre.id")
           .where(100 * F.least("n", "centre.n") >= percent * F.greatest("n", "centre.n"))
           .groupBy(F.col("id").alias("v"), F.col("centre.id").alias("u")).agg(F.count(F.lit(1)).alias("times")))
    pairs = met.groupBy("v").agg(F.min(F.struct(-F.col("times"), "u")).alias("best")).select(F.col("best.u").alias("u"), "v")
    owner = stage(usable.join(classes.select("c1", "c2", "rep"), ["c1", "c2"]).select("id", "rep"), "owner")
    # rows of several classes may share an id: their classes are one node
    shared = owner.groupBy("id").agg(F.min("rep").alias("u"), F.max("rep").alias("v")).where("u != v")
    same = owner.join(shared.select("id", "u"), "id").where("rep != u").select("u", F.col("rep").alias("v"))
    links = stage(_links(pairs, sets, percent).union(same), "links")
    comp = components(links)

    seen = stage(member.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")), "seen")
    # buckets of several components; of buckets with the same members one will do
    mixed = stage(seen.groupBy("bucket").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("m"),
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("x"), F.sum(F.xxhash64("id", F.lit(1)).cast("decimal(38,0)")).alias("y"))
        .where("lo != hi").groupBy("m", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket"), "mixed")
    # blocks of a bucket, and for each member the pairs of blocks it takes part in
    parts = F.greatest(F.ceil(F.col("members") / BLOCK_MEMBERS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    open_ = (seen.join(mixed, "bucket").withColumn("parts", parts.cast("int"))
             .withColumn("block", F.pmod(F.hash("id"), "parts"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "id", "component"))
    inside = (open_.join(sets.hint("merge"), "id").groupBy("bucket", "i", "j")
              .applyInArrow(_links_inside(percent), "u long, v long"))
    more = stage(inside.distinct(), "links")
    done(spark, seen, mixed)
    if not more.isEmpty():
        comp = components(links.union(more))

    # class of each document, then the component of the class
    node = owner.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "id", F.coalesce("component", "rep").alias("component"))
    best = node.groupBy("id").agg(F.min("component").alias("component_id"))
    return (sig.select("id", "n_shingles").join(best, "id", "left")
            .select(F.col("id").alias("doc_id"), "n_shingles",
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
