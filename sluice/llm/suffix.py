"""Substring dedup: bytes covered by a long string that also starts elsewhere in the corpus.

A suffix array sorts every suffix; to know whether the `length`-byte string at a position
repeats, only the buckets of suffixes that agree on their first bytes matter. This is
bucket-pointer refinement, distributed and on a sparse set of suffixes:

1. Anchors. The suffixes whose first q bytes have the smallest hash among the q-grams of some
   `length`-byte string (a sliding minimum, all ties kept). Every such string holds an anchor
   that depends on its bytes alone, so equal strings have their anchors at equal offsets.
2. Initial buckets: the q-gram at the anchor. Spark counts the buckets; an anchor alone in its
   bucket is finished, as in the sequential algorithm.
3. Refinement: a bucket is split by the bucket identifiers of the q-grams at other offsets.
   The union bucket of an anchor is the tuple of identifiers that covers all the `length`-byte
   strings around it: if it has two members, all those strings repeat. Members that agree so
   far stand for each other, and only one of them goes on.
4. What is left are the ends of matches. Their context (under 2 * length bytes) is grouped by
   bucket and refined down to single offsets inside tasks. A bucket too large for a task is
   first refined by Spark: its offsets are halved, each half's bucket is the parent's bucket
   refined by the identifier of the string that all offsets of the half share, and steps 2 and
   3 are done again on the new buckets, recursively down to one offset if need be.
5. The found intervals are merged per document and cut out.

Identifiers are 64-bit fingerprints instead of ranks, so that the identifier of any offset is
known without communication; two strings are taken as equal when q-gram and refined identifier
agree (128 bits), or inside a task when both the bucket and a 64-bit fingerprint agree.
No copy group is collected: counting is pre-aggregated and joins read written tables that the
adaptive planner can split. Per-document lists are bounded by the document's own length.

Defined cases: null text is empty; texts shorter than `length` lose nothing; matches never
cross documents; rows that repeat (id and text) are copies of each other, each returned.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _power, done, mix, pick, salts, stage, utf8, worker_state
from .common import q as q_

_U = np.uint64
_CODES = (salts(256, 31), salts(256, 32))
#: Bytes of one document that are worked on at a time.
SEGMENT = 1 << 22
#: Rows of one bucket that a task may hold; larger buckets are refined by Spark first.
BUCKET_ROWS = 32768
#: Rows that a task refines at a time, whole buckets together.
CHUNK_ROWS = 4096


def _prefix(data: np.ndarray, code: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(code[data] * _power(len(data) + 1)[0][:len(data)], out=total[1:])
    return total


def _ids(total: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Identifiers of the `size` bytes at each start."""
    return mix((total[start + size] - total[start]) * _power(len(total))[1][start] + _U(size))


def _sliding(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over every run of w values, by doubling."""
    k = 1
    while 2 * k <= w:
        x = f(x[:-k], x[k:])
        k *= 2
    return f(x[:len(x) - (w - k)], x[w - k:]) if k < w else x


def anchors(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions whose value is the smallest of some w consecutive values."""
    least = _sliding(grams, w, np.minimum)
    pad = np.zeros(w - 1, _U)
    return np.flatnonzero(grams == _sliding(np.concatenate([pad, least, pad]), w, np.maximum))


def _segments(n: int, length: int):
    """(from, to, first, last): bytes to look at and the anchor positions to report."""
    if n <= SEGMENT:
        yield 0, n, 0, n
        return
    for a in range(0, n, SEGMENT):
        yield max(0, a - 2 * length), min(n, a + SEGMENT + 2 * length), a, min(n, a + SEGMENT)


def _find_anchors(length: int, q: int):
    w, reach = length - q + 1, length - q

    def of(doc: np.ndarray, e: int, k: int):
        n = len(doc)
        for lo, hi, first, last in _segments(n, length):
            data = doc[lo:hi]
            if len(data) < length:
                continue
            total = _prefix(data, _CODES[0])
            grams = _ids(total, np.arange(len(data) - q + 1), q)
            pos = anchors(grams, w)
            pos = pos[(pos + lo >= first) & (pos + lo < last)]
            core = grams[pos]
            # union bucket: the identifiers of q-grams that tile [pos - reach, pos + length)
            inside = (pos >= reach) & (pos + length <= len(data))
            at, union = pos[inside], np.zeros(len(pos), _U)
            acc = np.zeros(len(at), _U)
            offsets = [*range(-reach, length - q, q), length - q]
            for c, o in zip(salts(len(offsets), 41), offsets):
                acc += mix(grams[at + o] ^ c) * c
            union[inside] = mix(acc)
            # a context that the document's ends cut belongs to this anchor alone
            own = (pos[~inside] + lo).astype(_U)
            union[~inside] = mix(own + mix(np.full(len(own), (k ^ e) & (1 << 64) - 1, _U)))
            yield core, union, pos + lo

    def run(batches):
        worker_state("suffix")
        for batch in batches:
            data, off = utf8(batch.column("text"))
            ks, es = batch.column("k").to_numpy(), batch.column("e").to_numpy()
            parts, rows = [], 0
            with np.errstate(over="ignore"):
                for i in range(batch.num_rows):
                    for core, union, pos in of(data[off[i]:off[i + 1]], int(es[i]), int(ks[i])):
                        parts.append((core, union, np.full(len(pos), ks[i]), (np.int64(es[i]) << 32) | pos))
                        rows += len(pos)
                    if rows > 100_000 or (parts and i == batch.num_rows - 1):
                        c, u, k, ep = (np.concatenate(x) for x in zip(*parts))
                        parts, rows = [], 0
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c.view(np.int64)), pa.array(u.view(np.int64)), pa.array(k), pa.array(ep)],
                            names=["core", "u", "k", "ep"])
    return run


_CONTEXT = "core long, hot boolean, lo int, hi int, left int, right int, ctx binary, k long, ep long"
_HALF = _CONTEXT + ", u long"


def _contexts(length: int, q: int):
    reach = length - q

    def run(batches):
        worker_state("suffix")
        for batch in batches:
            data, off = utf8(batch.column("text"))
            need = batch.column("need")
            cols = [[] for _ in range(9)]

            def out():
                types = [pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(),
                         pa.int64(), pa.int64()]
                got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=[x.split()[0] for x in _CONTEXT.split(", ")])
                for c in cols:
                    c.clear()
                return got
            for i in range(batch.num_rows):
                doc = data[off[i]:off[i + 1]].tobytes()
                k = batch.column("k")[i].as_py()
                for one in need[i].as_py():
                    x = one["ep"] & 0xFFFFFFFF
                    left, right = min(reach, x), min(length, len(doc) - x)
                    ctx = b"\0" * (reach - left) + doc[x - left:x + right] + b"\0" * (length - right)
                    for c, v in zip(cols, (one["core"], one["hot"], 0, reach, left, right, ctx, k, one["ep"])):
                        c.append(v)
                if len(cols[0]) > 20_000:
                    yield out()
            if cols[0]:
                yield out()
    return run


def _context_sums(batch, reach: int, length: int, code: np.ndarray) -> np.ndarray:
    """Prefix sums of the contexts of a batch: (rows, reach + length + 1)."""
    size = reach + length
    raw = np.frombuffer(b"".join(batch.column("ctx").to_pylist()), np.uint8).reshape(-1, size)
    total = np.zeros((len(raw), size + 1), _U)
    sums = total[:, 1:]
    sums[...] = code[raw]
    sums *= _power(size + 1)[0][:size]
    np.cumsum(sums, axis=1, out=sums)
    return total


def _finish(length: int, q: int):
    """Refine whole buckets to single offsets: an offset d repeats if the length bytes at anchor - d
    are those of another row of the bucket. Rows arrive sorted by bucket."""
    reach = length - q

    def chunk(t: pa.Table):
        left, right = t.column("left").to_numpy(), t.column("right").to_numpy()
        lo, hi = t.column("lo").to_numpy(), t.column("hi").to_numpy()
        bucket = t.column("core").to_numpy().view(_U)
        far, near = np.full(len(left), -1), np.full(len(left), length)
        with np.errstate(over="ignore"):
            total = _context_sums(t, reach, length, _CODES[1])
            up = _power(reach + length + 1)[1]
            for d in range(reach + 1):
                ok = np.flatnonzero((left >= d) & (right >= length - d) & (lo <= d) & (d <= hi))
                if len(ok) < 2:
                    continue
                a = reach - d
                key = mix((total[ok, a + length] - total[ok, a]) * up[a]) ^ mix(bucket[ok])
                order = np.argsort(key, kind="stable")
                same = key[order[1:]] == key[order[:-1]]
                dup = np.zeros(len(ok), bool)
                dup[order[1:][same]] = True
                dup[order[:-1][same]] = True
                far[ok[dup]] = np.maximum(far[ok[dup]], d)
                near[ok[dup]] = np.minimum(near[ok[dup]], d)
        hit = far >= 0
        x = t.column("ep").to_numpy()[hit]
        return pa.RecordBatch.from_arrays(
            [pa.array(t.column("k").to_numpy()[hit]), pa.array(x >> 32),
             pa.array((x & 0xFFFFFFFF) - far[hit]), pa.array((x & 0xFFFFFFFF) + length - near[hit])],
            names=["k", "e", "start", "stop"])

    def run(batches):
        worker_state("suffix")
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            b = t.column("core").to_numpy()
            cut = int(np.searchsorted(b, b[-1]))  # the last bucket may go on
            if cut >= CHUNK_ROWS:
                yield chunk(t.slice(0, cut).combine_chunks())
                t = t.slice(cut)
            rest = t
        if rest is not None and rest.num_rows:
            yield chunk(rest.combine_chunks())
    return run


def _halves(length: int, q: int):
    """The two halves of each row's offsets, under the bucket refined by what the half shares; u is
    the union bucket of the half."""
    reach = length - q

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            with np.errstate(over="ignore"):
                total = _context_sums(batch, reach, length, _CODES[1])
                lo, hi = batch.column("lo").to_numpy(), batch.column("hi").to_numpy()
                left, right = batch.column("left").to_numpy(), batch.column("right").to_numpy()
                core = batch.column("core").to_numpy().view(_U)
                mid = (lo + hi) // 2
                rows = np.arange(len(lo))
                for side, (a, b) in enumerate(((lo, mid), (mid + 1, hi))):
                    # offsets a..b share [anchor - a, anchor - b + length)
                    i, j = reach - a, reach - b + length
                    ok = (a <= b) & (left >= a) & (right >= length - b)
                    down = _power(len(total[0]))[1]
                    key = mix((total[rows, j] - total[rows, i]) * down[i] + j.astype(_U))
                    key = mix(core * _U(3) + key + _U(side))
                    i, j = reach - b, reach - a + length
                    union = mix((total[rows, j] - total[rows, i]) * down[i] + i.astype(_U))
                    # a union that the document's ends cut belongs to this row alone
                    own = batch.column("k").to_numpy() * 31 + batch.column("ep").to_numpy()
                    union = np.where((left >= b) & (right >= length - a), union, mix(own.view(_U)))
                    part = batch.filter(pa.array(ok))
                    names = part.schema.names
                    new = {"core": pa.array(key[ok].view(np.int64)), "lo": pa.array(a[ok].astype(np.int32)),
                           "hi": pa.array(b[ok].astype(np.int32))}
                    yield pa.RecordBatch.from_arrays(
                        [new.get(n, part.column(n)) for n in names] + [pa.array(union[ok].view(np.int64))],
                        names=[*names, "u"])
    return run


def repeated_substrings(docs: DataFrame, *, length: int = 200, q: int = 64, id_col: str = "doc_id",
                        text_col: str = "text", extra: Sequence[str] = ()) -> DataFrame:
    """One row per input row: doc_id, n_bytes, spans (array of [start, stop) byte ranges, maximal and
    ascending), kept (the bytes outside them). With `extra` also a struct of the columns it names, and
    kept_text, the kept bytes as text without what is left of characters that a cut divides."""
    if not 0 < q < length:
        raise ValueError("q must lie between 0 and length")
    spark = docs.sparkSession
    reach = length - q
    raw = pick(docs, id=id_col, text=text_col)
    passed = []
    if extra:
        raw = docs.select(q_(id_col).alias("id"), q_(text_col).alias("text"), F.struct(*[q_(c) for c in extra]).alias("extra"))
        passed = ["extra"]
    # a row's key: 64 bits in k and 32 in e, of its id and text
    texts = raw.select("id", "text", *passed, F.xxhash64("id", "text").alias("k"),
                       (F.hash("id", "text").cast("long")).alias("e"))

    found = texts.select("k", "e", "text").mapInArrow(_find_anchors(length, q), "core long, u long, k long, ep long")
    repeated = stage(found.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"), "core")
    done(spark)
    cand = stage(found.join(repeated, "core"), "cand")
    done(spark, repeated)

    union = stage(cand.groupBy("core", "u").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "ep")).alias("rep")), "union")
    covered = (cand.join(union.where("n > 1").select("core", "u"), ["core", "u"])
               .select("k", F.shiftright("ep", 32).alias("e"), F.col("ep").bitwiseAND(0xFFFFFFFF).alias("x"))
               .select("k", "e", (F.col("x") - reach).alias("start"), (F.col("x") + length).alias("stop")))
    several = stage(union.groupBy("core").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1"), "several")
    open_ = (union.join(several, "core")
             .select("core", (F.col("classes") > BUCKET_ROWS).alias("hot"), F.col("rep.k").alias("k"), F.col("rep.ep").alias("ep")))
    need = (open_.groupBy("k", F.shiftright("ep", 32).alias("e"))
            .agg(F.collect_list(F.struct("core", "hot", "ep")).alias("need")))
    ctx = stage(texts.select("k", "e", "text").join(need, ["k", "e"])
                .mapInArrow(_contexts(length, q), _CONTEXT), "ctx")
    done(spark, several)

    span = "k long, e long, start long, stop long"
    parts = [covered]
    small, hot = ctx.where("not hot"), ctx.where("hot")
    while True:
        parts.append(stage(small.repartition("core").sortWithinPartitions("core")
                           .mapInArrow(_finish(length, q), span), "spans"))
        done(spark)
        if hot.isEmpty():
            break
        half = stage(hot.mapInArrow(_halves(length, q), _HALF), "half")
        same = stage(half.groupBy("core", "u").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "ep")).alias("rep")), "same")
        x = F.col("ep").bitwiseAND(0xFFFFFFFF)
        parts.append(half.join(same.where("n > 1").select("core", "u"), ["core", "u"])
                     .select("k", F.shiftright("ep", 32).alias("e"), (x - F.col("hi")).alias("start"),
                             (x - F.col("lo") + length).alias("stop")))
        size = stage(same.groupBy("core").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1"), "size")
        more = (half.where("lo < hi").join(same.join(size, "core").select(
            "core", "u", "classes", F.col("rep.k").alias("k"), F.col("rep.ep").alias("ep")), ["core", "u", "k", "ep"])
            .drop("u").withColumn("hot", F.col("classes") > BUCKET_ROWS)
            .select(*[c.split()[0] for c in _CONTEXT.split(", ")]))
        more = stage(more, "more")
        done(spark, size)
        small, hot = more.where("not hot"), more.where("hot")
    spans = parts[0]
    for p in parts[1:]:
        spans = spans.union(p)
    merged = stage(spans.groupBy("k", "e").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "merged")
    done(spark, cand, union, ctx)
    schema = T._parse_datatype_string("doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
    if extra:
        schema = schema.add(raw.schema["extra"]).add("kept_text", "string")
    return (texts.join(merged, ["k", "e"], "left").select(F.col("id").cast("long").alias("id"), "text", "spans", *passed)
            .mapInArrow(_cut, schema))


def _cut(batches):
    worker_state("suffix")
    pair = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    for batch in batches:
        data, off = utf8(batch.column("text"))
        col = batch.column("spans")
        first = np.concatenate([[0], np.cumsum([0 if v is None else v for v in col.value_lengths().to_pylist()])])
        flat = col.flatten()
        start, stop = flat.field("start").to_numpy(), flat.field("stop").to_numpy()
        spans, kept = [], []
        for i in range(batch.num_rows):
            doc = data[off[i]:off[i + 1]]
            # of rows that repeat, contexts that the document's ends cut agree too
            a = np.maximum(start[first[i]:first[i + 1]], 0)
            b = np.minimum(stop[first[i]:first[i + 1]], len(doc))
            if not len(a):
                spans.append([])
                kept.append(doc.tobytes())
                continue
            depth = np.zeros(len(doc) + 1, np.int64)
            np.add.at(depth, a, 1)
            np.add.at(depth, b, -1)
            gone = np.cumsum(depth[:-1]) > 0
            kept.append(doc[~gone].tobytes())
            edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
            spans.append([{"start": s, "stop": t} for s, t in zip(np.flatnonzero(edge > 0).tolist(),
                                                                  np.flatnonzero(edge < 0).tolist())])
        out = {"doc_id": batch.column("id"), "n_bytes": pa.array(np.diff(off)), "spans": pa.array(spans, pa.list_(pair)),
               "kept": pa.array(kept, pa.binary())}
        if "extra" in batch.schema.names:
            out |= {"extra": batch.column("extra"), "kept_text": pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())}
        yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
