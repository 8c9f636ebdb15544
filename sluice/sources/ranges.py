"""Records that may hold their own separator, read by many tasks from one file.

Spark's text source splits a file into byte ranges at any separator, but a line break inside quotes,
or a brace inside a string, ends no record. Which it is depends on all that precedes, back to the
start of the file. `Grammar` says how one piece (the text up to a separator) changes the lexer's state
for each state it may begin in, and such changes compose:

1. Every range is lexed once for all its possible start states; a range comes out as a map of start
   state -> end state (and a change of depth). Files of one range need no such pass.
2. The maps of a file's ranges are composed in file order (one small row for each range), which gives
   the true start state of each.
3. Every range is read again from its start state and cut into records. What precedes its first record
   boundary and what follows its last one are fragments; they are joined across ranges.

Step 1 runs when the read is planned, steps 2 and 3 when the result is used; the fragments take a
scan of their own, only if a range starts inside a record. A task holds one record and one Arrow
batch. The start states are a row for each range of at least some MB; they are broadcast while
they are few, and joined by a shuffle with a sort by position beyond.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

#: Ranges whose start states are broadcast (24 bytes each).
BROADCAST_RANGES = 500_000
#: Bytes of pieces that a task lexes and cuts at a time, and bytes of its Arrow batches, in and out (unless one
#: piece or record is longer).
STEP_BYTES, BATCH_BYTES = 1 << 20, 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_START = "file long, block long, state int, depth long, flag int, last boolean"
_COMPLETE, _HEAD, _MIDDLE, _TAIL = range(4)


class Grammar:
    """How pieces change the state, for states 0 (between records, or in one outside quotes) to states - 1."""

    separator = "\n"
    states = 2

    #: Whether `first` looks at the first record of a file, or else at its first piece.
    by_record = False

    def first(self, text: str) -> int:
        """What the beginning of a file says about the whole file."""
        return 0

    def steps(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(indexes of the pieces that may change anything, their end states and depth changes for each start
        state); separators included."""
        raise NotImplementedError

    def ends(self, state: int, depth: int, flag: int) -> bool:
        """Whether a record is complete behind a piece."""
        return state == 0

    def record(self, text: str, flag: int) -> str | None:
        """A record from its pieces, joined by separators; None if it is none."""
        return text

    def leftover(self, text: str, flag: int, open_array: bool) -> str | None:
        """What the end of a file leaves, as a record; raises if it may not be there."""
        return self.record(text, flag)


class QuotedLines(Grammar):
    """Lines of separated values: quotes open at the start of a value, and double inside. Records end at line
    breaks outside quotes: \\n, \\r\\n (if the file's first record ends so), or \\r (if it holds one)."""

    by_record = True

    def __init__(self, sep: str = ","):
        s = re.escape(sep)
        field = rf'(?:"(?:[^"]|"")*"(?:[^"{s}][^{s}]*)?|[^"{s}][^{s}]*)?'
        inside, closed = '(?:[^"]|"")*', rf'(?:[^"]|"")*"(?:[^"{s}][^{s}]*)?'
        self.opens = rf'^(?:{field}{s})*"{inside}$'
        self.stays = rf'^(?:{inside}|{closed}(?:{s}{field})*{s}"{inside})$'
        self.plain = re.compile(rf'(?s)\A(?:{field}{s})*{field}\Z')
        self.bare_cr = re.compile(r'[^"\r]*(?:"[^"]*"[^"\r]*)*(?:\r|\Z)')

    def first(self, text: str) -> int:
        if "\r" in re.sub(r'"[^"]*"', "", text[:-1]):
            return 2
        return int(text.endswith("\r"))

    def steps(self, pieces: pa.Array):
        at = np.flatnonzero(pc.match_substring(pieces, '"').to_numpy(zero_copy_only=False))
        some = pieces.take(pa.array(at))
        end = np.stack([pc.match_substring_regex(some, p).to_numpy(zero_copy_only=False) for p in (self.opens, self.stays)], axis=1)
        return at, end.astype(np.int64), np.zeros_like(end, np.int64)

    def record(self, text: str, flag: int) -> str | None:
        if flag == 1 and text.endswith("\r"):
            text = text[:-1]
        return text or None


class JsonObjects(Grammar):
    """Objects of an array (or side by side), cut behind the brace that closes them. Flag 1: an array."""

    separator = "}"

    def first(self, text: str) -> int:
        return int(text.lstrip("\ufeff \t\r\n").startswith("["))

    def steps(self, pieces: pa.Array):
        bare = pc.replace_substring_regex(pieces, r"(?s)\\.", "")
        odd = pc.bit_wise_and(pc.count_substring(bare, '"'), 1).to_numpy()
        n = len(pieces)
        end, depth = np.empty((n, 2), np.int64), np.empty((n, 2), np.int64)
        for start in (0, 1):
            text = pc.binary_join_element_wise(pa.scalar('"', bare.type), bare, pa.scalar("", bare.type)) if start else bare
            outside = pc.replace_substring_regex(text, r'"[^"]*(?:"|$)', "")
            end[:, start] = odd ^ start
            depth[:, start] = (pc.count_substring(outside, "{").to_numpy().astype(np.int64) + pc.count_substring(outside, "[").to_numpy()
                               - pc.count_substring(outside, "]").to_numpy()) - (end[:, start] == 0)
        return np.arange(n), end, depth

    def ends(self, state: int, depth: int, flag: int) -> bool:
        return state == 0 and depth == flag

    def record(self, text: str, flag: int) -> str | None:
        return text.lstrip("\ufeff[, \t\r\n") + "}"

    def leftover(self, text: str, flag: int, open_array: bool) -> str | None:
        rest = text.strip("\ufeff \t\r\n")
        if rest not in (("]", "[]") if flag else ("",)) and re.sub(r"\s", "", rest) != "[]":
            raise ValueError(f"JSON text that is no object of the array: {rest[:200]!r}")
        return None


# --- ranges -------------------------------------------------------------------------------

def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """((file, block), from, to) of the rows of one range, at most STEP_BYTES of text (or one row) at a time: what is
    lexed and cut is held several times over."""
    if not batch.num_rows:
        return
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    edge = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column("value")), 0).to_numpy(), dtype=np.int64)
    for a, b in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows]):
        key = (int(file[a]), int(block[a]))
        while a < b:
            before = int(upto[a - 1]) if a else 0
            to = min(b, max(a + 1, int(np.searchsorted(upto, before + STEP_BYTES, "right"))))
            yield key, a, to
            a = to


def _strings(batch: pa.RecordBatch, a: int, b: int) -> pa.Array:
    return batch.column("value").slice(a, b - a).cast(pa.large_string())


def _walk(grammar: Grammar, steps, n: int, state: int, depth: int, flag: int) -> tuple[np.ndarray, int, int]:
    """Whether a record ends behind each of n pieces, and the state and depth behind them all."""
    at, end, change = steps
    ended = np.ones(n, bool)
    if len(at) or not grammar.ends(state, depth, flag):
        # states change at few pieces; between them every piece ends alike
        done = 0
        for i, e, c in zip(at.tolist(), end.tolist(), change.tolist()):
            ended[done:i] = grammar.ends(state, depth, flag)
            depth += c[state]
            state = e[state]
            ended[i] = grammar.ends(state, depth, flag)
            done = i + 1
        ended[done:] = grammar.ends(state, depth, flag)
    return ended, state, depth


def _summarise(grammar: Grammar):
    def run(batches):
        key, ends, depth, flag, begun = None, [], [], 0, None

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]]), pa.array([key[1]]), pa.array([ends], pa.list_(pa.int32())), pa.array([depth], pa.list_(pa.int64())),
                 pa.array([flag], pa.int32())], names=["file", "block", "ends", "depth", "flag"])
        for batch in batches:
            for k, a, b in _runs(batch):
                if k != key:
                    if key is not None:
                        yield out()
                    key, ends, depth, flag = k, list(range(grammar.states)), [0] * grammar.states, 0
                    begun = [] if k[1] == 0 else None  # pieces of the first record, until it ends
                pieces = _strings(batch, a, b)
                _, end, change = steps = grammar.steps(pieces)
                if begun is not None and not grammar.by_record:
                    flag, begun = grammar.first(pieces[0].as_py()), None
                elif begun is not None:
                    ended = np.flatnonzero(_walk(grammar, steps, b - a, ends[0], depth[0], 0)[0])
                    begun += pieces.slice(0, int(ended[0]) + 1 if len(ended) else b - a).to_pylist()
                    if len(ended):
                        flag, begun = grammar.first(grammar.separator.join(begun)), None
                for e, c in zip(end.tolist(), change.tolist()):
                    for i, s in enumerate(ends):
                        ends[i] = e[s]
                        depth[i] += c[s]
        if key is not None:
            yield out()
    return run


def _compose(states: int):
    """Start state of every range, from the maps of the ranges of each file in file order."""
    def run(batches):
        file, state, depth, flag, held = None, 0, 0, 0, None

        def out(row, last):
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                (*row, last), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()))],
                names=["file", "block", "state", "depth", "flag", "last"])
        for batch in batches:
            for r in batch.to_pylist():
                if r["file"] != file:
                    if held is not None:
                        yield out(held, True)
                    file, state, depth, flag, held = r["file"], 0, 0, r["flag"], None
                if held is not None:
                    yield out(held, False)
                held = (file, r["block"], state, depth, flag)
                depth += r["depth"][state]
                state = r["ends"][state]
        if held is not None:
            yield out(held, True)
    return run


def _cut(grammar: Grammar, whole: bool, header: Callable[[str], bool] | None, firsts: bool):
    """Records and fragments of the ranges, from their start states. whole: a range is a file; firsts: only
    the first record of each file."""
    sep = grammar.separator

    def run(batches):
        key = state = depth = flag = last = None
        parts: list[str] = []      # of the record that is open
        inside = complete = False  # whether the range began inside a record; whether one ended since
        wants_header = False
        texts, kinds, places = [], [], []

        def put(kind: int, text: str | None):
            nonlocal wants_header
            if text is None:
                return
            if wants_header and kind == _COMPLETE:
                wants_header = False
                if not firsts and not header(text):
                    return
            elif firsts:
                return
            texts.append(text)
            kinds.append(kind)
            places.append(key)

        def close():
            """The range is over."""
            nonlocal parts
            if key is None:
                return
            if inside and not complete:
                put(_MIDDLE, sep.join(parts) + ("" if last else sep))
            elif parts and last:
                put(_COMPLETE, grammar.leftover(sep.join(parts), flag, False))
            elif parts:
                put(_TAIL, sep.join(parts) + sep)
            elif last and flag and isinstance(grammar, JsonObjects):
                raise ValueError("a JSON array does not end")
            parts = []

        def out():
            got = pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int64()),
                 pa.array(kinds, pa.int32()), pa.array(texts, pa.string())], names=["file", "block", "kind", "value"])
            for c in (texts, kinds, places):
                c.clear()
            return got
        for batch in batches:
            for k, a, b in _runs(batch):
                if k != key:
                    close()
                    key = k
                    if whole:
                        state, depth, last = 0, 0, True
                        flag = None if grammar.by_record else grammar.first(batch.column("value")[a].as_py())
                    else:
                        state, depth, flag, last = (batch.column(c)[a].as_py() for c in ("state", "depth", "flag", "last"))
                    inside, complete = k[1] > 0 and not grammar.ends(state, depth, flag), False
                    wants_header = (firsts or header is not None) and k[1] == 0
                pieces = _strings(batch, a, b)
                ended, state, depth = _walk(grammar, grammar.steps(pieces), b - a, state, depth, flag or 0)
                values = pieces.to_pylist()
                from_ = 0
                for i in np.flatnonzero(ended).tolist():
                    text = values[i] if not parts and i == from_ else sep.join([*parts, *values[from_:i + 1]])
                    parts, from_ = [], i + 1
                    if flag is None:
                        flag = grammar.first(text)
                    if inside and not complete:
                        put(_HEAD, text)
                    elif flag == 2 and isinstance(grammar, QuotedLines):
                        for one in grammar.bare_cr.findall(text):
                            put(_COMPLETE, grammar.record(one.rstrip("\r"), 0) if one else None)
                    else:
                        put(_COMPLETE, grammar.record(text, flag))
                    complete = True
                parts += values[from_:]
                if len(texts) > 2000 or sum(map(len, texts)) > BATCH_BYTES:
                    yield out()
        close()
        if texts:
            yield out()
    return run


def _join_fragments(grammar: Grammar):
    """Records that span ranges, from the fragments of each file in file order."""
    def run(batches):
        file, parts = None, []

        def done(flag):
            text = "".join(parts)
            parts.clear()
            return grammar.record(text, flag)
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                if r["file"] != file:
                    if parts:
                        found.append(grammar.leftover("".join(parts), r["flag"], True))
                        parts.clear()
                    file = r["file"]
                parts.append(r["value"])
                if r["kind"] == _HEAD or (r["kind"] == _MIDDLE and r["last"]):
                    found.append(done(r["flag"]))
            yield pa.RecordBatch.from_arrays([pa.array([f for f in found if f is not None], pa.string())], names=["value"])
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([grammar.leftover("".join(parts), 0, True)], pa.string())], names=["value"])
    return run


def _one_range_each(spark: SparkSession, path) -> bool:
    """Whether no file is larger than the smallest split that Spark makes (file sizes only)."""
    longest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
    limits = [spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes(),
              spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()]
    return longest <= min(limits)


class Ranges:
    """The records of files, by their ranges; the start states are found once."""

    def __init__(self, spark: SparkSession, path: str | list[str], grammar: Grammar):
        ship_package(spark)
        if spark.conf.get(_BATCH_CONF, None) is None:
            spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
        self.grammar = grammar
        text = spark.read.option("lineSep", grammar.separator).text(path)
        self.pieces = text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
        self.starts = None
        if _one_range_each(spark, path):
            return
        where = scratch_path(spark, "ranges")
        summary = self.pieces.mapInArrow(_summarise(grammar), "file long, block long, ends array<int>, depth array<long>, flag int")
        (summary.repartition("file").sortWithinPartitions("file", "block").mapInArrow(_compose(grammar.states), _START)
         .write.parquet(where))
        self.starts = spark.read.schema(_START).parquet(where)
        self.few = self.starts.count() <= BROADCAST_RANGES

    def _near(self, df: DataFrame) -> DataFrame:
        """Broadcast while it is small."""
        return F.broadcast(df) if self.few else df.hint("merge")

    def placed(self, more: DataFrame | None = None) -> DataFrame:
        """The pieces with the start of their range (and more columns of it), in the order of each range."""
        starts = self.starts if more is None else self.starts.join(more, ["file", "block"])
        if self.few:
            return self.pieces.join(F.broadcast(starts), ["file", "block"])
        return (self.pieces.withColumn("at", F.monotonically_increasing_id()).join(starts.hint("merge"), ["file", "block"])
                .repartition("file", "block").sortWithinPartitions("file", "block", "at"))

    def _cut(self, header: Callable[[str], bool] | None, firsts: bool = False) -> DataFrame:
        cut = _cut(self.grammar, self.starts is None, header, firsts)
        cols = [*self.pieces.columns] if self.starts is None else ["file", "block", "state", "depth", "flag", "last", "value"]
        rows = self.pieces if self.starts is None else self.placed()
        return rows.select(*cols).mapInArrow(cut, "file long, block long, kind int, value string")

    def first_record(self) -> str | None:
        """The first record of one of the files."""
        got = self._cut(None, firsts=True).select("value").limit(1).collect()
        return got[0]["value"] if got else None

    def records(self, header: Callable[[str], bool] | None = None) -> DataFrame:
        """value: every record of the files, in any order.

        header: is shown the first record of each file and says whether it is a record at all."""
        out = self._cut(header)
        whole = out.where(F.col("kind") == _COMPLETE).select("value")
        if self.starts is None:
            return whole
        begun = self.starts.where("block > 0").select("state", "depth", "flag").distinct().collect()  # depths in one record are few
        if all(self.grammar.ends(r["state"], r["depth"], r["flag"]) for r in begun):
            return whole
        fragments = out.where(F.col("kind") != _COMPLETE).join(
            self._near(self.starts.select("file", "block", "flag", "last")), ["file", "block"])
        joined = (fragments.repartition("file").sortWithinPartitions("file", "block", "kind")
                  .mapInArrow(_join_fragments(self.grammar), "value string"))
        return whole.union(joined)
