"""Extended INSERT lines of any length, read by many tasks.

`read_sql_dump` reads a dump by lines or statements, so one INSERT of a gigabyte is one record of
one task. Here a dump is split at `),(`, which stands between the rows of an INSERT and may also stand
inside a quoted value; `sources/ranges.py` finds out which. A group is the text between two such
row boundaries: most groups are one row; one that holds the end of a statement goes on with all
that follows, up to the first row of the next INSERT.

1. Start states of the ranges (`Ranges`): outside, in one of three quotes, or in a comment.
2. Of every range: the text before its first row boundary and behind its last, and the head of the
   INSERT that is open at its end (`INSERT INTO t (a, b) VALUES`), if one begins in it. These few
   strings are put together in file order: groups that span ranges, and each range's head.
3. Every range is read again; runs of its groups, with their head in front, are records of whole
   statements, which the dump reader parses, classifies and checks like any others.

A task holds one group, one Arrow batch (of bounded bytes) and a step of it several times over. Text without `),(` is one group however long, so dumps
of one row for each INSERT are for the reader by lines.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .ranges import BATCH_BYTES, Grammar, Ranges, _runs, _strings, _walk

#: Characters of rows that are joined to one record.
RECORD_CHARS = 1 << 16
SEPARATOR = "),("

_OPENERS = ("", "'", '"', "`", "-- ", "/*")
# A quoted text or comment that the text ends in (named by its state), or one that is closed.
_TOKEN = re.compile(r"""(?s)(?P<s1>'(?:[^'\\]++|\\.)*+\\?+\Z)|'(?:[^'\\]++|\\.)*+'|(?P<s2>"(?:[^"\\]++|\\.)*+\\?+\Z)|"(?:[^"\\]++|\\.)*+"
    |(?P<s3>`[^`]*+\Z)|`[^`]*+`|(?P<s4>(?:\#|--(?=[ \t\r]))[^\n]*+\Z)|(?:\#|--(?=[ \t\r\n]))[^\n]*+\n|(?P<s5>/\*(?:[^*]|\*(?!/))*+\Z)|/\*.*?\*/""", re.X)
_END = re.compile(r";")
_COMMENT = re.compile(r"(?s)\A(?:\s++|--(?:[ \t\r][^\n]*+)?+(?:\n|\Z)|#[^\n]*+(?:\n|\Z)|/\*(?!!).*?\*/)*+")
_HEAD = re.compile(r"(?i)(?:INSERT|REPLACE)\s+(?:(?:LOW_PRIORITY|DELAYED|HIGH_PRIORITY|IGNORE)\s+)*(?:INTO\s+)?"
                   r"(?:(?:`[^`]+`|[^`\s.(]+)\s*\.\s*)?(?:`[^`]+`|[^`\s.(]+)\s*(?:\([^)]*\))?\s*VALUES?\s*(?=\()")
_PROGRAM = re.compile(r"(?is)\bCREATE\b[^;(]*?\b(?:TRIGGER|PROCEDURE|FUNCTION|EVENT)\b")


def lex(text: str, state: int) -> int:
    """The state behind a text that begins in a state."""
    last = None
    for m in _TOKEN.finditer(_OPENERS[state] + text):
        last = m
    return int(last.lastgroup[1]) if last is not None and last.lastgroup else 0


class DumpRows(Grammar):
    """Groups between `),(` outside quotes and comments. States: 0 outside, 1 ', 2 ", 3 `, 4 line comment, 5 comment."""

    separator = SEPARATOR
    states = 6

    def steps(self, pieces: pa.Array):
        bare = pc.replace_substring_regex(pieces, r"(?s)\\.", "")
        odd = pc.bit_wise_and(pc.count_substring(bare, "'"), 1).to_numpy().astype(bool)
        special = pc.match_substring_regex(pieces, r"[\"`#\n]|--|/\*|\*/").to_numpy(zero_copy_only=False)
        at = np.flatnonzero(odd | special)
        end = np.tile(np.arange(6), (len(at), 1))
        end[:, 0], end[:, 1] = odd[at], 1 - odd[at].astype(np.int64)
        for i in np.flatnonzero(special[at]).tolist():
            text = pieces[int(at[i])].as_py()
            end[i] = [lex(text, s) for s in range(6)]
        return at, end, np.zeros_like(end)


def open_head(group: str, head: str | None) -> str | None:
    """The INSERT head that is open behind a group ("" if none is), given the one before it (None at the
    start of a file)."""
    if head is not None and ";" not in group:
        return head
    masked = _TOKEN.sub(lambda m: " " * len(m.group()), group)
    if _PROGRAM.search(masked):
        raise ValueError("stored programs in a dump are not read by long_lines=True")
    at = masked.rfind(";") + 1
    if head is not None and not at:
        return head
    rest = group[at:]
    rest = rest[_COMMENT.match(rest).end():]
    m = _HEAD.match(rest)
    return m.group() if m else ""


def _in_front(head: str | None) -> str:
    if head == "":
        raise ValueError("rows of no INSERT in the dump: '),(' stands outside of VALUES lists")
    return "" if head is None else head + "("


class _Range:
    """What one range holds: the text before its first boundary (if it begins inside a group), groups, and the
    text behind its last boundary. `end` says what a group at the end of the file is."""

    def __init__(self, key, info, whole: bool):
        self.key, self.info, self.last = key, info, whole or info["last"]
        self.inside = not whole and info["state"] != 0
        self.state, self.parts, self.held = (0 if whole else info["state"]), [], None

    def pieces(self, grammar: Grammar, pieces: pa.Array):
        """Complete groups, one late: the last one of a file has no separator behind it."""
        ended, self.state, _ = _walk(grammar, grammar.steps(pieces), len(pieces), self.state, 0, 0)
        values, a = pieces.to_pylist(), 0
        for i in np.flatnonzero(ended).tolist():
            text = SEPARATOR.join([*self.parts, *values[a:i + 1]])
            self.parts, a = [], i + 1
            if self.held is not None:
                yield self.held
            self.held = text
        self.parts += values[a:]

    def end(self) -> tuple[str | None, str | None]:
        """(last complete group, open text): of the file's last range the group that ends the file is open."""
        rest = SEPARATOR.join(self.parts) + ("" if self.last else SEPARATOR) if self.parts else None
        if self.last and rest is None:
            return None, self.held
        return self.held, rest


def _each_range(batches, whole: bool, grammar: Grammar):
    """(range, its groups so far, whether it is over); the first group of a range that begins inside one is the rest
    of that group."""
    now = None
    for batch in batches:
        for k, a, b in _runs(batch):
            if now is not None and k != now.key:
                yield now, (), True
                now = None
            if now is None:
                info = {} if whole else {c: batch.column(c)[a].as_py() for c in batch.schema.names if c not in ("file", "block", "value")}
                now = _Range(k, info, whole)
            yield now, now.pieces(grammar, _strings(batch, a, b)), False
    if now is not None:
        yield now, (), True


_PART = "file long, block long, last boolean, before string, behind string, head string, broken boolean"


def _parts(batches):
    """Step 2: before (NULL: the range begins at a boundary), behind (NULL: it ends at one), head (NULL: the one
    before goes on), broken (whether a boundary is in it)."""
    grammar, now = DumpRows(), None
    for part, groups, over in _each_range(batches, False, grammar):
        if part is not now:
            now, before, head, any_, known = part, None, None, not part.inside, (None if part.key[1] == 0 else "?")

        def see(text):
            nonlocal before, head, any_, known
            if part.inside and not any_:
                before, any_ = text, True
                return
            new = open_head(text, known)
            if new != known or ";" in text and new != "?":
                head = new
            known = new
        for text in groups:
            see(text)
        if over:
            done, rest = part.end()
            if done is not None:
                see(done)
            if part.last and not (part.inside and not any_):
                rest = None  # the range's own last group
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                (*part.key, part.last, before, rest, head, any_),
                (pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.bool_()))],
                names=[x.split()[0] for x in _PART.split(", ")])


_HEADS = "file long, block long, head string, value string"


def _put_together(batches):
    """The head in front of each range, and (value) the records of groups that span ranges, from the parts of each
    file in file order."""
    file, head, carry = object(), None, None
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if r["file"] != file:
                file, head, carry = r["file"], None, None
            if carry is not None:
                if not r["broken"]:
                    carry += r["behind"] or ""
                    if r["last"]:  # the file ends in this group
                        rows.append((r["file"], r["block"], None, _in_front(head) + carry))
                        carry = None
                    rows.append((r["file"], r["block"], head, None))
                    continue
                # `before` is NULL where the separator alone was missing
                group = carry + (r["before"] or "")
                rows.append((r["file"], r["block"], None, _in_front(head) + group + ");"))
                head = open_head(group, head)
            rows.append((r["file"], r["block"], head, None))
            if r["head"] is not None:
                head = r["head"]
            carry = r["behind"]
        cols = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                         names=["file", "block", "head", "value"])


def _records(whole: bool):
    """Step 3: records of whole statements from the complete groups of each range."""
    def run(batches):
        grammar, now, out = DumpRows(), None, []
        rows: list[str] = []
        size = 0

        def flush(end: str = ");"):
            nonlocal size
            if rows:
                out.append(_in_front(head) + SEPARATOR.join(rows) + end)
                rows.clear()
                size = 0

        def see(text: str):
            nonlocal head, size, skip
            if skip:  # the rest of a group that began before the range
                skip = False
                return
            new = open_head(text, head)
            rows.append(text)
            size += len(text)
            if new != head or size > RECORD_CHARS:
                flush()
            head = new
        for part, groups, over in _each_range(batches, whole, grammar):
            if part is not now:
                now, head, skip = part, None if whole else part.info["head"], part.inside
            for text in groups:
                see(text)
            if over:
                done, rest = part.end()
                if done is not None:
                    see(done)
                if part.last and rest is not None and not skip:
                    open_head(rest, head)  # refuses what it cannot read
                    rows.append(rest)
                    flush("")
                flush()
            if sum(map(len, out)) > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
    return run


def statement_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value: records of whole statements with all rows of the dump files."""
    ranges = Ranges(spark, path, DumpRows())
    if ranges.starts is None:
        return ranges.pieces.mapInArrow(_records(True), "value string")
    where = scratch_path(spark, "dump-heads")
    parts = ranges.placed().select("file", "block", "state", "last", "value").mapInArrow(_parts, _PART)
    parts.repartition("file").sortWithinPartitions("file", "block").mapInArrow(_put_together, _HEADS).write.parquet(where)
    found = spark.read.schema(_HEADS).parquet(where)
    heads = found.where("value is null").select("file", "block", "head")
    own = ranges.placed(heads).select("file", "block", "state", "last", "head", "value").mapInArrow(_records(False), "value string")
    return own.union(found.where("value is not null").select("value"))
