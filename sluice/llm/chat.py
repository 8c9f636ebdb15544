"""Quotation linking: nested quotes are parsed, linked to the messages they quote, and removed.

All of it is DataFrame functions. A message is a row of (conversation, turn, role, text). A
line that begins with quote marks ('>', blanks between them allowed) has the level of their
number. Consecutive lines of the same level of 1 or more form a quoted passage; consecutive
lines of level 0 form own text. A passage is normalised (marks off, lower case, white space
runs to one blank, trimmed) and hashed; so are, of every message, its own text as a whole, its
paragraphs and its lines. A passage's paragraphs and lines are looked up too, so that a shortened
or re-wrapped quotation still finds its source. The join on (conversation, hash) links a passage to earlier messages
of the same conversation; the latest of them is the source, a whole passage before a
paragraph before a single line. The parent of a message is the source of its lowest-level passage that has one (of several
the first in the text), its depth and root follow the parents. The sources of all passages are
kept, nested ones too.

A message is written without its quotes. Replies come after what they answer: a conversation is
ordered by thread (root turn), then turn, and `position` counts from 1.

Scale: joins are on (conversation, hash) and only passages that exist take part, so a first turn
that many conversations share, or a conversation that holds a third of all rows, makes no hot
group beyond equal passages within one conversation, and those are pre-aggregated to one row.
Roots are found by pointer jumping (rounds grow with the logarithm of the longest chain); the
order is a range partitioning (no window over a conversation).

Defined cases: null text is empty. A null conversation or turn links to nothing and has no
position order of its own beyond the sort (nulls first). Rows repeated for one turn all get the
turn's parent and what is found for a passage's place; each has its own position. Extra columns are ignored. A quotation without a
source stays without one; its text is removed all the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import with_row_number
from .common import pick, stage

_MARKS = r"^[ \t]*(?:>[ \t]*)+"
_QUOTE = r"(?md)^[ \t]*>"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _key(text: Column) -> Column:
    """128-bit hash of a normalised passage, null for an empty one."""
    n = normalised(text)
    return F.when(n != "", F.md5(n.cast("binary")))


def _lines(text: Column) -> Column:
    """array of (level, body) by line; a carriage return at a line's end is not part of it."""
    def one(line: Column) -> Column:
        marks = F.regexp_extract(line, _MARKS, 0)
        level = F.char_length(marks) - F.char_length(F.replace(marks, F.lit(">"), F.lit("")))
        return F.struct(level.alias("level"), F.substr(line, F.char_length(marks) + 1).alias("body"))
    return F.transform(F.split(F.regexp_replace(text, "\r\n", "\n"), "\n"), one)


def _run_starts(lines: Column) -> Column:
    """array of (at, level): where maximal runs of lines of one level begin."""
    marked = F.transform(lines, lambda x, i: F.when((i == 0) | (F.get(lines, i - 1).level != x.level),
                                                    F.struct(i.alias("at"), x.level.alias("level"))))
    return F.filter(marked, lambda s: s.isNotNull())


def _runs(lines: Column, starts: Column) -> Column:
    """array of (level, text) of the runs, each cut out of the lines once."""
    def one(s: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(starts, k + 1).at, F.size(lines))
        body = F.transform(F.slice(lines, s.at + 1, stop - s.at), lambda x: x.body)
        return F.struct(s.level.alias("level"), F.array_join(body, "\n").alias("text"))
    return F.transform(starts, one)


def parse(messages: DataFrame) -> DataFrame:
    """Adds own (text without quotes) and passages (array of (level, text)) to rows with a text."""
    quoting = F.col("text").rlike(_QUOTE)
    none = F.array().cast("array<struct<level: int, text: string>>")
    df = messages.withColumn("lines", F.when(quoting, _lines(F.col("text"))))
    df = df.withColumn("starts", _run_starts(F.col("lines")))
    df = df.withColumn("runs", F.coalesce(_runs(F.col("lines"), F.col("starts")), none))
    own = F.array_join(F.transform(F.filter("runs", lambda r: r.level == 0), lambda r: r.text), "\n")
    own = F.when(quoting, F.trim(F.regexp_replace(own, r"^\s+|\s+$", ""))).otherwise(F.col("text"))
    return df.select(*messages.columns, own.alias("own"), F.filter("runs", lambda r: r.level > 0).alias("passages"))


def _links(parsed: DataFrame) -> DataFrame:
    """(conv, turn, parent, from_of): of each quoting turn the source that it answers, and the source of each of its
    passages (place -> turn), where one is found."""
    known = parsed.where("conv is not null and turn is not null")
    passages = stage(known.where(F.size("passages") > 0)
                     .select("conv", "turn", F.posexplode("passages").alias("at", "p")), "passages")
    wanted = passages.select("conv", "turn", "at", F.col("p.level").alias("level"), F.explode(F.concat(
        F.array(F.struct(F.lit(0).alias("part"), F.col("p.text").alias("text"))),
        F.transform(F.split("p.text", r"\n[ \t]*\n"), lambda x: F.struct(F.lit(1).alias("part"), x.alias("text"))),
        F.transform(F.split("p.text", "\n"), lambda x: F.struct(F.lit(2).alias("part"), x.alias("text"))))).alias("x"))
    wanted = (wanted.select("conv", "turn", "at", "level", "x.part", _key(F.col("x.text")).alias("key"))
              .where("key is not null").distinct())
    # only conversations with a quotation have their messages hashed
    quoting = stage(passages.select("conv").distinct(), "quoting")
    parts = F.array_distinct(F.concat(F.array("own"), F.split("own", r"\n[ \t]*\n"), F.split("own", "\n")))
    source = (known.select("conv", "turn", "own").join(quoting, "conv", "left_semi")
              .select("conv", F.col("turn").alias("from"), F.explode(parts).alias("text"))
              .select("conv", "from", _key(F.col("text")).alias("key")).where("key is not null").distinct())
    found = (wanted.join(source, ["conv", "key"]).where(F.col("from") < F.col("turn"))
             .groupBy("conv", "turn", "at", "level", "part").agg(F.max("from").alias("from")))
    passage = found.groupBy("conv", "turn", "at").agg(
        F.min(F.struct("level", "part", (-F.col("from")).alias("minus"))).alias("b"))
    best = F.min(F.struct("b.level", "at", "b.part", "b.minus"))
    sources = F.map_from_entries(F.collect_list(F.struct("at", -F.col("b.minus"))))
    return stage(passage.groupBy("conv", "turn").agg(best.alias("b"), sources.alias("from_of"))
                 .select("conv", "turn", (-F.col("b.minus")).alias("parent"), "from_of"), "links")


def _threads(links: DataFrame) -> DataFrame:
    """(conv, turn, parent, root, depth) of every linked turn, by pointer jumping."""
    now = stage(links.select("conv", "turn", "parent", F.col("parent").alias("root"), F.lit(1).alias("depth")), "threads")
    while True:
        up = now.select("conv", F.col("turn").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        new = stage(now.join(up, ["conv", "root"], "left").select(
            "conv", "turn", "parent", F.coalesce("above", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("above").isNotNull().alias("moved")), "threads")
        now = new.drop("moved")
        if new.where("moved").isEmpty():
            return now


def link_quotations(messages: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, parent_turn (null: none), root_turn, depth, position,
    n_quotes (quoted passages), sources (the turn that each passage quotes, in their order, joined by
    commas; '-' where none is found), text (without quotes)."""
    rows = pick(messages, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    rows = rows.select(F.col("conv").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), "role",
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    parsed = parse(rows)
    links = _links(parsed)
    threads = _threads(links).join(links.select("conv", "turn", "from_of"), ["conv", "turn"])
    sources = F.array_join(F.transform("passages", lambda p, i: F.coalesce(
        F.when(F.col("from_of").isNotNull(), F.element_at("from_of", i)).cast("string"), F.lit("-"))), ",")
    out = (parsed.join(threads, ["conv", "turn"], "left")
           .select(F.col("conv").alias("conv_id"), "turn", "role", F.col("parent").alias("parent_turn"),
                   F.coalesce("root", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
                   F.size("passages").alias("n_quotes"), sources.alias("sources"), F.col("own").alias("text")))
    numbered = stage(with_row_number(out, ["conv_id", "root_turn", "turn", "role"], "nr"), "ordered")
    first = numbered.groupBy("conv_id").agg(F.min("nr").alias("first"))
    first = first.withColumnRenamed("conv_id", "c")
    return (numbered.join(first, F.col("conv_id").eqNullSafe(F.col("c")))
            .select("conv_id", "turn", "role", "parent_turn", "root_turn", "depth",
                    (F.col("nr") - F.col("first") + 1).alias("position"), "n_quotes", "sources", "text"))
