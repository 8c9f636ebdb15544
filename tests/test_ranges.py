"""Quoted CSV and JSON arrays read in byte ranges: equal to a plain reader at every cut."""

import csv
import io
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from sluice.sinks.files import write_csv, write_json_array
from sluice.sources import ranges
from sluice.sources.files import csv_types, read_csv, read_json_array
from sluice.sources.ranges import JsonObjects, QuotedLines, Ranges

SCHEMA = "id int, a string, b string"


def folder(**files):
    d = tempfile.mkdtemp()
    for name, text in files.items():
        with open(os.path.join(d, name), "w", newline="", encoding="utf-8") as f:
            f.write(text)
    return d


class small_ranges:
    """Ranges of about so many bytes."""

    def __init__(self, spark, size):
        self.spark, self.size = spark, size

    def __enter__(self):
        self.spark.conf.set("spark.sql.files.maxPartitionBytes", str(self.size))
        self.spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def __exit__(self, *a):
        self.spark.conf.unset("spark.sql.files.maxPartitionBytes")
        self.spark.conf.unset("spark.sql.files.openCostInBytes")


def values(seed, n=60):
    rng = random.Random(seed)
    pool = ["", "plain", 'a "quoted" word', "comma, here", "line\nbreak", "two\n\nbreaks\n", '"', '""', "\n", ",", "é日本😀", " lead", "trail ",
            '",\n"', "x" * 50, "tab\t", "\\", "a\\\"b", "'", "null"]
    return [(i, rng.choice(pool) + rng.choice(pool), rng.choice([None, rng.choice(pool)])) for i in range(n)]


def as_csv(rows, end="\n", header=True):
    out = io.StringIO()
    for row in ([("id", "a", "b")] if header else []) + rows:
        out.write(",".join("" if v is None else str(v) if isinstance(v, int) or (v and not set(v) & set('",\n\r')) else
                           '"' + v.replace('"', '""') + '"' for v in row) + end)
    return out.getvalue()


@pytest.mark.parametrize("end,size", [("\n", 60), ("\r\n", 90), ("\n", 400), ("\r\n", 1 << 20), ("\r", 1 << 20), ("\r", 300)])
def test_csv_at_every_cut(spark, end, size):
    one, two = values(size, 35), values(size + 1, 15)
    if end == "\r":  # a bare carriage return is only found in files without line feeds
        one, two = ([(i, a.replace("\n", "_"), b and b.replace("\n", "_")) for i, a, b in x] for x in (one, two))
    d = folder(a=as_csv(one, end), b=as_csv(two, end), c=as_csv([], end))
    with small_ranges(spark, size):
        df = read_csv(spark, d, SCHEMA)
        got = sorted(map(tuple, df.collect()), key=repr)
        if size < 130:
            assert df.rdd.getNumPartitions() >= 8
        assert got == sorted(one + two, key=repr)
        headless = folder(a=as_csv(one, end, header=False))
        assert sorted(map(tuple, read_csv(spark, headless, SCHEMA, header=False).collect()), key=repr) == sorted(one, key=repr)


def test_csv_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ranges, "BROADCAST_RANGES", 0)
    rows = values(5, 60)
    with small_ranges(spark, 200):
        got = read_csv(spark, folder(a=as_csv(rows)), SCHEMA).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)


@pytest.mark.parametrize("multiline", [True, False])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_line_ends(spark, end, multiline):
    text = end.join(["a,b", "1,2", "3,", '4,"x"', ""])
    inferred = read_csv(spark, folder(f=text), multiline=multiline)
    assert inferred.dtypes == [("a", "int"), ("b", "string")]
    want = [(1, "2"), (3, None), (4, "x")]
    assert sorted(map(tuple, inferred.collect())) == want
    assert sorted(map(tuple, read_csv(spark, folder(f=text), "a int, b string", multiline=multiline).collect())) == want
    numbers = read_csv(spark, folder(f=end.join(["a,b", "1,2"]) + end), multiline=multiline)
    assert numbers.dtypes == [("a", "int"), ("b", "int")] and numbers.first() == (1, 2)


def test_carriage_returns_inside_values(spark):
    text = 'a,b\r\n1,"x\r"\r\n2,"y\r\nz"\r\n3,"\r\n"\r\n'
    assert sorted(map(tuple, read_csv(spark, folder(f=text), "a int, b string").collect())) == [(1, "x\r"), (2, "y\r\nz"), (3, "\r\n")]
    src = spark.createDataFrame([(1, "x\r"), (2, "\r"), (3, "q\r\nr"), (4, "s\rt")], "a int, b string")
    out = tempfile.mkdtemp() + "/c"
    write_csv(src, out)
    assert sorted(read_csv(spark, out, src.schema).collect()) == sorted(src.collect())


def test_quotes_inside_plain_values(spark):
    """A quote opens a value only at its start: others are text, and do not swallow the lines behind."""
    text = 'id,a,b\n1,5" pipe,x\n2,it"s,y"\n3,"q ""r""",z\n'
    for size in (9, 1 << 20):
        with small_ranges(spark, size):
            got = sorted(map(tuple, read_csv(spark, folder(f=text), SCHEMA).collect()))
        assert got == [(1, '5" pipe', "x"), (2, 'it"s', 'y"'), (3, 'q "r"', "z")]


def test_csv_headers(spark):
    with pytest.raises(Exception, match="header"):
        read_csv(spark, folder(a="id,b,a\n1,x,y\n"), SCHEMA).collect()
    with pytest.raises(Exception, match="header"):
        read_csv(spark, folder(a="x,y\n1,2\n", b="y,x\n1,2\n")).collect()
    got = read_csv(spark, folder(a='ID,"a",B\n1,x,y\nid,a,b\n'), "id string, a string, b string").collect()
    assert sorted(map(tuple, got)) == [("1", "x", "y"), ("id", "a", "b")]  # a row like the header is a row
    assert read_csv(spark, folder(a="x,,x\n1,2,3\n")).columns == ["x0", "_c1", "x2"]
    assert read_csv(spark, folder(a='"x\ny",z\n1,2\n')).columns == ["x\ny", "z"]
    assert read_csv(spark, folder(a="id,a,b\n"), SCHEMA).collect() == []
    with pytest.raises(Exception):
        read_csv(spark, folder(a="id,a,b\n1,x\n"), SCHEMA).collect()


def test_csv_inference_in_ranges(spark):
    rows = [(i, f"t\n{i}", i / 4) for i in range(300)]
    text = "id,a,x\n" + "".join(f'{i},"{a}",{x}\n' for i, a, x in rows)
    with small_ranges(spark, 400):
        df = read_csv(spark, folder(f=text))
        assert df.dtypes == [("id", "int"), ("a", "string"), ("x", "double")]
        assert sorted(map(tuple, df.collect())) == rows


TYPED = {  # values of a column -> its type and what breaks the narrower one
    ("1", "-22", "+3", None): ("bigint", None), ("1", "2.50", "-.5"): ("decimal(3,2)", "-.5"), ("1", "1e5", "2.5"): ("double", "1e5"),
    ("9223372036854775808", "1"): ("decimal(19,0)", "9223372036854775808"), ("0.00", "00012"): ("decimal(4,2)", "0.00"),
    ("9" * 39, "1"): ("double", None), ("NaN", "1", "-Infinity"): ("double", "-Infinity"), ("true", "FALSE"): ("boolean", None),
    ("2020-01-02", "2020-1-3"): ("date", None), ("2020-01-02", "2020-01-03 04:05:06"): ("timestamp_ntz", "2020-01-03 04:05:06"),
    ("2020-01-02T03:04:05Z", "2020-01-02 03:04:05+01:00"): ("timestamp", None), ("2020-13-45", "2020-01-01"): ("string", "2020-13-45"),
    ("1", "2", "x"): ("string", "x"), ("true", "1"): ("string", "1"), (None, None): ("null", None), ("", "1"): ("string", ""),
    ("1d", "2"): ("string", "1d"), ("line\nbreak", "b"): ("string", None), ("2020-01-01", "7"): ("string", "7"),
}


@pytest.mark.parametrize("size", [400])
def test_csv_types_however_the_files_are_split(spark, size):
    n = max(map(len, TYPED))
    names = [f"c{i}" for i in range(len(TYPED))]
    rows = [[(list(v) + [v[0]] * n)[i] for v in TYPED] for i in range(n)]

    def cell(v):
        return "" if v is None else '"' + v.replace('"', '""') + '"'
    lines = [",".join(map(cell, r)) + "\n" for r in rows]
    head = ",".join(names) + "\n"
    with small_ranges(spark, size):
        one = csv_types(spark, folder(a=head + "".join(lines))).collect()
        many = csv_types(spark, folder(**{f"f{i}": head + x for i, x in enumerate(reversed(lines))})).collect()
    assert sorted(one) == sorted(many)
    assert [(r.type, r.breaks) for r in sorted(one, key=lambda r: r.position)] == [
        (t, b) for t, b in TYPED.values()]
    assert all(r["values"] + r.nulls == n for r in one)
    assert csv_types(spark, folder(a="")).collect() == []
    assert [(r.column, r.type, r["values"]) for r in csv_types(spark, folder(a="x,y\n")).collect()] == [("x", "null", 0), ("y", "null", 0)]


def objects(seed, n=50):
    rng = random.Random(seed)
    pool = ["", "}", "{", '"', "},{", '\\"', "\\", "]", "[", "é日😀", "a\nb", "\\\\", '"}', "x" * 40, "null"]
    return [{"id": i, "a": rng.choice(pool) + rng.choice(pool), "b": rng.choice([None, {"c": [{"d": rng.choice(pool)}, {"d": "}"}], "e": {}}])}
            for i in range(n)]


NESTED = "id int, a string, b struct<c: array<struct<d: string>>, e: struct<f: int>>"


@pytest.mark.parametrize("size", [120, 1000, 1 << 20])
def test_json_at_every_cut(spark, size):
    one, two = objects(size, 30), objects(size + 1, 12)
    d = folder(a=json.dumps(one), b=json.dumps(two, indent=2, ensure_ascii=False), c="[]", d=" [ ]\n", e="﻿" + json.dumps(one[:1]),
               f=json.dumps(two[0]), g="\n".join(json.dumps(x) for x in two[:3]))
    with small_ranges(spark, size):
        df = read_json_array(spark, d, NESTED)
        got = [r.asDict(recursive=True) for r in df.collect()]
        if size < 130:
            assert df.rdd.getNumPartitions() >= 8
    want = one + two + one[:1] + two[:1] + two[:3]

    def key(x):
        return (x["id"], x["a"], repr([y["d"] for y in x["b"]["c"]] if x["b"] else None))
    assert sorted(map(key, got)) == sorted(map(key, want))


@pytest.mark.parametrize("text", ['[{"id":1},{"id":2}', '[{"id":1},5]', '[{"id":1}] x', '[{"id":1},{"id":', '{"id":1} {"id"', '[{"id":1},null,{"id":2}]'])
@pytest.mark.parametrize("size", [6, 1 << 20])
def test_damaged_json_fails(spark, text, size):
    with small_ranges(spark, size), pytest.raises(Exception):
        read_json_array(spark, folder(a=text), "id int").collect()


def test_json_inference(spark):
    with small_ranges(spark, 300):
        df = read_json_array(spark, folder(a=json.dumps(objects(3, 30))))
        assert dict(df.dtypes)["id"] == "bigint" and df.count() == 30


def test_one_file_is_read_by_many_tasks(spark):
    docs = spark.range(20_000).select(F.col("id"), F.concat(F.lit('line "1"\n'), F.col("id").cast("string"), F.lit(",\n}{")).alias("s"))
    c, j = tempfile.mkdtemp() + "/c", tempfile.mkdtemp() + "/j"
    write_csv(docs.coalesce(1), c)
    write_json_array(docs.coalesce(1), j, rows_per_file=20_000)
    with small_ranges(spark, 64 << 10):
        for df in (read_csv(spark, c, docs.schema), read_json_array(spark, j, docs.schema)):
            assert df.rdd.getNumPartitions() >= 8
            assert df.exceptAll(docs).count() == 0 and df.count() == 20_000


@pytest.mark.parametrize("grammar,alphabet", [(QuotedLines(), 'ab,"\n\r'), (JsonObjects(), '{}[]"\\a:,')])
def test_states_compose(grammar, alphabet):
    """Lexing pieces from each start state, and composing, is lexing from the left (quotes only for CSV)."""
    import pyarrow as pa
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        if isinstance(grammar, JsonObjects):
            text = json.dumps([{"k": text}, {"m": [{"n": text[::-1]}]}])
        else:
            out = io.StringIO()
            csv.writer(out, lineterminator="\n").writerows([[text, "x"], ["y", text[::-1]]])
            text = out.getvalue()[:-1]
        pieces = text.split(grammar.separator)
        at, end, change = grammar.steps(pa.array(pieces, pa.large_string()))
        state = depth = 0
        moves = dict(zip(at.tolist(), zip(end.tolist(), change.tolist())))
        seen = []
        for i in range(len(pieces)):
            e, c = moves.get(i, ([0, 1], [0, 0]))
            depth += c[state]
            state = e[state]
            seen.append((state, depth))
        flag = grammar.first(pieces[0]) if isinstance(grammar, JsonObjects) else 0
        n = sum(grammar.ends(s, d, flag) for s, d in seen)
        assert n == 2 if isinstance(grammar, JsonObjects) else seen[-1][0] == 0
    assert isinstance(Ranges, type)
