"""Stored numbers, skew joins, cast loss and changed partitions."""

import datetime
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StringType,
                               StructField, StructType)

from sluice.operators.castloss import REASONS, align_with_quarantine, cast_loss
from sluice.operators.schema import align_to
from sluice.operators.skewjoin import _trim, hot_keys, skew_join
from sluice.operators.stored import with_stored_number, zip_stored
from sluice.session import scratch_path, scratch_table
from sluice.sinks.tables import write_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- stored order ---------------------------------------------------------------------------

def stored(spark, n, files, name="id"):
    path = tempfile.mkdtemp() + "/t"
    spark.range(n).repartition(files).select(F.col("id").alias(name), (F.col("id") * 7 % 13).alias(name + "2")).write.parquet(path)
    return path


def read_plainly(path):
    import glob

    import pyarrow.parquet as pq
    return [r for f in sorted(glob.glob(path + "/*.parquet")) for r in pq.read_table(f).to_pylist()]


@pytest.mark.parametrize("files", [1, 7])
def test_stored_numbers(spark, files):
    path = stored(spark, 5000, files)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")  # several ranges of a file
    try:
        got = with_stored_number(spark.read.parquet(path), "nr")
        rows = {r.nr: (r.id, r.id2) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == {i: (r["id"], r["id2"]) for i, r in enumerate(read_plainly(path), 1)}


def test_stored_numbers_exchange_no_row(spark):
    got = with_stored_number(spark.read.parquet(stored(spark, 100, 3)), "nr")
    text = plan(got)
    scan = text[text.index("BroadcastHashJoin"):]
    big = scan.split("BroadcastExchange")[0]  # the side of the rows
    assert "Exchange" not in big and "Sort " not in big


def test_stored_numbers_of_filtered_rows_are_refused(spark):
    df = spark.read.parquet(stored(spark, 100, 1))
    with pytest.raises(Exception, match="filtered"):
        with_stored_number(df.where("id % 2 = 0"), "nr").collect()
    with pytest.raises(ValueError):
        with_stored_number(df, "ID")
    assert with_stored_number(df, "nr").where("nr <= 10").count() == 10


def test_stored_zip(spark):
    a, b = stored(spark, 300, 4, "a"), stored(spark, 200, 3, "b")
    got = {(r.a, r.b) for r in zip_stored(spark.read.parquet(a), spark.read.parquet(b)).collect()}
    assert got == {(x["a"], y["b"]) for x, y in zip(read_plainly(a), read_plainly(b))}
    with pytest.raises(ValueError):
        zip_stored(spark.read.parquet(a), spark.read.parquet(a))
    empty = scratch_path(spark, "t")
    spark.range(0).write.parquet(empty)
    assert with_stored_number(spark.read.parquet(empty)).count() == 0


# --- skew joins -----------------------------------------------------------------------------

def sides(spark, seed=0, n=4000):
    rng = random.Random(seed)
    keys = [1] * (n // 2) + [2] * (n // 10) + [None] * 50 + [rng.randrange(3, 900) for _ in range(n // 3)]
    rng.shuffle(keys)
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "a long, k int").repartition(6)
    right = spark.createDataFrame([(k, f"r{j}") for j, k in enumerate([1, 1, 2, None, *range(3, 700, 2)])], "rk int, b string")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_skew_join_equals_the_plain_join(spark, monkeypatch, how, broadcast):
    import sluice.operators.skewjoin as m
    if not broadcast:
        monkeypatch.setattr(m, "bounded_broadcast", lambda df: df)
    left, right = sides(spark)
    assert hot_keys(left, "k", share=0.05) == [1, 2]
    want = left.join(right, F.col("k") == F.col("rk"), how)
    got = skew_join(left, right, "k", "rk", how, share=0.05, salts=5)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert ("BroadcastHashJoin" in plan(got)) == broadcast


def test_no_task_gets_the_hot_key(spark):
    """Half of all rows share a key: without adaptive planning no join task holds twice an input partition's share."""
    left, right = sides(spark, 3, 40_000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per = {}
        for name, df in (("plain", left.join(right.hint("merge"), F.col("k") == F.col("rk"), "left")),
                         ("skew", skew_join(left, right, "k", "rk", "left", share=0.01))):
            sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
            per[name] = max(sizes) / (sum(sizes) / 6)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert per["plain"] > 3 and per["skew"] <= 1.2, per


def test_hot_keys_of_many_types(spark):
    df = spark.createDataFrame([("é",)] * 30 + [("b",)] * 5 + [(None,)] * 30 + [(f"x{i}",) for i in range(35)], "s string")
    assert hot_keys(df, "s", share=0.04) == ["b", "é"]
    dates = spark.createDataFrame([(datetime.date(2020, 1, 1),)] * 9 + [(datetime.date(2020, 1, i),) for i in range(2, 20)], "d date")
    assert hot_keys(dates, "d", share=0.2) == [datetime.date(2020, 1, 1)]
    assert hot_keys(df.limit(0), "s") == [] and hot_keys(df.select(F.lit(None).cast("int").alias("s")), "s") == []
    with pytest.raises(ValueError):
        hot_keys(df, "s", share=0.1, sketch=3)


def test_sketch_keeps_frequent_values():
    rng = random.Random(1)
    for _ in range(50):
        most, counts = rng.randint(1, 8), {}
        seq = [rng.choice("aaabbcdefgh") for _ in range(300)]
        for i in range(0, 300, 20):
            for k in seq[i:i + 20]:
                counts[k] = counts.get(k, 0) + 1
            counts = _trim(counts, most)
        assert {k for k in set(seq) if seq.count(k) > 300 / (most + 1)} <= set(counts) and len(counts) <= most


def test_skew_join_of_empty_sides(spark):
    left, right = sides(spark)
    assert skew_join(left.limit(0), right, "k", "rk").count() == 0
    assert skew_join(left, right.limit(0), "k", "rk", "left").count() == left.count()
    with pytest.raises(ValueError):
        skew_join(left, right, "k", "rk", "full")


# --- cast loss ------------------------------------------------------------------------------

CASES = [  # value, type, target, loss
    ("12", "string", IntegerType(), None), ("x", "string", IntegerType(), "nulled"), (None, "string", IntegerType(), None),
    (" 7 ", "string", IntegerType(), None), ("99999999999", "string", IntegerType(), "nulled"), ("", "string", LongType(), "nulled"),
    ("1.25", "string", DecimalType(6, 2), None), ("1.256", "string", DecimalType(6, 2), "rounded"), ("12345.6", "string", DecimalType(6, 2), "nulled"),
    ("2020-01-02", "string", DateType(), None), ("2020-01-02 03:04:05", "string", DateType(), "cut"), ("2020-13-02", "string", DateType(), "nulled"),
    (300, "int", ByteType(), "nulled"), (-128, "int", ByteType(), None), (5, "int", LongType(), None), (5, "int", StringType(), None),
    (1.0, "double", IntegerType(), None), (1.5, "double", IntegerType(), "cut"), (1e12, "double", IntegerType(), "nulled"),
    (0.5, "double", FloatType(), None), (0.1, "double", FloatType(), "rounded"), (0.125, "double", DecimalType(5, 2), "rounded"),
    (2 ** 53 + 1, "long", DoubleType(), "rounded"), (2 ** 53, "long", DoubleType(), None), (16777217, "int", FloatType(), "rounded"),
    (datetime.datetime(2020, 1, 2), "timestamp_ntz", DateType(), None), (datetime.datetime(2020, 1, 2, 1), "timestamp_ntz", DateType(), "cut"),
]


@pytest.mark.parametrize("value,kind,to,want", CASES)
def test_cast_loss_of_one_value(spark, value, kind, to, want):
    df = spark.createDataFrame([(1, value)], f"id int, v {kind}")
    target = StructType([StructField("V", to), StructField("missing", StringType())])
    got = cast_loss(df, target).collect()
    assert [(r.column, r.nulled, r.cut, r.rounded) for r in got] == [("V", *[int(want == k) for k in ("nulled", "cut", "rounded")])]
    fine, lost = align_with_quarantine(df, target)
    assert fine.columns == ["V", "missing"] and fine.count() == (want is None)
    assert [(r.id, r[REASONS]) for r in lost.collect()] == ([(1, {"V": want})] if want else [])


def test_quarantine_and_aligned_rows_are_the_input(spark):
    rows = [(i, random.Random(i).choice([v for v, k, *_ in CASES if k == "string"]), i * 1.5) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, s string, x double")
    target = StructType([StructField("x", IntegerType()), StructField("s", IntegerType()), StructField("id", LongType())])
    fine, lost = align_with_quarantine(df, target)
    assert fine.count() + lost.count() == 200
    assert {r.id for r in fine.collect()} | {r.id for r in lost.collect()} == set(range(200))
    assert fine.exceptAll(align_to(df.join(lost, "id", "left_anti"), target)[0]).count() == 0
    assert lost.drop(REASONS).exceptAll(df).count() == 0
    counts = {r.column: r.nulled + r.cut + r.rounded for r in cast_loss(df, target).collect()}
    assert counts["s"] == sum("s" in r[REASONS] for r in lost.collect())
    same = StructType([StructField("s", StringType())])
    assert cast_loss(df, same).collect() == [] and align_with_quarantine(df, same)[1].count() == 0


# --- keyed permutation ----------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 10, 99, 100, 101, 1000, 1023, 1025, 20_011])
def test_permutation_is_a_bijection_without_pattern(spark, n):
    from collections import Counter

    from sluice.functions.permute import permuted, rectangle
    a, b = rectangle(n)
    assert 0 <= a * b - n < a
    got = [r[0] for r in spark.range(0, n, 1, 1).select(permuted(F.col("id"), n, "k")).collect()]
    assert sorted(got) == list(range(n))
    if n >= 99:
        other = [r[0] for r in spark.range(0, n, 1, 1).select(permuted(F.col("id"), n, "l")).collect()]
        assert got != other and got != list(range(n))
        steps = Counter((y - x) % n for x, y in zip(got, got[1:]))
        assert max(steps.values()) <= 8  # no constant difference


# --- changed partitions ---------------------------------------------------------------------

def files_of(spark, t):
    rows = spark.table(t).select("p", F.col("_metadata.file_name").alias("f")).distinct().collect()
    return {p: {r.f for r in rows if r.p == p} for p in {r.p for r in rows}}


def test_only_changed_partitions_are_written(spark):
    t = scratch_table(spark, "sl_changed")
    old = [(1, "a", "x"), (2, None, "x"), (2, None, "x"), (3, "c", "y"), (4, "d", None), (5, "e", "z/ 1")]
    write_table(spark.createDataFrame(old, "id int, v string, p string"), t, ["p"], "append")
    before = files_of(spark, t)
    new = [(2, None, "x"), (1, "a", "x"), (2, None, "x"), (3, "C", "y"), (4, "d", None), (9, "n", "new")]
    write_table(spark.createDataFrame(new, "id int, v string, p string").repartition(5), t, ["p"], "overwrite_partitions", only_changed=True)
    after = files_of(spark, t)
    assert sorted(map(repr, map(tuple, spark.table(t).collect()))) == sorted(map(repr, [*new, old[-1]]))
    assert {p for p in after if before.get(p) != after[p]} == {"y", "new"}
    write_table(spark.createDataFrame(new, "id int, v string, p string"), t, ["p"], "overwrite_partitions", only_changed=True)
    assert files_of(spark, t) == after
    fewer = [(2, None, "x"), (1, "a", "x")]  # a repeated row less
    write_table(spark.createDataFrame(fewer, "id int, v string, p string"), t, ["p"], "overwrite_partitions", only_changed=True)
    assert spark.table(t).where("p = 'x'").count() == 2
    with pytest.raises(ValueError):
        write_table(spark.createDataFrame(new, "id int, v string, p string"), t, ["p"], "overwrite", only_changed=True)
