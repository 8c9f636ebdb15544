"""Numbering, survey ids, schema alignment and the generator: invariants and edge cases."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from sluice.operators.numbering import with_row_number, zip_by_position
from sluice.operators.schema import align_to, drift, drift_report
from sluice.operators.survey import run_summary, survey_id
from sluice.operators.synth import perm_multiplier, synth_table

from conftest import SF_SMALL


def _numbers(df, name="nr"):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_range_numbers_equal_window_with_ties_nulls_and_duplicates(spark):
    rows = [(i % 7, None if i % 5 == 0 else f"s{i % 3}", float(i % 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    order = [F.col("a").desc_nulls_last(), "b"]
    ranged = with_row_number(df, order, method="range", num_partitions=6)
    window = with_row_number(df, order, method="window")
    assert _numbers(ranged) == _numbers(window)
    nrs = sorted(r["nr"] for r in ranged.select("nr").collect())
    assert nrs == list(range(1, 401))


def test_hot_duplicate_group_is_spread(spark):
    # one row repeated 3000 times (a third of the input) plus distinct rows
    hot = spark.range(3000).select(F.lit(1).alias("k"), F.lit("hot").alias("v"))
    rest = spark.range(6000).select((F.col("id") + 2).alias("k"), F.col("id").cast("string").alias("v"))
    df = hot.unionByName(rest)
    ranged = with_row_number(df, ["k"], num_partitions=8)
    window = with_row_number(df, ["k"], method="window")
    assert _numbers(ranged) == _numbers(window)
    assert ranged.where("k = 1").count() == 3000


def test_heavy_partition_is_split(spark, monkeypatch):
    """A key with a heavy hitter is given up for the whole row and the input partition."""
    import sluice.operators.numbering as m
    monkeypatch.setattr(m, "HEAVY_ROWS", 100)
    monkeypatch.setattr(m, "HEAVY", 2)
    hot = spark.range(0, 3000, 1, 6).select(F.lit(1).alias("k"), F.lit("hot").alias("v"))
    df = hot.unionByName(spark.range(0, 3000, 1, 6).select((F.col("id") + 2).alias("k"), F.col("id").cast("string").alias("v")))
    table = m._materialise(df, ["k"], 12, False)
    assert table.where("k = 1").select(m._P).distinct().count() >= 3
    assert _numbers(with_row_number(df, ["k"], num_partitions=12)) == _numbers(with_row_number(df, ["k"], method="window"))


def test_heavy_key_goes_on_without_whole_texts(spark, monkeypatch):
    """Behind a heavy value of a short string the key is longer, but never holds a whole text while that spreads the rows."""
    import sluice.operators.numbering as m
    monkeypatch.setattr(m, "HEAVY_ROWS", 100)
    monkeypatch.setattr(m, "HEAVY", 2)
    keys, write = [], m._write_stamped
    monkeypatch.setattr(m, "_write_stamped", lambda df, cols, k, *a: keys.append([str(x) for x in k]) or write(df, cols, k, *a))
    i = F.col("id")
    df = spark.range(0, 4000, 1, 6).select(
        F.when(i % 97 != 0, F.lit("en")).alias("lang"), F.when(i % 50 != 0, i % 3990).alias("doc_id"),
        F.when(i % 31 != 0, F.concat(F.repeat(F.lit("é"), 70), F.md5((i % 400).cast("string")))).alias("text"))
    df = df.union(df.limit(40))
    table = m._materialise(df, ["lang"], 12, False)
    assert len(keys) == 2 and len(keys[1]) == 3 and "substring(text" in keys[1][2]
    assert table.groupBy(m._P).count().agg(F.max("count")).first()[0] < 1000
    assert _numbers(with_row_number(df, ["lang"], num_partitions=12)) == _numbers(with_row_number(df, ["lang"], method="window"))
    # rows that such a key does not spread: the whole order and the input partition
    keys.clear()
    same = df.select("lang", F.lit(1).alias("doc_id"), "text")
    assert _numbers(with_row_number(same, ["lang"], num_partitions=12)) == _numbers(with_row_number(same, ["lang"], method="window"))
    assert len(keys) == 3 and m._K in keys[2][-1]


def test_expression_orders_name_no_column(spark):
    """What an expression orders by is not guessed: ties of it are broken by every column."""
    df = spark.range(40).select(F.col("id").alias("a"), (F.col("id") % 3).alias("my col")).repartition(5)
    for order in ([F.expr("a % 4").desc()], [F.col("my col")], [F.expr("a % 10").desc()]):
        window = {r["a"]: r["nr"] for r in with_row_number(df, order, method="window").collect()}
        for _ in range(2):
            assert {r["a"]: r["nr"] for r in with_row_number(df, order).collect()} == window
    first = with_row_number(df, [F.expr("a % 4").desc()]).orderBy("nr").limit(3).collect()
    assert [r["a"] for r in first] == [3, 7, 11]


def test_row_number_empty_input(spark):
    df = spark.createDataFrame([], "a int")
    assert with_row_number(df, ["a"]).count() == 0


def test_positional_zip_shorter_side_wins(spark):
    left = spark.range(10).select(F.col("id").alias("l"))
    right = spark.range(7).select((F.col("id") * 10).alias("r"))
    out = sorted((r["l"], r["r"]) for r in zip_by_position(left, right, ["l"], ["r"]).collect())
    assert out == [(i, i * 10) for i in range(7)]
    with pytest.raises(ValueError):
        zip_by_position(left, left, ["l"], ["l"])


def test_survey_id_format_and_contiguity(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey")
    out = survey_id(df, 4100, "20221125")
    ids = [r["odl_id"] for r in out.collect()]
    assert len(ids) == len(set(ids)) == df.count()
    assert all(re.fullmatch(r"1410020221125\d{6,}", i) for i in ids)
    suffixes = sorted(int(i[13:]) for i in ids)
    assert suffixes == list(range(100001, 100001 + len(ids)))
    # numbered by all columns descending: the largest row gets nr 1
    top = out.orderBy("nr").first()
    assert top["o_orderkey"] == df.agg(F.max("o_orderkey")).first()[0]
    with pytest.raises(ValueError):
        survey_id(df, 4100, "2022-11-25")


def test_survey_id_example_value(spark):
    df = spark.createDataFrame([("x",)], "a string")
    assert survey_id(df, 4100, "20221125").first()["odl_id"] == "1410020221125100001"


def test_align_and_drift(spark):
    df = spark.createDataFrame([(1, "a", 2.5, "x")], "ID int, Name string, score double, extra string")
    target = StructType([StructField("name", StringType()), StructField("id", LongType()),
                         StructField("missing_col", IntegerType()), StructField("score", StringType())])
    aligned, d = align_to(df, target, partitions=["extra", "name"])
    assert aligned.columns == ["name", "id", "missing_col", "score"]
    assert aligned.schema == target
    assert aligned.first().asDict() == {"name": "a", "id": 1, "missing_col": None, "score": "2.5"}
    assert d.missing == ["missing_col"] and d.extra == ["extra"]
    assert d.partitions_removed == ["extra"] and d.partitions == ["name"]
    rep = {(r["column"], r["status"]): r["rows"] for r in drift_report(df, target, ["extra"]).collect()}
    assert rep == {("missing_col", "missing"): 1, ("extra", "extra"): 1, ("extra", "partition_removed"): 1}
    assert drift(df, StructType(df.schema.fields)).clean


def test_run_summary(spark):
    df = spark.range(42)
    r = run_summary(df, "RUN_4100", "20221125", "append").first()
    assert r["amount"] == 42 and r["survey"] == "RUN_4100" and r["status"] == "Completed"


def test_synth_deterministic_keys_unique_and_shared(spark):
    schema = StructType([StructField("key", StringType()), StructField("s", StringType()),
                         StructField("i", IntegerType()), StructField("l", LongType()),
                         StructField("t", StringType())])
    n = 997
    a = synth_table(spark, schema, n, keys={"key": "party"}, seed=7)
    b = synth_table(spark, schema, n, keys={"key": "party"}, seed=7, num_partitions=3)
    assert sorted(a.collect()) == sorted(b.collect())
    keys = [r["key"] for r in a.collect()]
    assert len(set(keys)) == n
    assert all(re.fullmatch(r"party_202211251200_\d+", k) for k in keys)
    assert sorted(int(k.rsplit("_", 1)[1]) for k in keys) == list(range(n))
    row = a.first()
    assert re.fullmatch(r"[0-9A-Z]{10}", row["s"]) and 0 <= row["i"] < 1000 and 0 <= row["l"] < 10 ** 6
    other = synth_table(spark, StructType([StructField("fk", StringType())]), n, keys={"fk": "party"}, seed=7)
    assert a.join(other, a.key == other.fk).count() == n


def test_synth_timestamps_and_choices(spark):
    from pyspark.sql.types import TimestampNTZType
    schema = StructType([StructField("ts", TimestampNTZType()), StructField("c", StringType()),
                         StructField("z", StringType())])
    df = synth_table(spark, schema, 500, choices={"c": ["A", "B"], "z": None}, base_ts="2022-11-25 12:00:00")
    r = df.agg(F.min("ts"), F.max("ts"), F.collect_set("c"), F.count("z")).first()
    import datetime as dt
    base = dt.datetime(2022, 11, 25, 12)
    assert base - dt.timedelta(days=7) <= r[0] and r[1] <= base - dt.timedelta(days=1)
    assert sorted(r[2]) == ["A", "B"] and r[3] == 0


def test_synth_rejects_unknown_types_and_columns(spark):
    from pyspark.sql.types import ArrayType
    with pytest.raises(TypeError):
        synth_table(spark, StructType([StructField("a", ArrayType(StringType()))]), 3)
    with pytest.raises(ValueError):
        synth_table(spark, StructType([StructField("a", StringType())]), 3, keys={"b": "x"})


def test_perm_multiplier_is_coprime():
    import math
    for n in (1, 2, 15000, 2147483647, 2 * 2147483647):
        assert math.gcd(perm_multiplier(n), n) == 1 or n == 1


def test_bounded_broadcast_checks_rows_and_bytes(spark):
    from sluice.functions.joins import bounded_broadcast
    small = spark.range(10).select(F.col("id"), F.lit("x").alias("s"))
    big = spark.range(50).select(F.col("id"), F.lit("y" * 1000).alias("s"))
    assert "broadcast" in str(bounded_broadcast(small, max_rows=100)._jdf.queryExecution().logical()).lower()
    assert "broadcast" not in str(bounded_broadcast(small, max_rows=5)._jdf.queryExecution().logical()).lower()
    assert "broadcast" not in str(bounded_broadcast(big, max_rows=100, max_bytes=10_000)._jdf.queryExecution().logical()).lower()


def test_unique_order_shortcut_matches_window(spark):
    df = spark.range(3000).select(((F.col("id") * 7919) % 3000).alias("k"), (F.col("id") % 3).alias("v"))
    a = with_row_number(df, [F.col("k").desc()], unique_order=True, num_partitions=5)
    b = with_row_number(df, [F.col("k").desc()], method="window")
    assert _numbers(a) == _numbers(b)
    # a wrong uniqueness claim still numbers correctly (duplicates only lose skew protection)
    dup = df.unionByName(df)
    assert _numbers(with_row_number(dup, ["k"], unique_order=True)) == _numbers(with_row_number(dup, ["k"], method="window"))


def test_run_selection_job_aligns_and_reports(spark):
    from sluice.operators.survey import run_selection_job
    from sluice.session import scratch_path, unique_name
    from sluice.sinks.tables import write_table
    target = unique_name("t_run")
    schema = StructType([StructField("ID", LongType()), StructField("extra", StringType()),
                         StructField("year_month", StringType())])
    write_table(spark.createDataFrame([], schema), target, ["year_month"], "append",
                path=scratch_path(spark, "test-table"))
    sel = spark.range(5).select(F.col("id"), F.lit("202211").alias("year_month"), F.lit(1).alias("dropped"))
    rep = run_selection_job(sel, target, survey="S", run_date="20221125").first()
    assert rep["amount"] == 5 and rep["status"] == "Completed"
    rows = spark.table(target).collect()
    assert len(rows) == 5 and all(r["extra"] is None for r in rows)
    dry = run_selection_job(sel, target, survey="S", run_date="20221125", dry_run=True).first()
    assert dry["status"] == "Dry run" and spark.table(target).count() == 5


def test_row_number_with_map_and_array_columns(spark):
    df = spark.createDataFrame([(3, {"a": 1}, [1, 2]), (1, {"b": 2}, [3]), (2, None, None)],
                               "k int, m map<string,int>, arr array<int>")
    out = sorted((r["k"], r["nr"]) for r in with_row_number(df, ["k"]).collect())
    assert out == [(1, 1), (2, 2), (3, 3)]


def test_select_survey_keeps_exactly_one_survey(spark):
    from sluice.operators.survey import select_survey
    df = spark.createDataFrame([("4100", 1), ("4201", 2), ("4100", 3), (None, 4)], "survey_nr string, x int")
    assert sorted(r["x"] for r in select_survey(df, "4100").collect()) == [1, 3]
