"""Property tests: dump round trip on arbitrary text, range numbering == window definition."""

import tempfile

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators.numbering import with_row_number
from sluice.sinks.files import write_sql_dump
from sluice.sources.sqldump import read_sql_dump

# text biased towards the characters the dump format escapes
_ALPHABET = st.sampled_from(list("ab ,()'\"\\\n\r\t;\u0000\u001aÜ€0NUL"))
_TEXT = st.one_of(st.none(), st.text(_ALPHABET, max_size=30), st.text(max_size=10))

# few examples and no shrinking: every example runs Spark jobs
_SETTINGS = settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate],
                     suppress_health_check=[HealthCheck.function_scoped_fixture,
                                            HealthCheck.too_slow])


@_SETTINGS
@given(texts=st.lists(_TEXT, min_size=1, max_size=60))
def test_dump_round_trip_any_text(spark, texts):
    src = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, txt string")
    out = tempfile.mkdtemp(prefix="sl-prop-") + "/d"
    write_sql_dump(src, out, "p", rows_per_statement=7)
    back = read_sql_dump(spark, out, src.schema, table="p")
    assert sorted(back.collect()) == sorted(src.collect())


@_SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)),
                               st.one_of(st.none(), st.sampled_from(["a", "b", ""]))),
                     min_size=0, max_size=80),
       desc=st.booleans(), parts=st.integers(1, 5))
def test_range_numbering_equals_window(spark, rows, desc, parts):
    df = spark.createDataFrame(rows, "x int, y string")
    order = [F.col("x").desc_nulls_last() if desc else F.col("x").asc_nulls_first()]
    a = with_row_number(df, order, num_partitions=parts)
    b = with_row_number(df, order, method="window")
    key = lambda r: (repr(r["x"]), repr(r["y"]), r["nr"])
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)


def _py_sorted(rows):
    # ascending, NULLs first, column by column (the total order used for ties)
    return sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


@_SETTINGS
@given(left=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 2)), max_size=40),
       right=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 2)), max_size=40))
def test_zip_pairs_rows_by_sorted_position(spark, left, right):
    from sluice.operators.numbering import zip_by_position
    l_df = spark.createDataFrame(left, "a int, b int")
    r_df = spark.createDataFrame(right, "c int, d int")
    got = sorted((tuple(r) for r in zip_by_position(l_df, r_df, ["a"], ["c"]).collect()), key=repr)
    expected = sorted((tuple(x) + tuple(y) for x, y in zip(_py_sorted(left), _py_sorted(right))), key=repr)
    assert got == expected
