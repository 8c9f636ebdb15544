"""Physical-plan properties that matter at scale (pushdown, pruning, shuffles)."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from sluice.functions.ordering import Desc, as_sort_columns, total_order
from sluice.operators.numbering import _narrow_key, _numbered, _materialise
from sluice.plans import queries as Q

from conftest import SF_CHECK


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _nodes(plan: str, name: str) -> int:
    """Number of plan nodes called `name` (formatted explain lists each once as "(i) name")."""
    return len(re.findall(rf"^\(\d+\) {name}\b", plan, flags=re.M))


def test_filter_limit_pushes_filter_prunes_columns_and_uses_topk(spark):
    p = _plan(Q.filter_eq_limit(spark, SF_CHECK))
    assert "EqualTo(c_mktsegment,BUILDING)" in p
    assert "ReadSchema: struct<c_name:string,c_mktsegment:string>" in p
    assert "TakeOrderedAndProject" in p


def test_like_prefix_reaches_the_scan(spark):
    p = _plan(Q.view_like_filter(spark, SF_CHECK))
    assert "StringStartsWith(p_type,S)" in p


def test_row_number_has_one_range_shuffle_and_no_single_partition(spark):
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    order = [Desc(c) for c in orders.columns]
    for keys in (_narrow_key(orders, order)[0], as_sort_columns(order)):
        p = _plan(orders.repartitionByRange(*keys).sortWithinPartitions(*total_order(orders, order)))
        assert _nodes(p, "Exchange") == 1
        assert "rangepartitioning" in p
        assert "SinglePartition" not in p


def test_range_key_is_narrow(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    keys, wide = _narrow_key(docs, ["lang"])
    assert "substring" in str(keys[-1]) and len(keys) == 1 and not wide
    keys, _ = _narrow_key(docs, ["n_chars"])
    assert len(keys) == 3 and "substring(text" in str(keys[-1])  # n_chars, doc_id, text cut
    keys, wide = _narrow_key(docs, [F.col("text").desc()])
    assert wide


def test_zip_cuts_the_longer_side_below_the_exchange(spark):
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    table = _materialise(orders, ["o_orderkey"], None, True)
    p = _plan(_numbered(table, "rn", 100).repartition(4, "rn"))
    below = p[:p.index("Exchange hashpartitioning")] if "Exchange hashpartitioning" in p else p
    assert "<= 100" in below


def test_window_definition_is_single_partition(spark):
    from sluice.operators.numbering import with_row_number
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    assert "SinglePartition" in _plan(with_row_number(orders, ["o_orderkey"], method="window"))


def test_partitioned_write_is_rebalanced(spark):
    from sluice.sinks.tables import _rebalanced
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    assert "REBALANCE_PARTITIONS_BY_COL" in _plan(_rebalanced(orders, ["o_orderpriority"]))


def test_join_chain_broadcasts_only_checked_small_sides(spark):
    p = _plan(Q.join_chain(spark, SF_CHECK))
    # both dimension sides passed the bounded check, so the fact side is not shuffled
    assert _nodes(p, "BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p
