"""Row positions that survive recomputation.

`monotonically_increasing_id()` numbers rows in the order a task sees them. Over a file scan
that order is fixed, and the position is taken as it is. Over a shuffle's output it can change
when a lost task is re-run, and a row could then get another id (and land in another group) than
in the first attempt; there each partition is sorted first, by the caller's order where one is
given, else by the row hash, and then by every column. Identical rows are interchangeable, so the
position after the sort is a deterministic, unique row id. The sort is per task (no shuffle);
the 64-bit hash settles almost every comparison without looking at the columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import OrderItem, as_sort_columns, orderable_columns

PARTITION_BITS = 33  # monotonically_increasing_id = partition << 33 | position in partition


def shuffled(df: DataFrame) -> bool:
    """Whether rows arrive through an exchange (planning only, no job)."""
    return "Exchange" in df._jdf.queryExecution().sparkPlan().toString() or \
        "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def with_stable_position(df: DataFrame, name: str, order: Sequence[OrderItem] = ()) -> DataFrame:
    """Add `name`: unique id = (input partition << 33) + position in the partition, after the
    per-task sort where one is needed (see above) or `order` asks for one. The projection is
    nondeterministic, so the optimizer keeps the sort beneath it."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    keys = [F.col(f"`{c}`") for c in orderable_columns(df)]  # map columns cannot be sorted
    if keys and (order or shuffled(df)):
        df = df.sortWithinPartitions(*as_sort_columns(order), F.xxhash64(*keys), *keys)
    return df.select(*cols, F.monotonically_increasing_id().alias(name))


def partition_of(pos: Column) -> Column:
    return F.shiftright(pos, PARTITION_BITS)


def offset_in_partition(pos: Column) -> Column:
    return pos - F.shiftleft(partition_of(pos), PARTITION_BITS)
