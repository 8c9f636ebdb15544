"""Sort specifications as Spark Columns.

An order is a list whose items are column names (ascending, NULLs first, which is Spark's
default), `Desc(name)` (descending, NULLs last, the ANSI default) or Columns that already carry a
direction (`F.col(c).desc()`). Of names and `Desc` it is known which column they order by;
of Columns it is not.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

class Desc(NamedTuple):
    """A column in descending order, NULLs last."""
    name: str


OrderItem = str | Desc | Column


def directed(item: str | Desc, value: Column) -> Column:
    """`value` in the direction of `item`."""
    return value.desc_nulls_last() if isinstance(item, Desc) else value.asc_nulls_first()


def name_of(item: OrderItem) -> str | None:
    """The column that an item is known to order by."""
    return item.name if isinstance(item, Desc) else item if isinstance(item, str) else None


def as_sort_columns(order: Sequence[OrderItem]) -> list[Column]:
    return [o if isinstance(o, Column) else directed(o, F.col(name_of(o))) for o in order]


def orderable_columns(df: DataFrame) -> list[str]:
    """Columns Spark can sort and hash (map columns cannot be ordered)."""
    return [f.name for f in df.schema.fields if not _has_map(f.dataType)]


def _has_map(t) -> bool:
    if isinstance(t, MapType):
        return True
    if isinstance(t, ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return False


def total_items(df: DataFrame, order: Sequence[OrderItem]) -> list[OrderItem]:
    """`order` followed by every column it does not name, ascending, so only identical rows tie.
    Columns of an order given as expressions are appended too (a repeated key is harmless; what
    an expression covers is never guessed). Map columns cannot be ordered; rows that differ
    only in a map column tie."""
    seen = {n.lower() for o in order if (n := name_of(o)) is not None}
    return [*order, *[c for c in orderable_columns(df) if c.lower() not in seen]]


def total_order(df: DataFrame, order: Sequence[OrderItem]) -> list[Column]:
    """`total_items` as sort Columns (the appended names taken literally)."""
    items = total_items(df, order)
    return as_sort_columns(items[:len(order)]) + [F.col(f"`{c}`").asc_nulls_first() for c in items[len(order):]]


def all_desc(df: DataFrame) -> list[Desc]:
    """Every orderable column descending (NULLs last), in column order."""
    return [Desc(c) for c in orderable_columns(df)]
