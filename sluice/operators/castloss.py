"""What an alignment's casts would lose, counted before they do, and a way to set such rows aside.

`align_to` casts columns to the target's types. A cast can turn a value into NULL (text that is no
number, a number out of range), cut it (a fraction dropped, a time of day dropped) or round it (fewer
decimal places, a long integer as a floating-point number). `cast_loss` counts these for every column
in one pass; `align_with_quarantine` keeps the rows that lose something out of the aligned frame and
hands them back as they were, with the columns and reasons.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegralType, MapType,
                               NumericType, StringType, StructType, TimestampNTZType, TimestampType)

from .schema import align_to

NULLED, CUT, ROUNDED = "nulled", "cut", "rounded"
#: Name of the column that quarantined rows get.
REASONS = "cast_reasons"
_WIDE = "decimal(38,18)"


def _try(c: Column, to: DataType | str) -> Column:
    return c.try_cast(to)


def loss(c: Column, src: DataType, to: DataType) -> Column:
    """'nulled', 'cut', 'rounded', or NULL where the cast of a value keeps it."""
    none = F.lit(None).cast("string")
    if src == to or isinstance(src, (ArrayType, MapType, StructType)):
        return none
    got = _try(c, to)
    nulled = c.isNotNull() & got.isNull()
    changed = None
    kind = ROUNDED
    if isinstance(to, IntegralType):
        kind = CUT
        if isinstance(src, StringType):
            # text of a fraction is refused by the cast or, where it is not, cut
            changed = _try(F.trim(c), _WIDE) != got.cast(_WIDE)
        elif isinstance(src, (DecimalType, DoubleType, FloatType)):
            changed = c != got.cast(src)
    elif isinstance(to, DecimalType):
        if isinstance(src, StringType):
            changed = _try(F.trim(c), _WIDE) != got.cast(_WIDE)
        elif isinstance(src, (DoubleType, FloatType)):
            changed = c != got.cast(src)
        elif isinstance(src, DecimalType) and src.scale > to.scale:
            changed = c != got
    elif isinstance(to, (DoubleType, FloatType)) and isinstance(src, NumericType):
        wide = "decimal(38,0)" if isinstance(src, IntegralType) else src
        if isinstance(src, (IntegralType, DecimalType)):
            changed = c.cast(wide) != _try(got, wide)
        elif isinstance(src, DoubleType) and isinstance(to, FloatType):
            changed = c != got.cast("double")
    elif isinstance(to, DateType):
        kind = CUT
        if isinstance(src, (TimestampType, TimestampNTZType)):
            changed = c != got.cast(src)
        elif isinstance(src, StringType):
            changed = _try(c, "timestamp_ntz") != got.cast("timestamp_ntz")
    out = F.when(nulled, F.lit(NULLED))
    return out.when(changed, F.lit(kind)) if changed is not None else out


def _losses(df: DataFrame, target: StructType) -> list[tuple[str, str, str, Column]]:
    have = {c.lower(): c for c in df.columns}
    found = []
    for f in target.fields:
        src = have.get(f.name.lower())
        if src is not None and df.schema[src].dataType != f.dataType:
            old = df.schema[src].dataType
            found.append((f.name, old.simpleString(), f.dataType.simpleString(), loss(F.col(f"`{src}`"), old, f.dataType)))
    return found


def cast_loss(df: DataFrame, target: StructType) -> DataFrame:
    """(column, from_type, to_type, nulled, cut, rounded) of every column whose type the alignment changes: how
    many of its values the cast would lose, in one pass."""
    spark, found = df.sparkSession, _losses(df, target)
    schema = "column string, from_type string, to_type string, nulled long, cut long, rounded long"
    if not found:
        return spark.createDataFrame([], schema)
    kinds = (NULLED, CUT, ROUNDED)
    counts = df.agg(*[F.count_if(c == F.lit(k)).alias(f"{k}{i}") for i, (_, _, _, c) in enumerate(found) for k in kinds])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit(a).alias("from_type"), F.lit(b).alias("to_type"), *[F.col(f"{k}{i}").alias(k) for k in kinds])
        for i, (n, a, b, _) in enumerate(found)])))


def align_with_quarantine(df: DataFrame, target: StructType, partitions: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(aligned rows, quarantined rows): rows whose casts lose nothing, in the target's shape; and the others with
    all their own columns and `cast_reasons` (target column -> reason). Together they are the input; both
    read it, so write a frame that is dear to compute first."""
    if REASONS in df.columns:
        raise ValueError(f"column {REASONS!r} already exists")
    found = _losses(df, target)
    if not found:
        empty = df.limit(0).withColumn(REASONS, F.lit(None).cast("map<string,string>"))
        return align_to(df, target, partitions)[0], empty
    lost = F.map_filter(F.create_map(*[x for n, _, _, c in found for x in (F.lit(n), c)]), lambda _, v: v.isNotNull())
    fine = F.lit(True)
    for *_, c in found:
        fine = fine & c.isNull()
    return align_to(df.where(fine), target, partitions)[0], df.where(~fine).withColumn(REASONS, lost)
