"""Align a DataFrame to a target table's schema and report the drift.

Names match case-insensitively. Target columns the frame lacks become typed NULLs (never
`""`: an empty string cannot be stored in a numeric column under ANSI store assignment);
frame columns the target lacks are dropped; the result has the target's column order and
names. Partition columns that the target does not have are removed from the partition list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MISSING = "missing"                       # in the target, not in the frame: filled with NULL
EXTRA = "extra"                           # in the frame, not in the target: dropped
PARTITION_REMOVED = "partition_removed"   # requested partition column the target lacks


@dataclass
class Drift:
    missing: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)
    partitions_removed: list[str] = field(default_factory=list)
    partitions: list[str] = field(default_factory=list)
    # the table's own partitioning, where a write asked for another one
    partitioned_by: list[str] | None = None

    @property
    def clean(self) -> bool:
        return not (self.missing or self.extra or self.partitions_removed or self.partitioned_by is not None)


def _by_lower(names: Sequence[str]) -> dict[str, str]:
    return {n.lower(): n for n in names}


def drift(df: DataFrame, target: StructType, partitions: Sequence[str] = ()) -> Drift:
    """Set differences between the frame's columns and the target's (metadata only)."""
    have = _by_lower(df.columns)
    want = _by_lower(target.fieldNames())
    extra = [have[k] for k in have if k not in want]
    return Drift(
        missing=[want[k] for k in want if k not in have],
        extra=extra,
        partitions_removed=[p for p in partitions if p.lower() not in want],
        partitions=[want[p.lower()] for p in partitions if p.lower() in want],
    )


def align_to(df: DataFrame, target: StructType, partitions: Sequence[str] = ()) -> tuple[DataFrame, Drift]:
    """Return (frame in the target's shape, drift). One projection; no job runs."""
    d = drift(df, target, partitions)
    have = _by_lower(df.columns)
    out: list[Column] = []
    for f in target.fields:
        src = have.get(f.name.lower())
        if src is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            c = F.col(f"`{src}`")
            if df.schema[src].dataType != f.dataType:
                c = c.cast(f.dataType)
            out.append(c.alias(f.name))
    return df.select(*out), d


def drift_report(df: DataFrame, target: StructType, partitions: Sequence[str] = ()) -> DataFrame:
    """Drift as rows (column, status, rows): what an aligned write would change.

    `rows` is the number of rows that get NULL for a missing column, and the number of
    non-NULL values that are dropped for an extra or removed-partition column. All counts
    come from one aggregate over the frame; the driver only handles column names.
    """
    d = drift(df, target, partitions)
    entries: list[tuple[str, str, Column]] = (
        [(c, MISSING, F.count(F.lit(1))) for c in d.missing]
        + [(c, EXTRA, F.count(F.col(f"`{c}`"))) for c in d.extra]
        + [(c, PARTITION_REMOVED,
            F.count(F.col(f"`{_by_lower(df.columns)[c.lower()]}`")) if c.lower() in _by_lower(df.columns)
            else F.lit(0).cast("long")) for c in d.partitions_removed])
    spark = df.sparkSession
    if not entries:
        return spark.createDataFrame([], "column string, status string, rows long")
    counts = df.agg(*[e[2].alias(f"n{i}") for i, e in enumerate(entries)])
    stacked = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("status"), F.col(f"n{i}").alias("rows"))
        for i, (c, s, _) in enumerate(entries)]))
    return counts.select(stacked)
