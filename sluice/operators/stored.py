"""Row numbers in stored order: no sort, and no row leaves its task.

Spark knows for every row of a Parquet scan which file holds it and at which place. A file's rows are
counted from its footer, the files are put in the order of their paths, and what stands before a
file is its offset: number = offset + place + 1. The offsets are a row for each file; they are
broadcast behind a check of their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import bounded_broadcast

_FILE, _PLACE, _OFF, _ROWS, _LAST = "__sl_file", "__sl_place", "__sl_off", "__sl_rows", "__sl_last"


def stored_offsets(scan: DataFrame) -> DataFrame:
    """(file, rows before it) of a Parquet scan's files in path order. The scan must hold whole files: a
    filter would leave gaps, which is checked against the last place of each file."""
    files = scan.select(F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_PLACE)).groupBy(_FILE).agg(
        F.count(F.lit(1)).alias(_ROWS), F.max(_PLACE).alias(_LAST))
    whole = F.when(F.col(_LAST) + 1 == F.col(_ROWS), F.col(_ROWS)).otherwise(
        F.raise_error(F.concat(F.lit("rows of this file are filtered out, so it has no stored numbers: "), F.col(_FILE))).cast("long"))
    before = Window.orderBy(_FILE).rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return files.select(_FILE, whole.alias(_ROWS)).select(_FILE, F.coalesce(F.sum(_ROWS).over(before), F.lit(0)).alias(_OFF))


def with_stored_number(scan: DataFrame, name: str = "nr", columns: list[str] | None = None) -> DataFrame:
    """Add `name` = 1..N in stored order to a Parquet scan (`spark.read.parquet(...)`, a table), and keep `columns`
    (all). Filter and join afterwards: the numbers are those of the stored rows."""
    if name.lower() in (c.lower() for c in scan.columns):
        raise ValueError(f"column {name!r} already exists")
    cols = [F.col(f"`{c}`") for c in (columns or scan.columns)]
    rows = scan.select(*cols, F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_PLACE))
    offsets = bounded_broadcast(stored_offsets(scan))
    return rows.join(offsets, _FILE).select(*cols, (F.col(_OFF) + F.col(_PLACE) + 1).alias(name))


def zip_stored(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pair the i-th stored row of `left` with the i-th of `right`; the shorter side wins. One exchange for
    each side, on the number, which is unique, so the join cannot skew."""
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    rn = "__sl_pos"
    return with_stored_number(left, rn).join(with_stored_number(right, rn), rn, "inner").drop(rn)
