"""Broadcast a join side only behind a checked size bound.

Adaptive execution converts a join to a broadcast after both sides' shuffles have run, so
a large side is shuffled even when the other side turns out tiny. When a side is expected to
be small (a dimension table, a filtered lookup), `bounded_broadcast` measures it first: one
aggregate over the side gives its number of rows and their bytes (exact length of the
variable-width columns plus fixed widths), and one row reaches the driver. The side is broadcast
only within both bounds; otherwise it is returned unchanged and the shuffle join (with AQE skew
handling) does the work. Select the needed columns before: only they are measured.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, MapType, StringType, StructType

DEFAULT_MAX_ROWS = 200_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                      max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    fixed, var = 0, []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            var.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            var.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            fixed += 16 if isinstance(f.dataType, DecimalType) else 8
    width = (sum(var[1:], var[0]) if var else F.lit(0)) + F.lit(fixed + 8)
    got = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("w")).first()
    return F.broadcast(df) if got["n"] <= max_rows and got["w"] <= max_bytes else df
