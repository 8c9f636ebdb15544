"""File sinks in the formats the sources read: CSV, JSON arrays, MySQL dumps.

All three are plain Spark writes. The JSON-array and dump writers group rows into bounded
chunks (`bytes_per_file` / `rows_per_statement`) of consecutive rows of one input partition
(positions from `with_stable_position`, so a re-run task forms the same chunks), so no
group grows with the data. Rows keep the order of their partition, or `order` where the
frame comes out of a shuffle (whose arrival order a re-run task would not repeat).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from ..functions.ordering import OrderItem
from ..functions.positions import offset_in_partition, partition_of, with_stable_position
from ..sources.files import TS_FORMAT, TS_LTZ_FORMAT


def write_csv(df: DataFrame, path: str, *, mode: str = "error", header: bool = True) -> None:
    """CSV with minimal quoting: NULL is blank, the empty string is `""`, quotes double."""
    (df.write.mode(mode).option("header", header).option("escape", '"').option("lineSep", "\n")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_LTZ_FORMAT)
     .csv(path))


def _chunked(df: DataFrame, rows_per_chunk: int, value: Column, sep: str, order: Sequence[OrderItem]) -> DataFrame:
    """One row per chunk: the `value`s of consecutive rows (by stable position) of one partition, at
    most `rows_per_chunk`, joined in their order; the same on every recomputation."""
    pos = F.col("__sl_pos")
    chunk = F.concat_ws("-", partition_of(pos).cast("string"),
                        F.floor(offset_in_partition(pos) / rows_per_chunk).cast("string"))
    rows = with_stable_position(df, "__sl_pos", order).select(chunk.alias("__sl_chunk"), F.struct(pos, value.alias("v")).alias("r"))
    inside = F.sort_array(F.collect_list("r"))
    return rows.groupBy("__sl_chunk").agg(F.concat_ws(sep, F.transform(inside, lambda r: r.v)).alias("value"))


def write_json_array(df: DataFrame, path: str, *, bytes_per_file: int = 64 << 20, rows_per_file: int | None = None,
                     mode: str = "error", order: Sequence[OrderItem] = ()) -> None:
    """One JSON array of flat objects per file, NULL fields written as null. Files have about
    `bytes_per_file` (by the mean object length, one aggregate), or `rows_per_file` objects."""
    obj = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]),
                    {"timestampNTZFormat": TS_FORMAT, "timestampFormat": TS_LTZ_FORMAT, "ignoreNullFields": "false"})
    if rows_per_file is None:
        mean = df.agg(F.avg(F.octet_length(obj))).first()[0] or 1
        rows_per_file = max(1, int(bytes_per_file // (mean + 2)))
    arrays = _chunked(df, rows_per_file, obj, ",\n", order).select(F.concat(F.lit("[\n"), "value", F.lit("\n]")).alias("value"))
    # one record per file keeps each file a single JSON document
    arrays.select("value").write.mode(mode).option("maxRecordsPerFile", 1).text(path)


def _sql_literal(c: Column, dtype) -> Column:
    if isinstance(dtype, BooleanType):
        v = F.when(c, F.lit("1")).when(~c, F.lit("0"))  # NULL stays NULL
    elif isinstance(dtype, NumericType):
        v = c.cast("string")
    elif isinstance(dtype, BinaryType):
        v = F.when(F.octet_length(c) == 0, F.lit("''")).otherwise(F.concat(F.lit("0x"), F.hex(c)))
    elif isinstance(dtype, TimestampNTZType):
        v = F.concat(F.lit("'"), F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("'"))
    elif isinstance(dtype, TimestampType):
        v = F.concat(F.lit("'"), F.date_format(F.to_utc_timestamp(c, F.current_timezone()),
                                               "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("'"))
    elif isinstance(dtype, DateType):
        v = F.concat(F.lit("'"), F.date_format(c, "yyyy-MM-dd"), F.lit("'"))
    else:
        s = c.cast("string") if not isinstance(dtype, StringType) else c
        for raw, esc in (("\\", "\\\\"), ("'", "\\'"), ("\u0000", "\\0"), ("\n", "\\n"),
                         ("\r", "\\r"), ("\u001a", "\\Z")):
            s = F.replace(s, F.lit(raw), F.lit(esc))
        v = F.concat(F.lit("'"), s, F.lit("'"))
    return F.coalesce(v, F.lit("NULL"))


def write_sql_dump(df: DataFrame, path: str, table: str, *, rows_per_statement: int = 500,
                   column_list: bool = False, mode: str = "error", order: Sequence[OrderItem] = ()) -> None:
    """Extended INSERT statements, one per line, as mysqldump writes them (timestamps in UTC, binary
    values as hexadecimal literals)."""
    fields = [_sql_literal(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    tup = F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")"))
    cols = " (" + ",".join(f"`{c}`" for c in df.columns) + ")" if column_list else ""
    stmts = _chunked(df, rows_per_statement, tup, ",", order).select(
        F.concat(F.lit(f"INSERT INTO `{table}`{cols} VALUES "), "value", F.lit(";")).alias("value"))
    stmts.write.mode(mode).text(path)
