"""CSV and JSON-array sources with explicit NULL and time-zone rules.

NULL vs empty string: a CSV writer that quotes empty strings (`""`) and leaves NULLs blank
keeps the two apart, but Spark's reader maps both to NULL by default. Reading with a NULL
marker that never occurs keeps blank -> NULL and `""` -> "" (pass `empty_as_null=True` to
conflate them on purpose).

Time zones: `tz` names the zone the file's wall-clock timestamps were written in. Instant
columns (TIMESTAMP) are parsed in that zone; wall-clock columns (TIMESTAMP_NTZ) are shifted
from `tz` to UTC, so every source lands in UTC.
"""

from __future__ import annotations

import csv
import io
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from ..functions.expressions import blank_to_null
from .ranges import JsonObjects, QuotedLines, Ranges

# A NULL marker that cannot occur in text data (U+0000).
NULL_SENTINEL = "\u0000"
# Full microsecond precision both ways (Spark's defaults stop at milliseconds when writing).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_LTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def normalize_zone(df: DataFrame, tz: str | None) -> DataFrame:
    """Shift wall-clock (NTZ) timestamp columns from `tz` to UTC."""
    if not tz or tz.upper() in ("UTC", "Z", "+00:00", "ETC/UTC"):
        return df
    return df.select(*[
        F.convert_timezone(F.lit(tz), F.lit("UTC"), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, TimestampNTZType) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def _empty_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[blank_to_null(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _as_struct(spark: SparkSession, schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema


def _inferred(spark: SparkSession, fmt: str, values: DataFrame, options: dict[str, str]) -> StructType:
    """The schema that Spark's reader infers from records (one pass over them)."""
    texts = getattr(values._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark._jsparkSession.read().options(options)
    return StructType.fromJson(json.loads(getattr(reader, fmt)(texts).schema().json()))


def _header_names(text: str, sep: str) -> list[str]:
    return next(csv.reader(io.StringIO(text, newline=""), delimiter=sep))


def _safe_names(names: list[str]) -> list[str]:
    """Column names of a header: blank ones numbered, repeated ones with their number."""
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def _read_csv_ranges(spark: SparkSession, path: str | list[str], schema: StructType | None, header: bool, sep: str,
                     options: dict[str, str]) -> DataFrame:
    ranges = Ranges(spark, path, QuotedLines(sep))
    expected = schema.fieldNames() if schema is not None else None
    if header and schema is None:
        first = ranges.first_record()
        expected = _header_names(first, sep) if first else []

    def is_record(text: str) -> bool:
        got = _header_names(text, sep)
        if [n.lower() for n in got] != [n.lower() for n in expected]:
            raise ValueError(f"CSV header {got} is not {expected}")
        return False
    rows = ranges.records(is_record if header else None)
    if schema is None:
        found = _inferred(spark, "csv", rows, options | {"inferSchema": "true"}).fields
        names = _safe_names(expected) if header else [f.name for f in found]
        schema = StructType([StructField(n, found[i].dataType if i < len(found) else StringType()) for i, n in enumerate(names)])
    if not schema.fields:
        return spark.createDataFrame([], schema)
    ddl = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(schema.fields))
    parsed = rows.select(F.from_csv("value", ddl, options).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(f.name) for i, f in enumerate(schema.fields)])


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None, *,
             header: bool = True, empty_as_null: bool = False, tz: str | None = None,
             multiline: bool = True, sep: str = ",") -> DataFrame:
    """CSV with a header; lines end in \\n, \\r\\n or \\r. Without `schema` the types are inferred (an extra
    pass over the data; give a schema for large inputs); with one, a header whose names or order
    differ from it fails the load. Line breaks inside quoted values are read by default, by many
    tasks from one file (`sources/ranges.py`); `multiline=False` leaves lines to Spark's reader and is
    for files known to hold none. Where a file's first line does not end in \\r, a \\r at the end of
    an unquoted last value belongs to it."""
    options = {"sep": sep, "escape": '"', "nullValue": NULL_SENTINEL, "mode": "FAILFAST"}
    if tz:
        options["timeZone"] = tz
    fixed = _as_struct(spark, schema) if schema is not None else None
    if multiline:
        df = _read_csv_ranges(spark, path, fixed, header, sep, options | {"multiLine": "true"})
    else:
        r = spark.read.options(**options).option("header", header).option("enforceSchema", not header)
        r = r.schema(fixed) if fixed is not None else r.option("inferSchema", True)
        df = r.csv(path)
    if empty_as_null:
        df = _empty_to_null(df)
    return normalize_zone(df, tz)


def read_json_array(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None, *,
                    tz: str | None = None) -> DataFrame:
    """Files that each hold one JSON array of objects (or objects side by side), read by many tasks from
    one file (`sources/ranges.py`).

    Give `schema`: a file holding `[]` infers an empty schema and an all-NULL field infers as
    string. Text that is no object of the array fails the load."""
    options = {"mode": "FAILFAST"} | ({"timeZone": tz} if tz else {})
    rows = Ranges(spark, path, JsonObjects()).records()
    fixed = _as_struct(spark, schema) if schema is not None else _inferred(spark, "json", rows, options)
    if not fixed.fields:
        return spark.createDataFrame([], fixed)
    parsed = rows.select(F.from_json("value", fixed, options).alias("r"))
    return normalize_zone(parsed.select(*[F.col("r").getField(n).alias(n) for n in fixed.fieldNames()]), tz)


#: Types of a CSV column, from the narrowest; a column has the narrowest that holds all its values.
CSV_TYPES = ("null", "boolean", "bigint", "decimal", "double", "date", "timestamp_ntz", "timestamp", "string")
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def csv_types(spark: SparkSession, path: str | list[str], *, header: bool = True, sep: str = ",") -> DataFrame:
    """column, position, type, values, nulls, breaks: the type of every column of CSV files, in one pass.

    A column's state is a row of counts, maxima and minima (values that each type holds, digits before
    and behind the point, for each type the smallest value that it does not hold), so states of
    parts of the files merge to that of all, however they are split. Types widen along
    null < boolean < string; null < bigint < decimal(p, s) < double < string; null < date <
    timestamp_ntz < string; null < timestamp < string (timestamps with a zone). breaks: the smallest
    value (in code-point order) that kept the column from the next narrower type of its kind; NULL
    where there is none. Blank is NULL, `""` is a string."""
    ranges = Ranges(spark, path, QuotedLines(sep))
    first = ranges.first_record()
    if first is None:
        return spark.createDataFrame([], "column string, position int, type string, values long, nulls long, breaks string")
    names = _header_names(first, sep)
    width = len(names)

    def is_record(text: str) -> bool:
        if [n.lower() for n in _header_names(text, sep)] != [n.lower() for n in names]:
            raise ValueError(f"CSV header is not {names}")
        return False
    rows = ranges.records(is_record if header else None)
    options = {"sep": sep, "escape": '"', "nullValue": NULL_SENTINEL, "mode": "FAILFAST", "multiLine": "true"}
    parsed = rows.select(F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)), options).alias("r"))
    state = parsed.agg(*[x.alias(f"{k}{i}") for i in range(width) for k, x in _column_state(F.col(f"r.c{i}")).items()])
    labels = _safe_names(names) if header else [f"_c{i}" for i in range(width)]
    kinds = list(_column_state(F.lit("")))
    long = state.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit(i).alias("position"), *[F.col(f"{k}{i}").alias(k) for k in kinds])
        for i, n in enumerate(labels)])))
    return long.select("column", "position", *_decided())


def _column_state(v: Column) -> dict[str, Column]:
    number = v.rlike(_NUMBER)
    digits = F.regexp_replace(v, r"^[+-]?0*", "")
    before = F.char_length(F.regexp_extract(digits, r"^(\d*)", 1))
    behind = F.char_length(F.regexp_extract(v, r"\.(\d*)$", 1))
    zone = v.rlike(r"[ T]\d{1,2}:\d{2}.*(Z|[+-]\d{2}:?\d{2})$")
    day = v.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & v.try_cast("date").isNotNull()
    fits = {"boolean": F.lower(v).isin("true", "false"), "bigint": v.rlike(r"^[+-]?\d+$") & v.try_cast("bigint").isNotNull(),
            "decimal": number, "double": v.try_cast("double").isNotNull() & v.rlike(r"[0-9]|(?i)^[+-]?(nan|inf(inity)?)$") & ~v.rlike("[dDfF]$"),
            "date": day, "timestamp_ntz": (day | v.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[ T]")) & v.try_cast("timestamp_ntz").isNotNull() & ~zone,
            "timestamp": zone & v.try_cast("timestamp").isNotNull()}
    out = {"values": F.count(v), "nulls": F.count_if(v.isNull()),
           "before": F.max(F.when(number, before)), "behind": F.max(F.when(number, behind))}
    for kind, ok in fits.items():
        out[f"n_{kind}"] = F.count_if(ok)
        out[f"not_{kind}"] = F.min(F.when(~ok, v))
    return out


def _decided() -> list[Column]:
    values, scale = F.col("values"), F.coalesce("behind", F.lit(0))
    precision = F.greatest(F.coalesce("before", F.lit(0)) + scale, F.lit(1))
    # each type with its condition and the value that the next narrower type of its kind does not hold
    order = [("null", values == 0, None), ("boolean", F.col("n_boolean") == values, None), ("bigint", F.col("n_bigint") == values, None),
             ("decimal", (F.col("n_decimal") == values) & (precision <= 38), "bigint"), ("double", F.col("n_double") == values, "decimal"),
             ("date", F.col("n_date") == values, None), ("timestamp_ntz", F.col("n_timestamp_ntz") == values, "date"),
             ("timestamp", F.col("n_timestamp") == values, None)]
    kind, breaks = None, None
    for name, holds, below in order:
        label = F.concat(F.lit("decimal("), precision.cast("string"), F.lit(","), scale.cast("string"), F.lit(")")) if name == "decimal" else F.lit(name)
        found = F.col(f"not_{below}") if below else F.lit(None).cast("string")
        kind = F.when(holds, label) if kind is None else kind.when(holds, label)
        breaks = F.when(holds, found) if breaks is None else breaks.when(holds, found)
    # text: what kept it from the type that most of its values have (the first of equals)
    most = F.greatest(*[F.col(f"n_{k}") for k in ("boolean", "double", "timestamp_ntz", "timestamp")])
    text = None
    for k in ("double", "timestamp_ntz", "boolean", "timestamp"):
        holds = (F.col(f"n_{k}") == most) & (most > 0)
        text = F.when(holds, F.col(f"not_{k}")) if text is None else text.when(holds, F.col(f"not_{k}"))
    return [kind.otherwise("string").alias("type"), values, F.col("nulls"), breaks.otherwise(text).alias("breaks")]
