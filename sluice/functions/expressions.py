"""Scalar column expressions shared by the operators (all built-in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the survey id format: "1" + survey number + run date (yyyyMMdd)
# + (row number + 100000).
SURVEY_ID_PREFIX = "1"
SURVEY_ID_OFFSET = 100000


def survey_id_expr(survey_col: Column, run_date: str, nr_col: Column) -> Column:
    """`'1' || survey || run_date || (nr + 100000)` with explicit casts.

    19 characters while nr <= 899999; one more digit per decade beyond that.
    """
    return F.concat(F.lit(SURVEY_ID_PREFIX), survey_col.cast("string"), F.lit(run_date),
                    (nr_col + F.lit(SURVEY_ID_OFFSET)).cast("string"))


def year_month_of(run_date: str) -> Column:
    """Partition value `yyyyMM` taken from the run date (not from the row)."""
    return F.lit(run_date[:6])


def date_stamp(c: Column) -> Column:
    """`yyyyMMdd` of a date or timestamp."""
    return F.date_format(c, "yyyyMMdd")


def minute_stamp(c: Column) -> Column:
    """`yyyyMMddHHmm` of a date or timestamp."""
    return F.date_format(c, "yyyyMMddHHmm")


def expires(c: Column, hours: float) -> Column:
    """The timestamp some hours later."""
    return c + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600))


def blank_to_null(c: Column) -> Column:
    """Empty string to NULL (the conflating rule of the dump converter, opt-in here)."""
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def hash_hex(seed: str | int, name: str, idx: Column) -> Column:
    """md5 over `seed|name|idx`: a deterministic, engine-independent random source."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(name), idx.cast("string")))


def hex_to_long(hex_col: Column, start: int, length: int) -> Column:
    """Unsigned integer from `length` hex digits at 1-based `start` (length <= 15)."""
    return F.conv(F.substring(hex_col, start, length), 16, 10).cast("long")
