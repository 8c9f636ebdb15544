"""Deterministic synthetic tables of any size from a schema.

All columns come from one `spark.range(n)` in one projection: no rows are built on the
driver, and no positional join is needed to put key, content and fixed columns side by side.
Every value is a function of (seed, column name, row index) through md5, so the same call
gives the same table on any cluster size, and the same values can be computed in SQL.

Per column (fixed value rules):
- string      10 characters of [0-9A-Z]
- int/long    0..999 / 0..999999 (short, byte: 0..99)
- double      0.00..9999.99 (decimal: the same, cast)
- boolean     true/false
- timestamp   `base_ts` minus 1.00 to 7.00 days in steps of 0.01 day
- date        date of `base_ts` minus 1 to 7 days
- key column  `<prefix>_<stamp>_<i>` where i runs over a permutation of 0..n-1 that depends
              only on the prefix, so two tables using one prefix get the same keys row by row
              (`shuffle="affine"`: i -> a * i + b mod n; "feistel": unrelated neighbours,
              `functions/permute.py`)
- fixed       one value of a list (uniformly), or NULL for `None`
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType,
                               FloatType, IntegerType, LongType, ShortType, StringType, StructType,
                               TimestampNTZType, TimestampType)

from ..functions.expressions import hash_hex, hex_to_long
from ..functions.permute import permuted

_ID = "__sl_id"
# Fixed value rules (see module docstring).
STRING_LEN = 10
SECONDS_PER_STEP = 864          # 0.01 day
STEP_MIN, STEP_SPAN = 100, 601  # 1.00 .. 7.00 days
PERM_MULTIPLIER_MAX = 2147483647  # largest candidate multiplier for the key permutation


def _is_prime(k: int) -> bool:
    if k < 2:
        return False
    return all(k % d for d in range(2, int(math.isqrt(k)) + 1))


def perm_multiplier(n: int) -> int:
    """Largest prime <= 2^31-1 that does not divide n (so i -> a*i+b mod n is a bijection)."""
    a = PERM_MULTIPLIER_MAX
    while not _is_prime(a) or (n and n % a == 0):
        a -= 1
    return a


def perm_offset(prefix: str, seed: int | str) -> int:
    return int(hashlib.md5(f"{seed}|{prefix}".encode()).hexdigest()[:8], 16)


def key_column(prefix: str, stamp: str, idx: Column, n: int, seed: int | str, shuffle: str = "affine") -> Column:
    if shuffle == "feistel":
        return F.concat_ws("_", F.lit(prefix), F.lit(stamp), permuted(idx, n, f"{seed}|{prefix}").cast("string"))
    a, b = perm_multiplier(n), perm_offset(prefix, seed)
    # decimal arithmetic: a*i overflows 64 bits for tables beyond ~4e9 rows
    moved = ((idx.cast("decimal(38,0)") * F.lit(a) + F.lit(b)) % F.lit(n)).cast("long")
    return F.concat_ws("_", F.lit(prefix), F.lit(stamp), moved.cast("string"))


def value_column(name: str, dtype: DataType, idx: Column, seed: int | str, base_ts: str) -> Column:
    h = hash_hex(seed, name, idx)
    x = hex_to_long(h, 13, 8)
    if isinstance(dtype, StringType):
        return F.lpad(F.conv(F.substring(h, 1, 12), 16, 36), STRING_LEN, "0")
    if isinstance(dtype, IntegerType):
        return (x % 1000).cast(dtype)
    if isinstance(dtype, LongType):
        return x % 1000000
    if isinstance(dtype, (ShortType, ByteType)):
        return (x % 100).cast(dtype)
    if isinstance(dtype, (DoubleType, FloatType, DecimalType)):
        return ((x % 1000000) / F.lit(100.0)).cast(dtype)
    if isinstance(dtype, BooleanType):
        return (x % 2) == 1
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        secs = (F.lit(STEP_MIN) + x % STEP_SPAN) * SECONDS_PER_STEP
        base = F.lit(base_ts).cast(dtype)
        return base - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
    if isinstance(dtype, DateType):
        return F.date_sub(F.lit(base_ts).cast("date"), (F.lit(1) + x % 7).cast("int"))
    raise TypeError(f"no generator for column {name!r} of type {dtype.simpleString()}")


def choice_column(name: str, dtype: DataType, values: Sequence | None, idx: Column,
                  seed: int | str) -> Column:
    if values is None or len(values) == 0:
        return F.lit(None).cast(dtype)
    if len(values) == 1:
        return F.lit(values[0]).cast(dtype)
    x = hex_to_long(hash_hex(seed, name, idx), 13, 8)
    arr = F.array(*[F.lit(v).cast(dtype) for v in values])
    return F.element_at(arr, (x % len(values) + 1).cast("int"))


def synth_table(spark: SparkSession, schema: StructType, n: int, *,
                keys: Mapping[str, str] | None = None,
                choices: Mapping[str, Sequence | None] | None = None,
                seed: int | str = 42, stamp: str = "202211251200",
                base_ts: str = "2022-11-25 12:00:00",
                num_partitions: int | None = None, shuffle: str = "affine") -> DataFrame:
    """`n` rows in `schema`'s column order. `keys` maps string columns to id prefixes,
    `choices` maps columns to their allowed values (None: always NULL); `shuffle` is the permutation
    of the keys ("affine" or "feistel")."""
    if shuffle not in ("affine", "feistel"):
        raise ValueError("shuffle is 'affine' or 'feistel'")
    keys = {k.lower(): v for k, v in (keys or {}).items()}
    choices = {k.lower(): v for k, v in (choices or {}).items()}
    known = {f.name.lower() for f in schema.fields}
    unknown = (set(keys) | set(choices)) - known
    if unknown:
        raise ValueError(f"columns not in schema: {sorted(unknown)}")
    ids = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(n)
    idx = F.col("id")
    cols = []
    for f in schema.fields:
        lname = f.name.lower()
        if lname in keys:
            if not isinstance(f.dataType, StringType):
                raise TypeError(f"key column {f.name!r} must be a string column")
            c = key_column(keys[lname], stamp, idx, n, seed, shuffle)
        elif lname in choices:
            c = choice_column(f.name, f.dataType, choices[lname], idx, seed)
        else:
            c = value_column(f.name, f.dataType, idx, seed, base_ts)
        cols.append(c.alias(f.name))
    return ids.select(*cols)
