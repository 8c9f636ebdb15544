"""Global row numbers and positional zip without funnelling rows through one partition.

`row_number() OVER (ORDER BY ...)` with no PARTITION BY plans an `Exchange SinglePartition`:
every row goes to one task. `with_row_number` computes the same numbers with the work spread
over the cluster:

1. Range-partition by a narrow key and sort inside each partition by the total order -- the
   only shuffle. Any leading part of the total order is a right key, because rows that are
   equal on it meet in one partition. Spark samples the key into the driver, so it must not be
   as wide as the rows: it is the caller's order and the columns behind it in the total order
   up to the first wide one, a string by its first characters (a cut value orders nothing
   behind it, so it is the last). Orders given as Columns can't be cut; where rows are wide, the
   size of the sample is then set from the measured row width.
2. Stamp each row with its partition and position and write that to a table under
   `spark.checkpoint.dir`. Range bounds are sampled per shuffle, so counting and numbering must
   read one materialisation; the written table also cuts lineage, so a lost executor re-reads
   files instead of re-running the sort. `sluice.session.release` (or a `scratch_scope`)
   deletes it when the result has been used.
3. Count rows per partition (reads one column). If one partition holds many times its share, a
   value of the key is a heavy hitter: steps 1 and 2 are done again with a longer key. The
   longest value of each string column is read off the written table; strings that were never
   cut order what is behind them, so the key goes on to the first column that would be cut. If
   a partition is heavy still (or nothing was cut), the key is the whole total order and,
   behind it, the index of the input partition, so a row repeated in a third of all
   rows is split into pieces of at most one input partition each. (Identical rows are
   interchangeable; the index is stable under recomputation.) The sample of this wide key is
   bounded by the measured row width, too.
4. Turn counts into offsets (one row per partition: bounded by the partition count, safe to
   broadcast) and add offset + position + 1.

Ties: the order is extended with every remaining column, so only identical rows tie, and
identical rows are interchangeable. The result matches the single-partition window.

`unique_order=True` says the order's columns are unique: they are the key, and step 3 is
skipped. The numbers stay right even if the claim is wrong; only the skew protection is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

from ..functions.ordering import OrderItem, as_sort_columns, directed, name_of, total_items, total_order
from ..session import release, scratch_path

_K = "__sl_k"
_P = "__sl_part"
_LI = "__sl_local"
_CNT = "__sl_cnt"
_OFF = "__sl_off"

#: Characters of a string that go into a range key.
KEY_CHARS = 64
#: A partition with so many times its even share of the rows (and so many rows) is heavy.
HEAVY, HEAVY_ROWS = 8, 100_000
#: Bytes that a range sample may have on the driver, and Spark's own rows for each partition.
SAMPLE_BYTES, SAMPLE_ROWS = 256 << 20, 100
_SAMPLE_CONF = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _wide(t: DataType) -> bool:
    return isinstance(t, (StringType, BinaryType, ArrayType, StructType))


def _narrow_key(df: DataFrame, order: Sequence[OrderItem], short: Sequence[str] = ()) -> tuple[list[Column], bool]:
    """(range key, whether it may hold wide values): a leading part of the total order. short: string
    columns without a value that would be cut."""
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    keys, unknown = [], False
    for i, item in enumerate(total_items(df, order)):
        t = types.get(n.lower()) if (n := name_of(item)) is not None else None
        if t is None:  # an expression or a nested field: as it is
            keys += as_sort_columns([item])
            unknown = True
        elif not _wide(t) or n.lower() in short:
            keys.append(directed(item, _q(n)))
        elif isinstance(t, StringType):
            return [*keys, directed(item, F.substring(_q(n), 1, KEY_CHARS))], unknown
        elif keys:
            break
        else:
            return [directed(item, _q(n))], True
    return keys, unknown


def _short_strings(df: DataFrame) -> list[str]:
    """The string columns (lower-cased names) whose values all have KEY_CHARS characters at most (one aggregate)."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not names:
        return []
    longest = df.agg(*[F.max(F.char_length(_q(n))) for n in names]).first()
    return [n.lower() for n, most in zip(names, longest) if (most or 0) <= KEY_CHARS]


def _row_bytes(df: DataFrame) -> float:
    """Mean bytes of a row's wide columns (one aggregate)."""
    wide = [F.coalesce(F.octet_length(c if isinstance(t, (StringType, BinaryType)) else F.to_json(c)), F.lit(0))
            for c, t in ((_q(f.name), f.dataType) for f in df.schema.fields) if _wide(t)]
    if not wide:
        return 0.0
    return float(df.agg(F.avg(sum(wide[1:], wide[0]))).first()[0] or 0.0)


@contextmanager
def _sample_bound(spark: SparkSession, row_bytes: float, parts: int):
    """Bound the bytes of range samples taken inside the block (Spark oversamples threefold)."""
    rows = int(SAMPLE_BYTES / (max(row_bytes, 1.0) * 3 * max(parts, 1)))
    if rows >= SAMPLE_ROWS:
        yield
        return
    old = spark.conf.get(_SAMPLE_CONF, None)
    spark.conf.set(_SAMPLE_CONF, str(max(1, rows)))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_SAMPLE_CONF)
        else:
            spark.conf.set(_SAMPLE_CONF, old)


def _write_stamped(df: DataFrame, cols: list[str], range_keys, sort_cols, num_partitions: int | None) -> tuple[DataFrame, str]:
    """Rows range-partitioned and sorted, with partition id and position, written and read back."""
    spark = df.sparkSession
    ranged = (df.repartitionByRange(num_partitions, *range_keys) if num_partitions
              else df.repartitionByRange(*range_keys))
    stamped = (ranged.sortWithinPartitions(*sort_cols)
               .select(*[_q(c) for c in cols],
                       F.spark_partition_id().alias(_P),
                       # position inside the partition: the id counts rows in task order
                       (F.monotonically_increasing_id()
                        - F.shiftleft(F.spark_partition_id().cast("long"), 33)).alias(_LI)))
    path = scratch_path(spark, "rownum")
    stamped.write.parquet(path)
    return spark.read.schema(stamped.schema).parquet(path), path


def _heavy(table: DataFrame, parts: int) -> bool:
    """Whether one range partition holds many times its share of the rows."""
    most, total = table.groupBy(_P).count().agg(F.max("count"), F.sum("count")).first()
    return bool(total) and most > max(HEAVY_ROWS, HEAVY * total / parts)


def _materialise(df: DataFrame, order: Sequence[OrderItem], num_partitions: int | None, unique_order: bool) -> DataFrame:
    spark, cols, sort_cols = df.sparkSession, df.columns, total_order(df, order)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys, wide = (as_sort_columns(order), True) if unique_order else _narrow_key(df, order)
    width = _row_bytes(df) if wide else 0.0
    key_bytes = width or KEY_CHARS + 8.0 * len(keys)
    with _sample_bound(spark, key_bytes, parts):
        table, path = _write_stamped(df, cols, keys, sort_cols, num_partitions)
    if unique_order or not _heavy(table, parts):
        return table
    short = _short_strings(table.select(*[_q(c) for c in cols]))
    release(spark, path)
    longer, wide_too = _narrow_key(df, order, short)
    if len(longer) > len(keys) and not wide_too:
        with _sample_bound(spark, (KEY_CHARS + 8.0) * len(longer), parts):
            table, path = _write_stamped(df, cols, longer, sort_cols, num_partitions)
        if not _heavy(table, parts):
            return table
        release(spark, path)
    tagged = df.select(*[_q(c) for c in cols], F.spark_partition_id().alias(_K))
    full = sort_cols + [F.col(_K).asc()]
    with _sample_bound(spark, width or _row_bytes(df), parts):
        return _write_stamped(tagged, cols, full, full, num_partitions)[0]


def _offsets(table: DataFrame) -> DataFrame:
    """(partition, rows before it, rows): one row per range partition, bounded by their number."""
    before = Window.orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    return (table.groupBy(_P).agg(F.count(F.lit(1)).alias(_CNT))
            .select(_P, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF), _CNT))


def _numbered(table: DataFrame, name: str, up_to: int | None = None) -> DataFrame:
    """The stamped rows with their numbers; with `up_to` only the first ones: whole range partitions
    drop out with the offsets, before any further exchange."""
    cols = [c for c in table.columns if c not in (_P, _LI)]
    offsets = _offsets(table).drop(_CNT)
    if up_to is not None:
        offsets = offsets.where(F.col(_OFF) < up_to)
    out = (table.join(F.broadcast(offsets), _P)
           .select(*[_q(c) for c in cols], (F.col(_OFF) + F.col(_LI) + 1).alias(name)))
    return out if up_to is None else out.where(F.col(name) <= up_to)


def with_row_number(df: DataFrame, order: Sequence[OrderItem], name: str = "nr", *,
                    method: str = "range", num_partitions: int | None = None,
                    unique_order: bool = False) -> DataFrame:
    """Add `name` = 1..N in the order given (ties broken by the remaining columns).

    method="range"  : distributed algorithm described in the module docstring (default).
    method="window" : the single-partition window, the definition; small inputs only.
    """
    if name in df.columns:
        raise ValueError(f"column {name!r} already exists")
    if method == "window":
        return df.withColumn(name, F.row_number().over(Window.orderBy(*total_order(df, order))).cast("long"))
    if method != "range":
        raise ValueError(f"unknown method {method!r}")
    return _numbered(_materialise(df, order, num_partitions, unique_order), name)


def zip_by_position(left: DataFrame, right: DataFrame, left_order: Sequence[OrderItem],
                    right_order: Sequence[OrderItem], *, method: str = "range",
                    unique_orders: bool = False) -> DataFrame:
    """Pair the i-th row of `left` with the i-th row of `right`; the shorter side wins.

    Each side is numbered in its own order (extended to a total order), the longer side is cut to
    the shorter one's length before the exchange, and the two are inner-joined on the number,
    which is unique on both sides, so the join cannot skew.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    rn = "__sl_pos"
    if method != "range":
        lhs = with_row_number(left, left_order, rn, method=method)
        return lhs.join(with_row_number(right, right_order, rn, method=method), rn, "inner").drop(rn)
    lhs = _materialise(left, left_order, None, unique_orders)
    rhs = _materialise(right, right_order, None, unique_orders)
    shorter = min(lhs.count(), rhs.count())
    return _numbered(lhs, rn, shorter).join(_numbered(rhs, rn, shorter), rn, "inner").drop(rn)
