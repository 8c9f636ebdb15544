"""Equi-join whose frequent keys do not meet in one task, planned by the library and not at run time.

1. A frequent-items sketch of the key (Misra-Gries: a counter for each of `sketch` values in every
   task, merged by adding and cutting back) finds every key that holds more than 1 / `sketch` of the
   rows; its candidates are then counted exactly, and those above `share` are hot.
2. Rows of hot keys join the other side's rows of these keys. If those are few (measured), they are
   broadcast; else each is repeated for every one of `salts` salts and the hot rows are dealt over
   the salts, so a key's rows meet in as many tasks.
3. All other rows join by a shuffle on the key, as usual. Rows with a null key match nothing: in a left
   join they go straight to the result.

The result is that of the plain join, whatever is found hot.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import bounded_broadcast
from ..session import ship_package

_KEY, _SALT, _N = "__sl_key", "__sl_salt", "__sl_n"


def _trim(counts: dict, most: int) -> dict:
    """Cut back to `most` counters: the (most + 1)-th largest count is taken off every one."""
    if len(counts) <= most:
        return counts
    off = sorted(counts.values(), reverse=True)[most]
    return {k: n - off for k, n in counts.items() if n > off}


def _sketch(most: int):
    """Counters of each task's (or each group of counters') values, as (key, n)."""
    def run(batches):
        counts: dict = {}
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            n = batch.column(1) if batch.num_columns > 1 else None
            t = pa.table({"k": batch.column(0), "n": n if n is not None else pa.array([1] * batch.num_rows, pa.int64())})
            t = t.group_by("k").aggregate([("n", "sum")])
            for k, c in zip(t.column("k").to_pylist(), t.column("n_sum").to_pylist()):
                counts[k] = counts.get(k, 0) + c
            if len(counts) > 4 * most:
                counts = _trim(counts, most)
        counts = _trim(counts, most)
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), kind), pa.array(list(counts.values()), pa.int64())], names=[_KEY, _N])
    return run


def hot_keys(df: DataFrame, key: Column | str, *, share: float = 0.01, sketch: int | None = None) -> list:
    """The non-null values of `key` that hold more than `share` of all rows (1 / share values at most)."""
    if not 0 < share <= 1:
        raise ValueError("share is in (0, 1]")
    most = sketch or int(2 / share) + 1
    if most < 1 / share:
        raise ValueError("a sketch of so few counters can miss keys of this share")
    ship_package(df.sparkSession)
    keys = df.select((F.col(key) if isinstance(key, str) else key).alias(_KEY))
    kind = keys.schema[_KEY].dataType.simpleString()
    values = keys.where(F.col(_KEY).isNotNull())
    tasks = values.mapInArrow(_sketch(most), f"{_KEY} {kind}, {_N} long")
    # every task has at most `most` counters; they are added up in groups, then once more
    groups = tasks.repartition(64).mapInArrow(_sketch(most), f"{_KEY} {kind}, {_N} long")
    merged = groups.coalesce(1).mapInArrow(_sketch(most), f"{_KEY} {kind}, {_N} long").select(_KEY).collect()
    found = [r[0] for r in merged]
    if not found:
        return []
    total = df.count()
    counts = values.where(F.col(_KEY).isin(found)).groupBy(_KEY).agg(F.count(F.lit(1)).alias(_N))
    return sorted((r[_KEY] for r in counts.where(F.col(_N) > share * total).collect()), key=repr)


def skew_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner", *,
              share: float = 0.01, salts: int | None = None, hot: list | None = None) -> DataFrame:
    """`left` joined to `right` on left_key = right_key (inner or left), as `left.join(right, ...)` gives it; the
    frequent keys of the left side are treated as above.

    hot: the hot keys, if they are known; else `hot_keys(left, left_key, share=share)`.
    salts: tasks for each hot key (default: the shuffle partitions)."""
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    spark = left.sparkSession
    lk, rk = F.col(f"`{left_key}`"), F.col(f"`{right_key}`")
    keys = hot_keys(left, lk, share=share) if hot is None else [k for k in hot if k is not None]
    valid = left.where(lk.isNotNull())
    is_hot = lk.isin(keys) if keys else F.lit(False)
    out = valid.where(~is_hot).join(right.where(rk.isNotNull()).hint("merge"), F.expr(f"`{left_key}` = `{right_key}`"), how)
    if keys:
        few = bounded_broadcast(right.where(rk.isin(keys)))
        rows = valid.where(is_hot)
        if "broadcast" in few._jdf.queryExecution().logical().toString().lower():
            met = rows.join(few, F.expr(f"`{left_key}` = `{right_key}`"), how)
        else:
            n = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
            # by the row's content, not at random: a task that runs again deals its rows alike
            dealt = rows.withColumn(_SALT, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.monotonically_increasing_id()), F.lit(n)))
            copies = right.where(rk.isin(keys)).withColumn(_SALT + "_r", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
            met = dealt.join(copies.hint("merge"), F.expr(f"`{left_key}` = `{right_key}` AND {_SALT} = {_SALT}_r"), how).drop(_SALT, _SALT + "_r")
        out = out.union(met.select(*out.columns))
    if how == "left":
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
        out = out.union(left.where(lk.isNull()).select(*[F.col(f"`{c}`") for c in left.columns], *nulls))
    return out
