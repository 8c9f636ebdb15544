"""Catalog table writes with one validated mode and exactly one write.

Modes
- "append"               add rows (bag union); creates the table if it does not exist.
- "overwrite"            replace the whole table.
- "overwrite_partitions" replace only the partitions present in the frame (dynamic overwrite).
- "truncate_load"        replace all rows by a staged load (`sinks/staged.py`): the new rows are written
                         beside the table and checked, then its locations are swapped, so the old
                         rows stay until then and a load that fails leaves them. A frame that reads
                         the table itself is refused (`staged_load` takes one).

With `only_changed`, "overwrite_partitions" leaves alone the partitions whose rows are the same
already: number of rows and an order-free hash of them (two sums of 64-bit row hashes), which the
frame and the table's partitions of the same values are compared by. The frame is computed twice.

With `run` (survey and run date, say), "append" replaces the rows that an earlier run of that key
added, so a job may be repeated.

An existing table's schema wins: the frame is aligned to it first (case-insensitive names,
missing -> typed NULL, extra -> dropped, target order) and inserted by position.

Partitioned writes are rebalanced on the partition columns first: AQE splits a partition
value that holds a large share of the rows over several tasks (and files) instead of
sending it to one task, and merges small ones.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schema import Drift, align_to
from .staged import append_run, staged_load

log = logging.getLogger(__name__)

MODES = ("append", "overwrite", "overwrite_partitions", "truncate_load")
_OVERWRITE_CONF = "spark.sql.sources.partitionOverwriteMode"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


@contextmanager
def _session_conf(spark: SparkSession, key: str, value: str):
    """Set a session conf for one write and restore it afterwards."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def reads_table(df: DataFrame, table: str) -> bool:
    """Whether the frame reads files of the table (by file names, whatever the read is called)."""
    spark = df.sparkSession
    found = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location"]
    if not found:
        return False

    def bare(path: str) -> str:
        return re.sub(r"^file:/*", "/", unquote(path)).rstrip("/") + "/"
    return any(bare(f).startswith(bare(found[0])) for f in df.inputFiles())


def _rebalanced(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *partitions) if partitions else df


def _print_of_rows(df: DataFrame, parts: Sequence[str], end: str) -> DataFrame:
    """Partition values with the number of their rows and an order-free hash of them."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in parts] or [F.lit(1)]

    def total(*salt):
        return F.sum(F.xxhash64(*rest, *[F.isnull(c) for c in rest], *salt).cast("decimal(38,0)"))
    keys = [F.coalesce(F.col(f"`{p}`").cast("string"), F.lit("\0")).alias(f"__sl_p{i}") for i, p in enumerate(parts)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"__sl_n{end}"), total().alias(f"__sl_a{end}"),
                                 total(F.lit(1)).alias(f"__sl_b{end}"))


def changed_partitions(new: DataFrame, table: str, parts: Sequence[str]) -> DataFrame:
    """The partition values (as text, `__sl_p0`, ...) of `new` whose rows in the table are not the same."""
    keys = [f"__sl_p{i}" for i in range(len(parts))]
    own = _print_of_rows(new, parts, "1")
    held = new.sparkSession.table(table).join(F.broadcast(own.select(*keys)), [
        F.coalesce(F.col(f"`{p}`").cast("string"), F.lit("\0")) == F.col(k) for p, k in zip(parts, keys)], "left_semi")
    both = own.join(_print_of_rows(held, parts, "0"), keys, "left")
    same = F.expr(" AND ".join(f"__sl_{x}1 <=> __sl_{x}0" for x in "nab"))
    return both.where(~same).select(*keys)


def write_table(df: DataFrame, table: str, partitions: Sequence[str] = (), mode: str = "append", *,
                dry_run: bool = False, path: str | None = None, fmt: str = "parquet",
                run: Mapping[str, object] | None = None,
                check: Callable[[DataFrame], bool | None] | None = None,
                written: Callable[[int], None] | None = None, only_changed: bool = False) -> Drift | None:
    """Write `df` to catalog table `table`. Returns the schema drift (None for a new table).

    `dry_run=True` aligns and reports but writes nothing. `path` makes a new table external
    (stored at that location). `run` makes an append repeatable (see above). `check` looks at the
    staged rows of a truncate_load or a run and refuses them by raising or returning False;
    `written` is told their number.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if run is not None and mode != "append":
        raise ValueError("a run is appended; other modes replace rows by themselves")
    if (check or written) and mode != "truncate_load" and run is None:
        raise ValueError("only a truncate_load or a run is staged, checked and counted")
    if only_changed and mode != "overwrite_partitions":
        raise ValueError("only_changed is for overwrite_partitions")
    spark = df.sparkSession
    exists = table_exists(spark, table)
    if not exists and not dry_run and (mode == "truncate_load" or run is not None):
        write_table(spark.createDataFrame([], df.schema), table, partitions, "append", path=path, fmt=fmt)
        exists = True

    if not exists:
        if mode == "overwrite_partitions" and not partitions:
            raise ValueError("overwrite_partitions needs partition columns")
        if dry_run:
            log.warning("dry run: would create %s partitioned by %s", table, list(partitions))
            return None
        w = _rebalanced(df, partitions).write.format(fmt).mode("overwrite" if mode != "append" else "append")
        if partitions:
            w = w.partitionBy(*partitions)
        if path:
            w = w.option("path", path)
        w.saveAsTable(table)
        return None

    target = spark.table(table).schema
    aligned, drift = align_to(df, target, partitions)
    if drift.missing:
        log.warning("%s: columns missing from the frame are written as NULL: %s", table, drift.missing)
    if drift.extra:
        log.warning("%s: frame columns not in the table are dropped: %s", table, drift.extra)
    if drift.partitions_removed:
        log.warning("%s: partition columns not in the table are ignored: %s", table, drift.partitions_removed)
    table_parts = partition_columns(spark, table)
    if partitions and [p.lower() for p in drift.partitions] != [p.lower() for p in table_parts]:
        drift.partitioned_by = table_parts
        log.warning("%s is partitioned by %s; the requested partitioning %s is not used", table, table_parts, list(partitions))
    if mode == "overwrite_partitions" and not table_parts:
        raise ValueError(f"{table} is not partitioned; use mode='overwrite'")
    if dry_run:
        log.warning("dry run: no data written to %s (mode %s)", table, mode)
        return drift

    if only_changed:  # partition values are few: they are folders of the table
        keys = [f"__sl_p{i}" for i in range(len(table_parts))]
        fresh = spark.createDataFrame(changed_partitions(aligned, table, table_parts).collect(),
                                      ", ".join(f"{k} string" for k in keys))
        if fresh.isEmpty():
            return drift
        aligned = aligned.join(F.broadcast(fresh), [
            F.coalesce(F.col(f"`{p}`").cast("string"), F.lit("\0")) == F.col(k) for p, k in zip(table_parts, keys)], "left_semi")
    out = _rebalanced(aligned, table_parts)
    if run is not None:
        n = append_run(out, table, run, check=check)
        if written:
            written(n)
    elif mode == "append":
        out.write.insertInto(table, overwrite=False)
    elif mode == "overwrite":
        with _session_conf(spark, _OVERWRITE_CONF, "static"):
            out.write.insertInto(table, overwrite=True)
    elif mode == "overwrite_partitions":
        with _session_conf(spark, _OVERWRITE_CONF, "dynamic"):
            out.write.insertInto(table, overwrite=True)
    else:  # truncate_load
        if reads_table(df, table):
            raise ValueError(f"the frame reads {table} itself; write it elsewhere before truncate_load")
        n = staged_load(out, table, check=check)
        if written:
            written(n)
    return drift
