"""Write a DataFrame to a relational table over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.jdbc import jdbc_options

JDBC_MODES = ("append", "overwrite", "error", "ignore")


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append", user: str | None = None,
               password: str | None = None, driver: str | None = None, batchsize: int = 10000,
               num_partitions: int | None = None, truncate: bool = False) -> None:
    """Batched inserts from each task. `num_partitions` caps concurrent connections (the
    frame is coalesced down to it, never shuffled up). `truncate=True` with overwrite keeps
    the table definition and deletes rows instead of dropping the table."""
    if mode not in JDBC_MODES:
        raise ValueError(f"mode must be one of {JDBC_MODES}")
    opts = jdbc_options(url, table, user=user, password=password, driver=driver,
                        batchsize=batchsize, truncate=str(truncate).lower())
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    df.write.format("jdbc").options(**opts).mode(mode).save()
