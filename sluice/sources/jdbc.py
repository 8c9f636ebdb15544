"""Relational tables over JDBC, read in parallel slices.

A JDBC read without partitioning options is one connection and one task. Give a numeric,
date or timestamp `partition_column` and `num_partitions` to split the read into ranges;
without explicit bounds they are looked up with one small MIN/MAX query. Credentials are
arguments (or come from the caller's secret store), never constants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, *, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetchsize: int = 10000, **extra) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, *, user: str | None = None,
              password: str | None = None, driver: str | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetchsize: int = 10000) -> DataFrame:
    opts = jdbc_options(url, table, user=user, password=password, driver=driver, fetchsize=fetchsize)
    if partition_column is None:
        return spark.read.format("jdbc").options(**opts).load()
    if not num_partitions or num_partitions < 1:
        raise ValueError("num_partitions is required with partition_column")
    if lower_bound is None or upper_bound is None:
        bounds_q = f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}) b"
        row = spark.read.format("jdbc").options(**{**opts, "dbtable": bounds_q}).load().first()
        lower_bound = row["LO"] if "LO" in row.asDict() else row["lo"]
        upper_bound = row["HI"] if "HI" in row.asDict() else row["hi"]
        if lower_bound is None:  # empty table
            return spark.read.format("jdbc").options(**opts).load()
    opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                 "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    return spark.read.format("jdbc").options(**opts).load()
