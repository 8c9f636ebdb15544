"""Catalog tables: scan by name, look up a schema without running a job."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class TableNotFound(LookupError):
    pass


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """`db.table` (or `table`) from the session catalog; a clear error if it is missing.

    The scan is lazy: filters and projections applied later reach the files (partition
    pruning, pushed filters, pruned read schema).
    """
    try:
        return spark.read.table(name)
    except AnalysisException as e:
        if "TABLE_OR_VIEW_NOT_FOUND" in str(e) or "not found" in str(e).lower():
            raise TableNotFound(f"table {name} does not exist") from e
        raise


def table_schema(spark: SparkSession, name: str) -> StructType:
    """Schema from the catalog (no `SELECT ... LIMIT` probe job)."""
    return read_table(spark, name).schema
