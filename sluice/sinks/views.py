"""Stored views with descriptive options (name, description, labels, expiry)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_view(spark: SparkSession, name: str, select_sql: str, *, description: str | None = None,
                friendly_name: str | None = None, labels: Sequence[tuple[str, str]] | Mapping[str, str] = (),
                expire_hours: float | None = None, temporary: bool = False,
                replace: bool = True) -> DataFrame:
    """CREATE VIEW ... COMMENT ... TBLPROPERTIES (...) AS <select_sql>; returns the view.

    Expiry is recorded as the property `expiration_timestamp` (UTC, ISO 8601): Spark has no
    view expiry, so enforcing it is left to catalog housekeeping. A persistent view may only
    read catalog tables/views; `temporary=True` also allows temp views.
    """
    props: dict[str, str] = {}
    if friendly_name:
        props["friendly_name"] = friendly_name
    for k, v in (labels.items() if isinstance(labels, Mapping) else labels):
        props[f"label.{k}"] = v
    if expire_hours is not None:
        expiry = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=expire_hours)
        props["expiration_timestamp"] = expiry.strftime("%Y-%m-%dT%H:%M:%SZ")
    head = "CREATE " + ("OR REPLACE " if replace else "") + ("TEMPORARY " if temporary else "") + f"VIEW {name}"
    if description and not temporary:
        head += f" COMMENT {_quote(description)}"
    if props and not temporary:
        head += " TBLPROPERTIES (" + ", ".join(f"{_quote(k)} = {_quote(v)}" for k, v in props.items()) + ")"
    spark.sql(f"{head} AS {select_sql}")
    return spark.table(name)


def view_properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in rows}


def register_parquet_table(spark: SparkSession, name: str, path: str) -> None:
    """External catalog table over existing parquet files (no copy)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION {_quote(path)}")
