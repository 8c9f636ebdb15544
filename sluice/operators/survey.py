"""Survey selection job: select one survey's rows, enrich them, give them survey ids.

`survey_id` adds the survey number column, a global row number and the id string. By
default rows are numbered by every column descending (NULLs last); pass `order=` to number
by a key instead. `select_survey` keeps one survey's rows; `survey_selection` is the whole
job on the benchmark tables; `run_summary` is the one-row report of a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.expressions import survey_id_expr, year_month_of
from ..functions.joins import bounded_broadcast
from ..functions.ordering import OrderItem, all_desc
from .numbering import with_row_number


def survey_id(df: DataFrame, survey_nr: int | str, run_date: str, *,
              order: Sequence[OrderItem] | None = None, survey_col: str = "survey_nr",
              nr_col: str = "nr", id_col: str = "odl_id", method: str = "range",
              unique_order: bool = False) -> DataFrame:
    """Add `survey_col` (constant), `nr_col` (1..N) and `id_col`.

    `run_date` is `yyyyMMdd` and is required: a default taken at import time would go stale
    in a long-running driver.
    """
    if len(run_date) != 8 or not run_date.isdigit():
        raise ValueError("run_date must be yyyyMMdd")
    out = df.withColumn(survey_col, F.lit(survey_nr))
    numbered = with_row_number(out, order if order is not None else all_desc(out), nr_col,
                               method=method, unique_order=unique_order and order is not None)
    return numbered.withColumn(id_col, survey_id_expr(F.col(survey_col), run_date, F.col(nr_col)))


def select_survey(df: DataFrame, survey_nr: int | str, survey_col: str = "survey_nr") -> DataFrame:
    """Rows of one survey (pushed down to the scan as an equality filter)."""
    return df.where(F.col(survey_col) == F.lit(survey_nr))


def survey_selection(feedback: DataFrame, metadata: DataFrame, units: DataFrame, *,
                     survey_filter: Column, feedback_key: str, metadata_key: str,
                     unit_fk: str, unit_key: str, unit_filter: Column | None,
                     id_order: Sequence[OrderItem], survey_nr: int | str, run_date: str,
                     columns: Sequence[str], id_col: str = "odl_id",
                     method: str = "range", unique_order: bool = False) -> DataFrame:
    """Feedback of one survey -> inner join metadata -> left join units -> ids -> year_month.

    Metadata and units are broadcast only if a bounded count proves them small; otherwise
    the joins shuffle and AQE's skew handling splits a hot key of the feedback side.
    """
    fb = feedback.where(survey_filter)

    def needed(df: DataFrame, *keys: str) -> DataFrame:
        names = {c.lower() for c in (*keys, *columns)}
        return df.select(*[f"`{c}`" for c in df.columns if c.lower() in names])
    meta = bounded_broadcast(needed(metadata, metadata_key, unit_fk))
    joined = fb.join(meta, fb[feedback_key] == meta[metadata_key], "inner")
    u = bounded_broadcast(needed(units.where(unit_filter) if unit_filter is not None else units, unit_key))
    joined = joined.join(u, joined[unit_fk] == u[unit_key], "left")
    picked = joined.select(*columns)
    with_ids = survey_id(picked, survey_nr, run_date, order=id_order, id_col=id_col, method=method,
                         unique_order=unique_order)
    return with_ids.select(*columns, id_col, year_month_of(run_date).alias("year_month"))


def run_selection_job(selected: DataFrame, target_table: str, *, survey: str, run_date: str,
                      partitions: Sequence[str] = ("year_month",), mode: str = "append",
                      dry_run: bool = False, path: str | None = None) -> DataFrame:
    """Write a selection into its target table (aligned to the table's schema, one write in
    the given mode) and return the run report. Rows are counted by the write's own pass. An
    append may be repeated: it replaces the rows of an earlier run of the same survey and run
    date (`sinks/staged.py`). With `dry_run` nothing is written and the report counts the
    selection itself."""
    from ..sinks.tables import write_table
    if dry_run:
        write_table(selected, target_table, partitions, mode, dry_run=True, path=path)
        return run_summary(selected, survey, run_date, mode, "Dry run", table=target_table)
    spark, amount = selected.sparkSession, []
    if mode == "append":
        write_table(selected, target_table, partitions, mode, path=path, run={"survey": survey, "run_date": run_date},
                    written=amount.append)
    else:
        seen = Observation()
        write_table(selected.observe(seen, F.count(F.lit(1)).alias("amount")), target_table, partitions, mode, path=path)
        amount.append(seen.get["amount"])
    return _report(spark.createDataFrame([(amount[0],)], "amount long"), survey, run_date, mode, "Completed", target_table)


def run_summary(df: DataFrame, survey: str, run_date: str, mode: str,
                status: str = "Completed", *, table: str | None = None) -> DataFrame:
    """One-row report of a run: rows counted by an aggregate, the rest literal."""
    return _report(df.agg(F.count(F.lit(1)).alias("amount")), survey, run_date, mode, status, table)


def _report(counted: DataFrame, survey: str, run_date: str, mode: str, status: str, table: str | None) -> DataFrame:
    return counted.select(
        F.lit(survey).alias("survey"), F.lit(table).cast("string").alias("table_name"), F.col("amount"),
        F.lit(run_date).alias("run_date"), F.lit(mode).alias("mode"), F.lit(status).alias("status"))
