"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the benchmark tables (or data Spark derives from them), so its work grows
with the scale factor. The DuckDB SQL that must give the same rows is in `oracle.py`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DateType, DecimalType, FloatType, IntegerType, LongType, ShortType, StringType,
                               StructField, StructType)

from ..functions.expressions import date_stamp, expires, minute_stamp
from ..functions.joins import bounded_broadcast
from ..functions.ordering import Desc
from ..operators.castloss import align_with_quarantine, cast_loss
from ..operators.numbering import with_row_number, zip_by_position
from ..operators.schema import align_to, drift_report
from ..operators.skewjoin import skew_join
from ..operators.stored import with_stored_number, zip_stored
from ..operators.survey import run_selection_job
from ..operators.survey import survey_id, survey_selection as _survey_selection
from ..operators.synth import synth_table as _synth_table
from ..session import scratch_path, scratch_table
from ..sinks.files import write_csv, write_json_array, write_sql_dump
from ..sinks.tables import write_table
from ..sinks.views import create_view, register_parquet_table
from ..sources.catalog import read_table
from ..sources.files import csv_types, read_csv, read_json_array
from ..sources.sqldump import read_sql_dump
from ..sources.testdata import load, table_path
from ..streaming.dump_ingest import start_dump_ingest

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the survey run used by the queries below.
SURVEY_NR = 4100
RUN_DATE = "20221125"


def filter_eq_limit(spark: SparkSession, sf: str) -> DataFrame:
    """Projection + equality filter + LIMIT (ordered so the 100 rows are well defined)."""
    return (load(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
            .select("c_name").orderBy("c_name").limit(100))


def append_constant(spark: SparkSession, sf: str) -> DataFrame:
    """Constant column next to a projection."""
    return load(spark, sf, "orders").select("o_orderkey", F.lit(SURVEY_NR).alias("survey_nr"))


def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct values of a column (partial aggregation before the shuffle)."""
    return load(spark, sf, "events").select("event_type").distinct()


def global_row_number(spark: SparkSession, sf: str) -> DataFrame:
    """Row number over all columns descending, without a single-partition window."""
    orders = load(spark, sf, "orders")
    return with_row_number(orders, [Desc(c) for c in orders.columns], "nr")


def row_number_wide(spark: SparkSession, sf: str) -> DataFrame:
    """documents numbered by language: wide rows, four values, ties broken by the other columns."""
    return with_row_number(load(spark, sf, "documents"), ["lang"], "nr").drop("text")


def date_expressions(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates as yyyyMMdd and yyyyMMddHHmm stamps, and an expiry 48 hours later."""
    orders = load(spark, sf, "orders")
    return orders.select("o_orderkey", date_stamp(F.col("o_orderdate")).alias("day_stamp"),
                         minute_stamp(F.col("o_orderdate")).alias("minute_stamp"),
                         expires(F.col("o_orderdate"), 48).alias("expires"))


def survey_id_query(spark: SparkSession, sf: str) -> DataFrame:
    """Survey ids over a projection of orders, numbered by all columns descending."""
    base = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return survey_id(base, SURVEY_NR, RUN_DATE, survey_col="survey_nr")


def positional_zip(spark: SparkSession, sf: str) -> DataFrame:
    """customer by key zipped with orders by key; as many rows as the shorter side."""
    return zip_by_position(load(spark, sf, "customer"), load(spark, sf, "orders"),
                           ["c_custkey"], ["o_orderkey"], unique_orders=True)


def join_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Chained inner joins on differently named keys."""
    o = load(spark, sf, "orders")
    c = bounded_broadcast(load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"))
    n = bounded_broadcast(load(spark, sf, "nation"))
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .join(n, c.c_nationkey == n.n_nationkey, "inner")
            .select("o_orderkey", "c_name", "n_name"))


def row_number_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Row number of orders in stored order."""
    return with_stored_number(load(spark, sf, "orders"), "nr")


def positional_zip_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers and customers paired by their stored positions."""
    return zip_stored(load(spark, sf, "supplier"), load(spark, sf, "customer"))


def join_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders left-joined to customers on a key that nearly half of all rows share and some lack."""
    key = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(1)).when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    orders = load(spark, sf, "orders").select("o_orderkey", key.cast("long").alias("o_fk"))
    return skew_join(orders, load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "o_fk", "c_custkey", "left")


#: Types that lose values of lineitem in every way.
NARROW = StructType([StructField("l_orderkey", ShortType()), StructField("l_quantity", IntegerType()),
                     StructField("l_extendedprice", DecimalType(12, 1)), StructField("l_discount", IntegerType()),
                     StructField("l_tax", FloatType()), StructField("l_returnflag", IntegerType()),
                     StructField("l_shipdate", DateType()), StructField("l_linenumber", LongType())])


def cast_loss_query(spark: SparkSession, sf: str) -> DataFrame:
    """How many values of each column of lineitem the casts to narrower types would lose."""
    return cast_loss(load(spark, sf, "lineitem"), NARROW)


def align_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Orders aligned to a narrower target, and those that would lose something with the reasons."""
    target = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", ByteType()), StructField("o_orderdate", DateType())])
    fine, lost = align_with_quarantine(load(spark, sf, "orders"), target)
    none = F.lit(None).cast("string")
    return fine.select("o_orderkey", F.col("o_custkey").cast("long").alias("o_custkey"), none.alias("key_reason"), none.alias("date_reason")).union(
        lost.select("o_orderkey", "o_custkey", F.col("cast_reasons")["o_custkey"], F.col("cast_reasons")["o_orderdate"]))


def survey_selection(spark: SparkSession, sf: str) -> DataFrame:
    """The end-to-end selection: survey filter, inner + left join, ids, year_month."""
    return _survey_selection(
        load(spark, sf, "orders"), load(spark, sf, "customer"), load(spark, sf, "nation"),
        survey_filter=F.col("o_orderstatus") == "F",
        feedback_key="o_custkey", metadata_key="c_custkey",
        unit_fk="c_nationkey", unit_key="n_nationkey", unit_filter=F.col("n_regionkey") == 1,
        id_order=[F.col("o_orderkey").desc_nulls_last()], survey_nr=SURVEY_NR, run_date=RUN_DATE,
        columns=["o_orderkey", "o_custkey", "c_mktsegment", "n_name"],
        unique_order=True)  # o_orderkey is the primary key of orders


def _customer_target() -> StructType:
    """A target table shaped like customer: two columns renamed in case, one new column,
    balance stored as string, segment and nation dropped."""
    return StructType([StructField("C_CUSTKEY", LongType()), StructField("c_name", StringType()),
                       StructField("c_phone", StringType()), StructField("c_acctbal", StringType())])


def align_schema(spark: SparkSession, sf: str) -> DataFrame:
    """customer aligned to a drifted target schema (names, order, types, filler)."""
    aligned, _ = align_to(load(spark, sf, "customer"), _customer_target())
    return aligned


def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Drift of customer against the same target, with the rows each change touches."""
    return drift_report(load(spark, sf, "customer"), _customer_target(),
                        partitions=["c_mktsegment", "c_acctbal"])


# Target of the selection run: the table's own column names (other case), one column the
# selection does not produce, partitioned by year_month.
RUN_TARGET = StructType([StructField("O_ORDERKEY", LongType()), StructField("o_custkey", LongType()),
                         StructField("c_mktsegment", StringType()), StructField("n_name", StringType()),
                         StructField("odl_id", StringType()), StructField("remark", StringType()),
                         StructField("year_month", StringType())])


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run: selection -> aligned append into an existing partitioned target ->
    report, counted by the write; with it what the target holds afterwards."""
    target = scratch_table(spark, "sl_survey_run")
    write_table(spark.createDataFrame([], RUN_TARGET), target, ["year_month"], "append",
                path=scratch_path(spark, "table"))
    report = run_selection_job(survey_selection(spark, sf), target, survey=f"RUN_{SURVEY_NR}", run_date=RUN_DATE)
    held = read_table(spark, target).agg(F.count(F.lit(1)).alias("held"))
    return report.crossJoin(held).withColumn("table_name", _base_name(F.col("table_name")))  # two one-row frames


def _base_name(name):
    """A scratch table's name without its random end."""
    return F.regexp_replace(name, "_[0-9a-f]{10}$", "")


def run_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """The run of `run_summary` twice, and another survey's in between: the target holds each run's rows once."""
    target = scratch_table(spark, "sl_survey_runs")
    picked = survey_selection(spark, sf)
    for survey, rows in ((SURVEY_NR, picked), (SURVEY_NR + 101, picked.where("n_name IS NULL")), (SURVEY_NR, picked)):
        run_selection_job(rows, target, survey=f"RUN_{survey}", run_date=RUN_DATE, path=scratch_path(spark, "table"))
    return read_table(spark, target)


def write_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    """A dry run reports the selection and leaves the target as it was."""
    target = scratch_table(spark, "sl_dry_run")
    write_table(survey_selection(spark, sf).where("n_name IS NULL"), target, ["year_month"], "append",
                path=scratch_path(spark, "table"))
    report = run_selection_job(survey_selection(spark, sf), target, survey=f"RUN_{SURVEY_NR}", run_date=RUN_DATE,
                               mode="overwrite", dry_run=True)
    held = read_table(spark, target).agg(F.count(F.lit(1)).alias("held"))
    return report.crossJoin(held).withColumn("table_name", _base_name(F.col("table_name")))  # two one-row frames


def view_like_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Stored view with description/labels/expiry over a prefix LIKE filter."""
    src = scratch_table(spark, "sl_part")
    register_parquet_table(spark, src, table_path(sf, "part"))
    view = scratch_table(spark, "sl_part_s")
    return create_view(spark, view,
                       f"SELECT p_partkey, p_name, p_brand, p_size FROM {src} WHERE p_type LIKE 'S%'",
                       description="parts whose type starts with S", friendly_name="parts_s",
                       labels=[("table", "part")], expire_hours=48)


def scan_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog table scan by name."""
    name = scratch_table(spark, "sl_orders")
    register_parquet_table(spark, name, table_path(sf, "orders"))
    return read_table(spark, name)


def _orders_table(spark: SparkSession, sf: str, df: DataFrame | None = None) -> str:
    name = scratch_table(spark, "sl_orders_w")
    write_table(df if df is not None else load(spark, sf, "orders"), name, ["o_orderpriority"],
                "append", path=scratch_path(spark, "table"))
    return name


def write_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Partitioned table write, read back through the catalog."""
    return read_table(spark, _orders_table(spark, sf))


def write_append(spark: SparkSession, sf: str) -> DataFrame:
    """Create with one part of the rows, append the rest with columns in another order."""
    orders = load(spark, sf, "orders")
    first = F.col("o_orderstatus") == "F"
    name = _orders_table(spark, sf, orders.where(first))
    rest = orders.where(~first | F.col("o_orderstatus").isNull())
    write_table(rest.select(*reversed(orders.columns)), name, ["o_orderpriority"], "append")
    return read_table(spark, name)


def write_truncate_load(spark: SparkSession, sf: str) -> DataFrame:
    """Managed table holding old rows is truncated and loaded with the whole orders table."""
    orders = load(spark, sf, "orders")
    name = scratch_table(spark, "sl_orders_m")
    write_table(orders.where(F.col("o_orderstatus") == "P"), name, ["o_orderpriority"], "append")
    write_table(orders, name, ["o_orderpriority"], "truncate_load")
    return read_table(spark, name)


def write_truncate_load_external(spark: SparkSession, sf: str) -> DataFrame:
    """External tables cannot be truncated: the whole overwrite gives the same rows."""
    orders = load(spark, sf, "orders")
    name = _orders_table(spark, sf, orders.where(F.col("o_orderstatus") == "P"))
    write_table(orders, name, ["o_orderpriority"], "truncate_load")
    return read_table(spark, name)


def write_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """The whole table is replaced, also partitions that the new rows lack."""
    orders = load(spark, sf, "orders")
    name = _orders_table(spark, sf)
    write_table(orders.where(F.col("o_orderpriority") != "1-URGENT"), name, ["o_orderpriority"], "overwrite")
    return read_table(spark, name)


def write_only_changed(spark: SparkSession, sf: str) -> DataFrame:
    """Of the partitions in the new frame only those whose rows differ are replaced; `rewritten` tells which."""
    orders = load(spark, sf, "orders")
    name = _orders_table(spark, sf, orders)

    def files(end: str) -> DataFrame:
        found = spark.table(name).select(F.col("o_orderpriority").alias("p"), F.col("_metadata.file_name").alias("f"))
        return found.groupBy("p").agg(F.array_sort(F.collect_set("f")).alias(end))
    before = files("old")
    before = spark.createDataFrame(before.collect(), before.schema)  # one row for each partition
    new = orders.withColumn("o_totalprice", F.when(F.col("o_orderpriority") == "2-HIGH", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")))
    write_table(new.where("o_orderpriority <> '5-LOW'"), name, ["o_orderpriority"], "overwrite_partitions", only_changed=True)
    moved = before.join(files("new"), "p").select("p", (F.col("old") != F.col("new")).alias("rewritten"))
    return read_table(spark, name).join(F.broadcast(moved), F.col("o_orderpriority") == F.col("p")).drop("p")


def write_dynamic_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Only the partitions present in the new frame are replaced."""
    orders = load(spark, sf, "orders")
    name = _orders_table(spark, sf, orders)
    urgent = orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    write_table(urgent.withColumn("o_totalprice", F.col("o_totalprice") * 2), name,
                ["o_orderpriority"], "overwrite_partitions")
    return read_table(spark, name)


def load_csv(spark: SparkSession, sf: str) -> DataFrame:
    """events written as CSV, loaded into a catalog table with its schema and NULL rules,
    and scanned back by name."""
    events = load(spark, sf, "events")
    path = scratch_path(spark, "csv")
    write_csv(events, path)
    table = scratch_table(spark, "sl_events_csv")
    write_table(read_csv(spark, path, events.schema), table, mode="append",
                path=scratch_path(spark, "table"))
    return read_table(spark, table)


def load_csv_text(spark: SparkSession, sf: str) -> DataFrame:
    """documents (line breaks, quotes, blanks at the ends) written as CSV and loaded."""
    docs = load(spark, sf, "documents")
    path = scratch_path(spark, "csv")
    write_csv(docs, path)
    return read_csv(spark, path, docs.schema)


def load_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem written as CSV and loaded with inferred types."""
    path = scratch_path(spark, "csv")
    write_csv(load(spark, sf, "lineitem"), path)
    return read_csv(spark, path, multiline=False)


def csv_types_query(spark: SparkSession, sf: str) -> DataFrame:
    """The types of orders written as CSV, with a column of every kind, found by one aggregate."""
    path = scratch_path(spark, "csv")
    orders = load(spark, sf, "orders")
    write_csv(orders.select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"),
        "o_orderdate", (F.col("o_custkey") % 2 == 0).alias("even"), F.lit(None).cast("string").alias("nothing"),
        F.when(F.col("o_orderkey") % 1000 == 7, "7e1").otherwise(F.col("o_orderkey").cast("string")).alias("mixed"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")).alias("some")), path)
    return csv_types(spark, path)


def load_csv_blank_null(spark: SparkSession, sf: str) -> DataFrame:
    """Empty strings loaded as NULL on request (customer names of one segment emptied)."""
    path = scratch_path(spark, "csv")
    customer = load(spark, sf, "customer")
    emptied = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.col("c_name"))
    write_csv(customer.withColumn("c_name", emptied), path)
    return read_csv(spark, path, customer.schema, empty_as_null=True)


def load_json(spark: SparkSession, sf: str) -> DataFrame:
    """events written as JSON-array files, read back with its schema."""
    events = load(spark, sf, "events")
    path = scratch_path(spark, "json")
    write_json_array(events, path, bytes_per_file=8 << 20)
    return read_json_array(spark, path, events.schema)


def load_sql_dump(spark: SparkSession, sf: str) -> DataFrame:
    """documents written as a MySQL dump (column list in another order), loaded back."""
    docs = load(spark, sf, "documents")
    path = scratch_path(spark, "dump")
    write_sql_dump(docs.select(*reversed(docs.columns)), path, "documents",
                   rows_per_statement=50, column_list=True)
    return read_sql_dump(spark, path, docs.schema, table="documents")


def load_sql_dump_long_lines(spark: SparkSession, sf: str) -> DataFrame:
    """documents written as a dump of few long INSERT lines, each read by many tasks."""
    docs = load(spark, sf, "documents")
    path = scratch_path(spark, "dump")
    write_sql_dump(docs, path, "documents", rows_per_statement=1_000_000)
    return read_sql_dump(spark, path, docs.schema, table="documents", long_lines=True)


def stream_dump_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """documents dump files ingested by a streaming query (available-now trigger)."""
    docs = load(spark, sf, "documents")
    src = scratch_path(spark, "dump-in")
    write_sql_dump(docs, src, "documents", rows_per_statement=50)
    out = scratch_path(spark, "dump-out")
    q = start_dump_ingest(spark, src, out, docs.schema, table="documents")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"dump ingest failed: {q.exception()}")
    return spark.read.schema(docs.schema).parquet(out)


# Fixed generator parameters shared with the SQL oracle.
SYNTH_SEED = 42
SYNTH_STAMP = "202211251200"
SYNTH_BASE_TS = "2022-11-25 12:00:00"


def _values(df: DataFrame, column: str, most: int = 100) -> list:
    """The distinct values of a column with few of them, sorted (an error beyond `most`)."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(r[0] for r in rows)


def synth_table(spark: SparkSession, sf: str) -> DataFrame:
    """As many generated rows as orders has, in orders' schema, the status one of its values."""
    orders = load(spark, sf, "orders")
    return _synth_table(spark, orders.schema, orders.count(),
                        choices={"o_orderstatus": _values(orders, "o_orderstatus")}, seed=SYNTH_SEED,
                        stamp=SYNTH_STAMP, base_ts=SYNTH_BASE_TS)


def synth_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """As many generated rows as lineitem has, in its schema (integers, decimals, dates)."""
    lineitem = load(spark, sf, "lineitem")
    return _synth_table(spark, lineitem.schema, lineitem.count(), seed=SYNTH_SEED, stamp=SYNTH_STAMP,
                        base_ts=SYNTH_BASE_TS)


def synth_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Generated customers and suppliers that share a key prefix join 1:1 on the key."""
    customer, supplier = load(spark, sf, "customer"), load(spark, sf, "supplier")
    n = customer.count()
    left = _synth_table(spark, customer.schema, n, keys={"c_name": "party"}, seed=SYNTH_SEED,
                        stamp=SYNTH_STAMP, base_ts=SYNTH_BASE_TS)
    right = _synth_table(spark, supplier.schema, n, keys={"s_name": "party"}, seed=SYNTH_SEED,
                         stamp=SYNTH_STAMP, base_ts=SYNTH_BASE_TS)
    return left.join(right, left.c_name == right.s_name, "inner").select("c_name", "c_custkey", "s_suppkey")


def synth_keys_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """As many generated customers as customer has, their keys shuffled without a pattern."""
    customer = load(spark, sf, "customer")
    return _synth_table(spark, customer.select("c_custkey", "c_name").schema, customer.count(), keys={"c_name": "party"},
                        seed=SYNTH_SEED, stamp=SYNTH_STAMP, base_ts=SYNTH_BASE_TS, shuffle="feistel")


def synth_choice(spark: SparkSession, sf: str) -> DataFrame:
    """customer's schema with columns drawn from given tables' distinct values, and a NULL column."""
    customer = load(spark, sf, "customer")
    return _synth_table(spark, customer.schema, customer.count(), choices={
        "c_mktsegment": _values(customer, "c_mktsegment"), "c_nationkey": _values(load(spark, sf, "nation"), "n_nationkey"),
        "c_name": None}, seed=SYNTH_SEED, stamp=SYNTH_STAMP, base_ts=SYNTH_BASE_TS)


QUERIES: dict[str, QueryFn] = {
    "filter_eq_limit": filter_eq_limit,
    "append_constant": append_constant,
    "distinct_values": distinct_values,
    "global_row_number": global_row_number,
    "row_number_wide": row_number_wide,
    "date_expressions": date_expressions,
    "survey_id": survey_id_query,
    "positional_zip": positional_zip,
    "row_number_stored": row_number_stored,
    "positional_zip_stored": positional_zip_stored,
    "join_skewed": join_skewed,
    "cast_loss": cast_loss_query,
    "align_quarantine": align_quarantine,
    "join_chain": join_chain,
    "survey_selection": survey_selection,
    "run_summary": run_summary,
    "run_repeated": run_repeated,
    "align_schema": align_schema,
    "schema_drift": schema_drift,
    "view_like_filter": view_like_filter,
    "scan_catalog": scan_catalog,
    "write_partitioned": write_partitioned,
    "write_append": write_append,
    "write_truncate_load": write_truncate_load,
    "write_truncate_load_external": write_truncate_load_external,
    "write_overwrite": write_overwrite,
    "write_dry_run": write_dry_run,
    "write_dynamic_overwrite": write_dynamic_overwrite,
    "write_only_changed": write_only_changed,
    "load_csv": load_csv,
    "load_csv_text": load_csv_text,
    "load_csv_inferred": load_csv_inferred,
    "load_csv_blank_null": load_csv_blank_null,
    "csv_types": csv_types_query,
    "load_json": load_json,
    "load_sql_dump": load_sql_dump,
    "load_sql_dump_long_lines": load_sql_dump_long_lines,
    "stream_dump_ingest": stream_dump_ingest,
    "synth_table": synth_table,
    "synth_lineitem": synth_lineitem,
    "synth_keys": synth_keys,
    "synth_keys_shuffled": synth_keys_shuffled,
    "synth_choice": synth_choice,
}
