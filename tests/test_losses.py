"""Inputs that once lost or changed data without an error."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sluice.session import checkpoint_root, expire_scratch, release, scratch_path, scratch_scope, scratch_table
from sluice.sinks.files import write_csv, write_json_array, write_sql_dump
from sluice.sinks.tables import write_table
from sluice.sources.catalog import read_table
from sluice.sources.files import read_csv, read_json_array
from sluice.sources.sqldump import read_sql_dump
from sluice.operators.numbering import with_row_number
from sluice.streaming.dump_ingest import start_dump_ingest

SCHEMA = "id long, s string"


def folder(**files):
    d = tempfile.mkdtemp(prefix="sl-loss-")
    for name, text in files.items():
        with open(os.path.join(d, name + ".sql"), "w", encoding="utf-8", newline="") as fh:
            fh.write(text)
    return d


def ids(df):
    return sorted(r["id"] for r in df.collect())


# --- dumps ------------------------------------------------------------------------------

@pytest.mark.parametrize("statement", [
    "REPLACE INTO t VALUES (1,'x');", "insert into t values (1,'x');", "/* c */ INSERT INTO t VALUES (1,'x');",
    "Insert Ignore Into `db`.`t` (`id`, s) Values(1,'x');", "INSERT t VALUE (1,'x');", "-- c\nINSERT INTO t VALUES (1,'x');"])
def test_insert_in_any_shape(spark, statement):
    assert ids(read_sql_dump(spark, folder(a=statement + "\n"), SCHEMA, table="t")) == [1]


@pytest.mark.parametrize("dump", [
    "CREATE TABLE t (\r\n `id` int\r\n);\r\nINSERT INTO t VALUES (1,'x');\r\n", "# comment\nINSERT INTO t VALUES\n(1,'x');\n",
    "/* c\n d */\nINSERT INTO t VALUES (1,'x');\n", "SET a=1;\nINSERT INTO t\nVALUES (1,'x');",
    "INSERT INTO t VALUES (1,'x');  \nINSERT INTO other VALUES (5);\n"])
def test_statements_over_lines(spark, dump):
    assert ids(read_sql_dump(spark, folder(a=dump), SCHEMA, table="t", statements_span_lines=True)) == [1]


@pytest.mark.parametrize("dump", [
    "INSERT INTO t (id, sx) VALUES (1,'x');", "UPDATE t SET s='x';", "LOAD DATA INFILE 'x' INTO TABLE t;", "(2,'y');",
    "INSERT INTO t VALUES", "INSERT INTO t SELECT 1,'x';", "/*!50000 INSERT INTO t VALUES (1,'x') */;", "INSERT INTO t VALUES ();"])
def test_what_is_not_read_fails(spark, dump):
    with pytest.raises(Exception):
        read_sql_dump(spark, folder(a=dump + "\n"), SCHEMA, table="t").collect()


@pytest.mark.parametrize("dump", [
    "LOCK TABLES `t` WRITE; INSERT INTO `t` VALUES (1,'a;b'); UNLOCK TABLES;", "BEGIN; INSERT INTO t VALUES (1,'a'); COMMIT;",
    "SET NAMES utf8; -- note\nINSERT INTO t VALUES (1,'a');", ";INSERT INTO t VALUES (1,'a');",
    "INSERT INTO other VALUES (5); /* c; */ REPLACE INTO t VALUES (1,'it\\'s; x');", "DROP TABLE t;insert into t values (1,'a');",
    "/*!40101 SET NAMES utf8 */; INSERT INTO t VALUES (1,'a'); -- INSERT INTO t VALUES (2,'b');"])
def test_statements_that_share_a_record(spark, dump):
    d = folder(a=dump + "\n")
    assert ids(read_sql_dump(spark, d, SCHEMA, table="t", statements_span_lines=True)) == [1]
    if "\n" not in dump:
        assert ids(read_sql_dump(spark, d, SCHEMA, table="t")) == [1]


@pytest.mark.parametrize("dump", [
    "LOCK TABLES t WRITE; UPDATE t SET s='x';", "SET a='x; INSERT INTO t VALUES (1,'b');", "USE d; INSERT INTO t SELECT 1;",
    "CREATE TRIGGER g BEFORE UPDATE ON t FOR EACH ROW SET @a=1; INSERT INTO t VALUES (1,'x');"])
def test_what_shares_a_record_is_read_or_fails(spark, dump):
    with pytest.raises(Exception):
        read_sql_dump(spark, folder(a=dump + "\n"), SCHEMA, table="t").collect()


def test_ignored_shared_records(spark):
    dump = ("DELIMITER ;;\nCREATE TRIGGER g BEFORE INSERT ON t FOR EACH ROW BEGIN SET @a=1; END;\nSET a='x;y'; SET b=`z;`;\n"
            "INSERT INTO t VALUES (1,'x');\n")
    assert ids(read_sql_dump(spark, folder(a=dump), SCHEMA, table="t")) == [1]


def test_ignored_records(spark):
    dump = ("-- MySQL dump 10.13\n--\n/*!40101 SET NAMES utf8 */;\nDROP TABLE IF EXISTS `t`;\nCREATE TABLE `t` (\n"
            "  `id` bigint(20) NOT NULL AUTO_INCREMENT,\n  `key` text,\n  PRIMARY KEY (`id`),\n  KEY `k` (`key`(10)),\n"
            "  CONSTRAINT `c` FOREIGN KEY (`id`) REFERENCES `u` (`id`)\n) ENGINE=InnoDB DEFAULT CHARSET=utf8;\n\n"
            "LOCK TABLES `t` WRITE;\n/*!40000 ALTER TABLE `t` DISABLE KEYS */;\nINSERT INTO `t` VALUES (1,'x');\nUNLOCK TABLES;\n")
    assert ids(read_sql_dump(spark, folder(a=dump), SCHEMA, table="t")) == [1]
    assert ids(read_sql_dump(spark, folder(a=dump), SCHEMA, table="t", statements_span_lines=True)) == [1]


def test_binary_in_dumps(spark):
    src = spark.createDataFrame([(1, bytearray(b"\xff\x00\xfe'")), (2, bytearray(b"")), (3, None)], "id long, b binary")
    out = tempfile.mkdtemp() + "/d"
    write_sql_dump(src, out, "t")
    assert sorted(read_sql_dump(spark, out, src.schema, table="t").collect()) == sorted(src.collect())
    assert read_sql_dump(spark, folder(a="INSERT INTO t VALUES (1,X'fF00'),(2,0xAb);\n"), src.schema).orderBy("id").first()["b"] == b"\xff\x00"


# --- tables -------------------------------------------------------------------------------

def test_truncate_load_refuses_its_own_input(spark):
    t = scratch_table(spark, "sl_self")
    write_table(spark.range(5).select("id", F.lit("a").alias("p")), t, ["p"], "append")
    with pytest.raises(ValueError):
        write_table(read_table(spark, t).where("id < 4"), t, ["p"], "truncate_load")
    assert read_table(spark, t).count() == 5
    write_table(spark.range(2).select("id", F.lit("b").alias("p")), t, ["p"], "truncate_load")
    assert read_table(spark, t).count() == 2


def test_other_partitioning_is_reported(spark):
    t = scratch_table(spark, "sl_parts")
    df = spark.range(3).select("id", F.lit("a").alias("p"), F.lit("b").alias("q"))
    write_table(df, t, ["p"], "append")
    drift = write_table(df, t, ["q"], "append")
    assert drift.partitioned_by == ["p"] and not drift.clean
    assert write_table(df, t, ["p"], "append").clean


# --- files --------------------------------------------------------------------------------

def test_csv_keeps_blanks_and_line_breaks(spark):
    src = spark.createDataFrame([(1, "  lead"), (2, "trail  "), (3, "   "), (4, "l1\nl2"), (5, "cr\r\nlf"), (6, ""), (7, None)], SCHEMA)
    out = tempfile.mkdtemp() + "/c"
    write_csv(src, out)
    assert sorted(read_csv(spark, out, src.schema).collect()) == sorted(src.collect())
    one = src.select("s").where("id in (1, 4)")
    write_csv(one, out + "1")
    assert sorted(read_csv(spark, out + "1", one.schema).collect()) == sorted(one.collect())


def test_csv_header_must_fit_the_schema(spark):
    d = tempfile.mkdtemp()
    with open(d + "/h.csv", "w") as fh:
        fh.write("b,a\nbee,ay\n")
    with pytest.raises(Exception):
        read_csv(spark, d, "a string, b string").collect()
    assert read_csv(spark, d, "b string, a string").first()["b"] == "bee"


def test_json_null_fields_are_written(spark):
    out = tempfile.mkdtemp() + "/j"
    write_json_array(spark.createDataFrame([(1, None)], SCHEMA), out)
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.startswith("part"))
    assert '"s":null' in text
    assert read_json_array(spark, out, SCHEMA).collect() == [(1, None)]


def test_writers_keep_the_order(spark):
    out = tempfile.mkdtemp() + "/j"
    df = spark.range(0, 1000, 1, 1)
    write_json_array(df, out, rows_per_file=1000)
    assert [r["id"] for r in read_json_array(spark, out, "id long").collect()] == list(range(1000))
    write_json_array(df.repartition(1), out + "2", rows_per_file=1000, order=["id"])
    assert [r["id"] for r in read_json_array(spark, out + "2", "id long").collect()] == list(range(1000))


# --- streams ------------------------------------------------------------------------------

def test_default_checkpoint_goes_on_where_it_stopped(spark):
    src, out = folder(a="INSERT INTO t VALUES (1,'x');\n"), scratch_path(spark, "ingest-out")
    schema = spark.createDataFrame([], SCHEMA).schema
    for more, want in ((None, [1]), ("b", [1, 2]), (None, [1, 2])):
        if more:
            with open(os.path.join(src, more + ".sql"), "w") as fh:
                fh.write("INSERT INTO t VALUES (2,'y');\n")
        start_dump_ingest(spark, src, out, schema, table="t").awaitTermination()
        assert ids(spark.read.schema(schema).parquet(out)) == want


# --- scratch ------------------------------------------------------------------------------

def scratch_folders(spark):
    return {f for f in os.listdir(checkpoint_root(spark).replace("file:", "")) if f.startswith("sluice-rownum")}


def test_scratch_is_released(spark):
    before = scratch_folders(spark)
    with scratch_scope(spark):
        assert with_row_number(spark.range(50), ["id"]).count() == 50
        assert len(scratch_folders(spark)) == len(before) + 1
    assert scratch_folders(spark) == before
    path = scratch_path(spark, "rownum")
    spark.range(3).write.parquet(path)
    assert not [p for p in expire_scratch(spark, 1000) if p.endswith(path.rsplit("/", 1)[1])]
    release(spark, path)
    assert scratch_folders(spark) == before
