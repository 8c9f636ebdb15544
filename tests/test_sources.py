"""Sources on hand-made inputs: SQL dumps, CSV and JSON arrays (NULL, quoting, zones)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sluice.sinks.files import write_csv, write_json_array, write_sql_dump
from sluice.sources.files import read_csv, read_json_array
from sluice.sources.sqldump import read_sql_dump

SCHEMA = "id long, name string, note string, ts timestamp_ntz, n int"


def _write(text: str, name: str = "dump.sql") -> str:
    d = tempfile.mkdtemp(prefix="sl-src-")
    with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
        fh.write(text)
    return d


DUMP = r"""-- MySQL dump
SET TIME_ZONE='+00:00';
CREATE TABLE `t` (
  `id` bigint NOT NULL,
  `name` varchar(20)
);
LOCK TABLES `t` WRITE;
INSERT INTO `t` VALUES (1,'a),(b',NULL,'2022-11-25 10:00:00',7),(2,'it\'s','x\\ny','2022-11-25 10:00:01',NULL);
INSERT INTO `t` VALUES (3,'','NULL','0000-00-00 00:00:00',-1),(4,'tab\there\nnew','back\\\\slash',NULL,0);
INSERT INTO `other` VALUES (99,'skip me');
INSERT INTO `t` (`n`,`id`,`name`) VALUES (5,5,'by name'),(6,6,'(paren)');
UNLOCK TABLES;
"""


def test_dump_rows_and_values(spark):
    df = read_sql_dump(spark, _write(DUMP), SCHEMA, table="t")
    rows = {r["id"]: r for r in df.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6]
    assert rows[1]["name"] == "a),(b" and rows[1]["note"] is None and rows[1]["n"] == 7
    assert rows[1]["ts"] == dt.datetime(2022, 11, 25, 10, 0, 0)
    assert rows[2]["name"] == "it's" and rows[2]["note"] == "x\\ny" and rows[2]["n"] is None
    assert rows[3]["name"] == "" and rows[3]["note"] == "NULL" and rows[3]["ts"] is None
    assert rows[4]["name"] == "tab\there\nnew" and rows[4]["note"] == "back\\\\slash"
    assert rows[5]["n"] == 5 and rows[5]["name"] == "by name" and rows[5]["note"] is None
    assert rows[6]["name"] == "(paren)"


def test_dump_escaped_backslash_before_letter(spark):
    # '\\n' is a backslash followed by n, not a newline; '\\\n' is backslash + newline
    d = _write("INSERT INTO `t` VALUES (1,'a\\\\nb','c\\\\\\nd',NULL,1);\n")
    r = read_sql_dump(spark, d, SCHEMA).first()
    assert r["name"] == "a\\nb"
    assert r["note"] == "c\\\nd"


def test_dump_empty_as_null(spark):
    df = read_sql_dump(spark, _write(DUMP), SCHEMA, table="t", empty_as_null=True)
    assert df.where("id = 3").first()["name"] is None


def test_dump_without_inserts_is_empty(spark):
    d = _write("CREATE TABLE `t` (`id` bigint);\n-- no data\n")
    assert read_sql_dump(spark, d, SCHEMA).count() == 0


def test_dump_field_count_mismatch_fails(spark):
    d = _write("INSERT INTO `t` VALUES (1,'only two');\n")
    with pytest.raises(Exception):
        read_sql_dump(spark, d, SCHEMA).collect()


def test_dump_statement_over_lines(spark):
    d = _write("-- header\nINSERT INTO `t` VALUES\n(1,'a',NULL,NULL,1),\n(2,'b',NULL,NULL,2);\n")
    df = read_sql_dump(spark, d, SCHEMA, statements_span_lines=True)
    assert sorted(r["name"] for r in df.collect()) == ["a", "b"]


def test_dump_zone_for_instants(spark):
    d = _write("INSERT INTO `t` VALUES (1,'2022-11-25 10:00:00');\n")
    r = read_sql_dump(spark, d, "id long, ts timestamp", tz="Europe/Berlin").first()
    assert r["ts"] == dt.datetime(2022, 11, 25, 9, 0, 0)  # session zone is UTC


def test_dump_round_trip_odd_text(spark):
    texts = ["plain", "quote ' and \" double", "back\\slash", "two \\\\ slashes", "nl\nand\r\ncr",
             "nul\u0000ch", "ctrl\u001az", "'a),(b'", "", None, "NULL", "ümlaut €", "tail\\"]
    src = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    out = tempfile.mkdtemp(prefix="sl-dump-") + "/d"
    write_sql_dump(src, out, "x", rows_per_statement=4)
    back = read_sql_dump(spark, out, src.schema, table="x")
    assert sorted(back.collect(), key=lambda r: r["id"]) == sorted(src.collect(), key=lambda r: r["id"])


def test_csv_keeps_null_and_empty_apart(spark):
    src = spark.createDataFrame([(1, None, "", 'a"b,c'), (2, "NULL", "x", "line\nbreak")],
                                "id int, a string, b string, c string")
    out = tempfile.mkdtemp(prefix="sl-csv-") + "/c"
    write_csv(src, out)
    back = read_csv(spark, out, src.schema, multiline=True)
    assert sorted(back.collect()) == sorted(src.collect())
    conflated = read_csv(spark, out, src.schema, multiline=True, empty_as_null=True)
    assert conflated.where("id = 1").first()["b"] is None


def test_csv_header_only_file(spark):
    d = _write("a,b,c\n", "h.csv")
    assert read_csv(spark, d, "a string, b string, c string").count() == 0


def test_csv_zone_shift_to_utc(spark):
    d = _write("id,ts\n1,2022-11-25 11:00:00\n", "z.csv")
    ntz = read_csv(spark, d, "id int, ts timestamp_ntz", tz="Europe/Berlin").first()
    assert ntz["ts"] == dt.datetime(2022, 11, 25, 10, 0, 0)
    ltz = read_csv(spark, d, "id int, ts timestamp", tz="Europe/Berlin").first()
    assert ltz["ts"] == dt.datetime(2022, 11, 25, 10, 0, 0)  # shown in the UTC session zone


def test_json_arrays_and_empty_files(spark):
    d = tempfile.mkdtemp(prefix="sl-json-")
    with open(os.path.join(d, "a.json"), "w") as fh:
        fh.write('[{"id": 1, "s": "", "t": null},\n {"id": 2, "s": "x", "t": "2022-11-25T10:00:00.123456"}]')
    with open(os.path.join(d, "b.json"), "w") as fh:
        fh.write("[]")
    df = read_json_array(spark, d, "id long, s string, t timestamp_ntz")
    rows = sorted(df.collect())
    assert [r["id"] for r in rows] == [1, 2]
    assert rows[0]["s"] == "" and rows[0]["t"] is None
    assert rows[1]["t"] == dt.datetime(2022, 11, 25, 10, 0, 0, 123456)


def test_json_array_writer_bounded_files(spark):
    src = spark.range(25).select(F.col("id"), F.col("id").cast("string").alias("s"))
    out = tempfile.mkdtemp(prefix="sl-jw-") + "/j"
    write_json_array(src.repartition(1), out, rows_per_file=10)
    files = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(files) == 3
    assert sorted(read_json_array(spark, out, src.schema).collect()) == sorted(src.collect())


def test_csv_and_json_twins_agree(spark):
    rows = [(1, "", None, "a,b"), (2, "x", "NULL", 'q"uote'), (3, None, "", "ü{}~#$/?`")]
    src = spark.createDataFrame(rows, "id long, a string, b string, c string")
    base = tempfile.mkdtemp(prefix="sl-twin-")
    write_csv(src, base + "/csv")
    write_json_array(src, base + "/json", rows_per_file=2)
    from_csv = read_csv(spark, base + "/csv", src.schema)
    from_json = read_json_array(spark, base + "/json", src.schema)
    key = lambda r: r["id"]
    assert sorted(from_csv.collect(), key=key) == sorted(from_json.collect(), key=key) == sorted(src.collect(), key=key)


def test_csv_type_autodetect(spark):
    d = _write("id,price,name,ts\n1,2.5,a,2022-11-25 10:00:00\n2,,\"b,c\",\n", "auto.csv")
    df = read_csv(spark, d)
    types = dict(df.dtypes)
    assert types["id"] == "int" and types["price"] == "double" and types["name"] == "string"
    assert types["ts"].startswith("timestamp")
    assert sorted(r["name"] for r in df.collect()) == ["a", "b,c"]


def test_dump_qualified_table_name(spark):
    d = _write("INSERT INTO `db`.`t` VALUES (1,'q',NULL,NULL,1);\nINSERT INTO db2.t VALUES (2,'r',NULL,NULL,2);\n")
    assert sorted(r["id"] for r in read_sql_dump(spark, d, SCHEMA, table="t").collect()) == [1, 2]


def test_dump_unreadable_text_fails_instead_of_dropping_rows(spark):
    for stmt in ["INSERT INTO `t` VALUES (1,'a',NULL,NOW(),1);\n",
                 "INSERT INTO `t` VALUES (1,'a',NULL,NULL,1) ON DUPLICATE KEY UPDATE n=1;\n",
                 "INSERT INTO `t` VALUES (1,'a',NULL,NULL,1),(2,'b',NULL,NULL,2)\n"]:
        with pytest.raises(Exception, match="unparsed INSERT text"):
            read_sql_dump(spark, _write(stmt), SCHEMA).collect()


def test_dump_unparsable_head_fails_even_with_table_filter(spark):
    d = _write("INSERT INTO `t` SELECT * FROM u;\n")
    with pytest.raises(Exception, match="unparsed INSERT text"):
        read_sql_dump(spark, d, SCHEMA, table="t").collect()


def test_dump_round_trip_all_types(spark):
    import decimal
    rows = [(1, dt.datetime(2022, 11, 25, 10, 0, 0, 123456), dt.datetime(2021, 1, 2, 3, 4, 5),
             dt.date(2020, 2, 29), True, -1.5e-7, decimal.Decimal("12.34")),
            (2, None, None, None, None, None, None)]
    schema = "id long, ts timestamp, wall timestamp_ntz, d date, b boolean, x double, m decimal(10,2)"
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        src = spark.createDataFrame(rows, schema)
        out = tempfile.mkdtemp(prefix="sl-types-") + "/d"
        write_sql_dump(src, out, "ty")
        back = read_sql_dump(spark, out, src.schema, table="ty")
        assert sorted(back.collect()) == sorted(src.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_json_zone_shift_to_utc(spark):
    d = tempfile.mkdtemp(prefix="sl-jz-")
    with open(os.path.join(d, "z.json"), "w") as fh:
        fh.write('[{"id": 1, "t": "2022-11-25T11:00:00"}]')
    ntz = read_json_array(spark, d, "id long, t timestamp_ntz", tz="Europe/Berlin").first()
    assert ntz["t"] == dt.datetime(2022, 11, 25, 10, 0, 0)
    ltz = read_json_array(spark, d, "id long, t timestamp", tz="Europe/Berlin").first()
    assert ltz["t"] == dt.datetime(2022, 11, 25, 10, 0, 0)
