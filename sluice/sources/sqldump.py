"""MySQL dump (`INSERT INTO ... VALUES (...),(...);`) as a distributed text scan.

Each INSERT statement is one text record, so work spreads over files and statements. Per
statement: regular expressions split the VALUES list into tuples (rows) and each tuple
into fields, a decode turns each field into its value, and a cast gives the schema's type.
Statements with a column list (`INSERT INTO t (a,b) VALUES ...`) map fields by name; without
one, by position.

A record is cut into its statements, at semicolons outside quotes and comments, and every
statement is classified, after comments (`--`, `#`, `/* */`) are taken off its front: INSERT
and REPLACE are parsed (keywords in any case; a REPLACE gives its rows as they are, keys are not
resolved); blank records, comments, DDL, SET, LOCK and the like are ignored, by a fixed list;
anything else fails the load. So do a column name that the schema lacks, an INSERT or REPLACE in a
conditional comment (`/*! */`), and one behind a semicolon in a record that begins with a stored
program (such a record is not cut) or that holds a quote which does not close.

Values: `NULL` (bare) is NULL; quoted text is unescaped (`\\0 \\b \\n \\r \\t \\Z` become
their control characters, any other backslash pair becomes its second character, so
`\\'` -> `'` and `\\\\` -> `\\`); hexadecimal literals (`0xFF`, `X'FF'`) are bytes; quoted `'NULL'` stays the string "NULL"; `''` stays the
empty string unless `empty_as_null=True`. Dump timestamps are wall-clock in `tz` (mysqldump
writes UTC) and land in UTC. MySQL zero dates become NULL. Function calls or parentheses
outside quotes in VALUES, and `ON DUPLICATE KEY UPDATE` tails, are not supported: every
statement is checked to be fully consumed by its parsed rows, and one that is not fails the
load with the unread text rather than losing rows.

The patterns use possessive quantifiers: a backtracking version of the tuple pattern
overflows the JVM stack on long quoted values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, StringType, StructType, TimestampNTZType,
                               TimestampType)

from .dumprows import statement_records
from .files import normalize_zone

# Fixed patterns (Java regex).
# One row: "(" fields ")" followed by "," "(" or by the statement's ";".
TUPLE_PATTERN = r"\(((?:[^()'\\]++|'(?:[^'\\]++|\\.)*+')*+)\)(?=\s*+,\s*+\(|\s*+;)"
# One field inside a row: a quoted string or a bare token, each after start or a comma.
FIELD_PATTERN = r"(?:^|,)\s*+([xX]'[0-9a-fA-F]*+'|'(?:[^'\\]++|\\.)*+'|[^,']*+)"
# Statement head: table name (optionally qualified by a database) and optional column list.
HEAD_PATTERN = (r"(?i)^\s*(?:INSERT|REPLACE)\s+(?:(?:LOW_PRIORITY|DELAYED|HIGH_PRIORITY|IGNORE)\s+)*(?:INTO\s+)?"
                r"(?:(?:`[^`]+`|[^`\s.(]+)\s*\.\s*)?(?:`([^`]+)`|([^`\s.(]+))\s*"
                r"(?:\(([^)]*)\))?\s*VALUES?\s*(?=\()")
# What may remain of a statement once its head and all rows are taken out.
LEFTOVER_PATTERN = r"^[\s,]*;\s*$"
# Comments and blanks in front of a statement (conditional comments are not comments).
COMMENT_PATTERN = r"^(?:\s++|--(?:[ \t\r][^\n]*+)?+(?:\n|$)|#[^\n]*+(?:\n|$)|/\*(?!!)(?:[^*]|\*(?!/))*+\*/)*+"
# One statement of a record, with its semicolon. A quote that does not close takes the rest.
_CLOSED = (r"[^;'\"`#/-]++|'(?:[^'\\]++|\\.)*+'|\"(?:[^\"\\]++|\\.)*+\"|`[^`]*+`|--(?:[ \t\r][^\n]*+)?+(?:\n|\z)|#[^\n]*+|"
           r"/\*(?:[^*]|\*(?!/))*+\*/|[-/]")
STATEMENT_PATTERN = rf"(?s)(?:{_CLOSED}|['\"`].*+)*+(?:;|\z)"
# Rows behind a semicolon (and comments); a quote that does not close.
ROWS_PATTERN = rf";{COMMENT_PATTERN[1:]}(?i:INSERT|REPLACE)\b"
OPEN_PATTERN = rf"(?s)^(?:{_CLOSED}|;)*+['\"`]"
PROGRAM_PATTERN = r"(?is)^CREATE\b[^;(]*?\b(?:TRIGGER|PROCEDURE|FUNCTION|EVENT)\b"
# Statements that hold no rows: by their first word, lines inside a CREATE TABLE, and
# conditional comments.
IGNORABLE_PATTERN = (
    r"(?is)^(?:$|;\s*$|/\*!(?!.*\b(?:INSERT|REPLACE)\b)|"
    r"(?:CREATE|DROP|ALTER|SET|LOCK|UNLOCK|USE|START|BEGIN|COMMIT|ROLLBACK|DELIMITER|ANALYZE|OPTIMIZE|FLUSH|GRANT|REVOKE)\b|"
    r"`[^`]+`\s+[a-z]|\)\s*(?:;|ENGINE\b|DEFAULT\b|CHARSET\b|COLLATE\b|AUTO_INCREMENT\b|COMMENT\b|PARTITION\b|ROW_FORMAT\b|,?\s*$)|"
    r"(?:PRIMARY|UNIQUE|FULLTEXT|SPATIAL)\s+KEY\b|(?:KEY|INDEX|CONSTRAINT|FOREIGN|CHECK|PARTITION)\b)")
HEX_PATTERN = r"(?i)^(?:0x([0-9a-f]+)|x'([0-9a-f]*)')$"
# Escapes that stand for control characters; every other "\x" stands for "x".
ESCAPES = {"\\0": "\u0000", "\\b": "\b", "\\n": "\n", "\\r": "\r", "\\t": "\t", "\\Z": "\u001a"}
ZERO_DATE_PREFIX = "0000-00-00"


def _unescape_piece(p: Column) -> Column:
    """Unescape text that holds no escaped backslash: every backslash escapes the next
    character, so plain replacements cannot interfere with each other."""
    for k, v in ESCAPES.items():
        p = F.replace(p, F.lit(k), F.lit(v))
    return F.regexp_replace(p, r"\\([\s\S])", "$1")


def _unescape(s: Column) -> Column:
    """MySQL string escapes -> characters. Escaped backslashes are split off first (left to
    right, as the escapes are read), the pieces unescaped and joined with a backslash."""
    pieces = F.transform(F.split(s, r"\\\\", -1), _unescape_piece)
    return (F.when(F.instr(s, "\\") == 0, s)
            .when(F.instr(s, "\\\\") == 0, _unescape_piece(s))
            .otherwise(F.array_join(pieces, "\\")))


def decode_field(raw: Column, empty_as_null: bool = False) -> Column:
    """Raw field text -> string value (NULL for bare NULL)."""
    quoted = raw.startswith("'")
    body = raw.substr(F.lit(2), F.length(raw) - 2)
    text = _unescape(body)
    if empty_as_null:
        text = F.when(text == "", F.lit(None).cast("string")).otherwise(text)
    bare = F.regexp_replace(raw, r"^\s+|\s+$", "")
    return (F.when(quoted, text)
            .when(F.upper(bare) == "NULL", F.lit(None).cast("string"))
            .otherwise(bare))


def _cast(value: Column, dtype, tz: str | None, raw: Column) -> Column:
    if isinstance(dtype, StringType):
        return value
    if isinstance(dtype, BinaryType):
        digits = F.concat(F.regexp_extract(raw, HEX_PATTERN, 1), F.regexp_extract(raw, HEX_PATTERN, 2))
        return F.when(F.regexp_like(raw, F.lit(HEX_PATTERN)), F.unhex(digits)).otherwise(value.cast("binary"))
    if isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        value = F.when(value.startswith(ZERO_DATE_PREFIX), F.lit(None).cast("string")).otherwise(value)
    if isinstance(dtype, TimestampType) and tz:
        # an instant: read the wall-clock text in the dump's zone, not the session's
        value = F.concat(value, F.lit(" " + tz))
    if isinstance(dtype, BooleanType):
        value = F.when(value == "1", "true").when(value == "0", "false").otherwise(value)
    return value.cast(dtype)


def parse_statements(lines: DataFrame, schema: StructType, table: str | None = None, *,
                     empty_as_null: bool = False, tz: str | None = "UTC",
                     text_col: str = "value") -> DataFrame:
    """INSERT statements (in rows of `lines`, each of whole statements) -> typed rows. Works on batch and
    streaming frames alike (only row-wise expressions and explode)."""
    record = F.regexp_replace(F.col(text_col), COMMENT_PATTERN, "")
    at = F.instr(record, ";")
    one = (at == 0) | (at == F.length(F.rtrim(record))) | F.regexp_like(record, F.lit(PROGRAM_PATTERN))
    statements = F.when(one, F.array(record)).otherwise(F.regexp_extract_all(record, F.lit(STATEMENT_PATTERN), F.lit(0)))
    lines = lines.select(F.explode(statements).alias("_text"))
    text = F.regexp_replace("_text", COMMENT_PATTERN, "")
    first = F.lower(F.substring(F.trim(text), 1, 7))
    is_rows = first.startswith("insert") | first.startswith("replace")
    hides = F.regexp_like(text, F.lit(ROWS_PATTERN)) & (
        F.regexp_like(text, F.lit(PROGRAM_PATTERN)) | F.regexp_like(text, F.lit(OPEN_PATTERN)))
    kind = (F.when(is_rows, F.lit(True)).when(F.regexp_like(text, F.lit(IGNORABLE_PATTERN)) & ~hides, F.lit(False))
            .otherwise(F.raise_error(F.concat(F.lit("unrecognised statement in dump (statements_span_lines reads "
                                                    "statements over several lines): "), F.substring(text, 1, 200)))))
    # A filter may be moved past an expression that raises, so what a record is, is part of each
    # such expression; records without rows of this table come out as empty arrays.
    stmts = lines.select(kind.alias("_kind"), text.alias("_stmt")).select(
        "_kind", F.concat(F.regexp_extract("_stmt", HEAD_PATTERN, 1), F.regexp_extract("_stmt", HEAD_PATTERN, 2)).alias("_table"),
        F.regexp_extract("_stmt", HEAD_PATTERN, 3).alias("_cols"),
        F.regexp_replace("_stmt", HEAD_PATTERN, "").alias("_body"))
    # a head that does not parse counts as this table's, so the check below reports it
    mine = F.col("_kind") if table is None else F.col("_kind") & ((F.col("_table") == table) | (F.col("_table") == ""))
    stmts = stmts.withColumn("_mine", mine)
    stmts = stmts.withColumn("_rows", F.when(F.col("_mine"), F.regexp_extract_all("_body", F.lit(TUPLE_PATTERN), 1))
                             .otherwise(F.array().cast("array<string>")))
    # Every character of VALUES must belong to a parsed row: text the patterns cannot read
    # (function calls, ON DUPLICATE KEY ..., a head that does not parse) fails the load
    # instead of silently losing rows. Rows, their parentheses, the commas between them and the
    # semicolon make up the whole text of most statements; others are looked at again.
    used = F.aggregate("_rows", F.lit(0), lambda n, r: n + F.length(r) + 3)
    whole = (F.size("_rows") > 0) & (F.length("_body") == used) & F.endswith("_body", F.lit(";"))
    rest = F.regexp_replace("_body", TUPLE_PATTERN, "")
    stmts = stmts.withColumn("_rows", F.when(~F.col("_mine"), F.col("_rows")).when(
        (F.col("_table") != "") & (whole | (F.regexp_like(rest, F.lit(LEFTOVER_PATTERN)) & (F.size("_rows") > 0))), F.col("_rows"))
        .otherwise(F.raise_error(F.concat(F.lit("unparsed INSERT text: "), F.substring(rest, 1, 200)))))
    names = F.when(F.col("_cols") == "", F.lit(None).cast("array<string>")).otherwise(
        F.transform(F.split(F.col("_cols"), ","), lambda c: F.lower(F.trim(F.regexp_replace(c, "`", "")))))
    unknown = F.array_except("_names", F.lit([f.name.lower() for f in schema.fields]))
    stmts = stmts.select(names.alias("_names"), "_rows", "_mine").select(
        F.when(~F.col("_mine") | (F.coalesce(F.size(unknown), F.lit(0)) <= 0), F.col("_names")).otherwise(
            F.raise_error(F.concat(F.lit("columns not in the schema: "), F.array_join(unknown, ", ")))).alias("_names"), "_rows")
    rows = stmts.select("_names", F.explode("_rows").alias("_row"))
    fields = rows.select("_names", F.regexp_extract_all(F.col("_row"), F.lit(FIELD_PATTERN), 1).alias("_f"))
    expected = F.when(F.col("_names").isNull(), F.lit(len(schema.fields))).otherwise(F.size("_names"))
    checked = fields.select("_names", F.when(F.size("_f") == expected, F.col("_f")).otherwise(
        F.raise_error(F.concat(F.lit("dump row has "), F.size("_f").cast("string"),
                               F.lit(" fields, expected "), expected.cast("string")))).alias("_f"))
    out = []
    for i, f in enumerate(schema.fields):
        pos = F.when(F.col("_names").isNull(), F.lit(i + 1)).otherwise(
            F.array_position(F.col("_names"), f.name.lower()).cast("int"))
        raw = F.when(pos > 0, F.element_at(F.col("_f"), pos))
        out.append(_cast(decode_field(raw, empty_as_null), f.dataType, tz, raw).alias(f.name))
    return checked.select(*out)


def read_sql_dump(spark: SparkSession, path: str | list[str], schema: StructType | str, *,
                  table: str | None = None, tz: str | None = "UTC", empty_as_null: bool = False,
                  statements_span_lines: bool = False, long_lines: bool = False) -> DataFrame:
    """Load the rows of one table from MySQL dump files.

    `statements_span_lines=True` reads statement by statement (they end at a semicolon and a line
    end, with or without a carriage return) for dumps that break one INSERT over several lines;
    the default reads line by line, which is how mysqldump writes them. A file whose statements end
    in ";\\r\\n" is one record of the scan in this mode.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    if long_lines:
        lines = statement_records(spark, path)
    elif statements_span_lines:
        ends = F.split("value", ";[ \\t]*\\r?\\n")
        lines = (spark.read.option("lineSep", ";\n").text(path).select(F.explode(ends).alias("value"))
                 .select(F.regexp_replace("value", r"[\s;]+$", "").alias("value"))
                 .select(F.concat("value", F.lit(";")).alias("value")))
    else:
        lines = spark.read.text(path)
    return normalize_zone(parse_statements(lines, schema, table, empty_as_null=empty_as_null, tz=tz), tz)
