"""DuckDB SQL for each registered query (views named after the benchmark tables).

Column names match the Spark side exactly. ASC in DuckDB defaults to NULLS LAST while
Spark's ascending order puts NULLs first, so every ORDER BY states its NULL placement.
"""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {
    "filter_eq_limit": """
        SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING'
        ORDER BY c_name NULLS FIRST LIMIT 100""",
    "append_constant": """
        SELECT o_orderkey, 4100 AS survey_nr FROM orders""",
    "distinct_values": """
        SELECT DISTINCT event_type FROM events""",
    "global_row_number": """
        SELECT *, row_number() OVER (ORDER BY o_orderkey DESC NULLS LAST, o_custkey DESC NULLS LAST,
            o_orderstatus DESC NULLS LAST, o_totalprice DESC NULLS LAST,
            o_orderdate DESC NULLS LAST, o_orderpriority DESC NULLS LAST) AS nr
        FROM orders""",
    "row_number_wide": """
        SELECT doc_id, lang, source, n_chars, row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST,
            text NULLS FIRST, source NULLS FIRST, n_chars NULLS FIRST) AS nr
        FROM documents""",
    "date_expressions": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day_stamp,
               strftime(o_orderdate, '%Y%m%d%H%M') AS minute_stamp, o_orderdate + INTERVAL 48 HOURS AS expires
        FROM orders""",
    "survey_id": """
        SELECT o_orderkey, o_custkey, o_orderstatus, survey_nr, nr,
               '1' || CAST(survey_nr AS VARCHAR) || '20221125' || CAST(nr + 100000 AS VARCHAR) AS odl_id
        FROM (SELECT o_orderkey, o_custkey, o_orderstatus, 4100 AS survey_nr,
                     row_number() OVER (ORDER BY o_orderkey DESC NULLS LAST, o_custkey DESC NULLS LAST,
                                        o_orderstatus DESC NULLS LAST) AS nr
              FROM orders)""",
    "positional_zip": """
        WITH c AS (SELECT *, row_number() OVER (ORDER BY c_custkey NULLS FIRST, c_name NULLS FIRST,
                       c_nationkey NULLS FIRST, c_acctbal NULLS FIRST, c_mktsegment NULLS FIRST) AS rn
                   FROM customer),
             o AS (SELECT *, row_number() OVER (ORDER BY o_orderkey NULLS FIRST, o_custkey NULLS FIRST,
                       o_orderstatus NULLS FIRST, o_totalprice NULLS FIRST, o_orderdate NULLS FIRST,
                       o_orderpriority NULLS FIRST) AS rn
                   FROM orders)
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
               o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM c JOIN o USING (rn)""",
    "join_chain": """
        SELECT o_orderkey, c_name, n_name
        FROM orders JOIN customer ON o_custkey = c_custkey
                    JOIN nation ON c_nationkey = n_nationkey""",
    "survey_selection": """
        SELECT o_orderkey, o_custkey, c_mktsegment, n_name,
               '1' || '4100' || '20221125' ||
               CAST(row_number() OVER (ORDER BY o_orderkey DESC NULLS LAST) + 100000 AS VARCHAR) AS odl_id,
               '202211' AS year_month
        FROM orders
        JOIN customer ON o_custkey = c_custkey
        LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1) n ON c_nationkey = n.n_nationkey
        WHERE o_orderstatus = 'F'""",
}


_SELECTED = ORACLE_SQL["survey_selection"]
_COLUMNS = "o_orderkey, o_custkey, c_mktsegment, n_name, odl_id, year_month"

ORACLE_SQL.update({
    "row_number_stored": "SELECT *, row_number() OVER () AS nr FROM orders",
    "positional_zip_stored": """
        SELECT s.* EXCLUDE rn, c.* EXCLUDE rn FROM (SELECT *, row_number() OVER () AS rn FROM supplier) s
        JOIN (SELECT *, row_number() OVER () AS rn FROM customer) c USING (rn)""",
    "join_skewed": """
        SELECT o_orderkey, o_fk, c_custkey, c_name, c_mktsegment
        FROM (SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1
                                      WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_fk FROM orders)
        LEFT JOIN customer ON o_fk = c_custkey""",
    "cast_loss": """
        SELECT 'l_orderkey' AS "column", 'bigint' AS from_type, 'smallint' AS to_type,
               count(*) FILTER (l_orderkey NOT BETWEEN -32768 AND 32767) AS nulled, 0::BIGINT AS cut, 0::BIGINT AS rounded FROM lineitem
        UNION ALL SELECT 'l_quantity', 'double', 'int', 0, count(*) FILTER (l_quantity <> trunc(l_quantity)), 0 FROM lineitem
        UNION ALL SELECT 'l_extendedprice', 'double', 'decimal(12,1)', 0, 0,
               count(*) FILTER (l_extendedprice <> CAST(CAST(l_extendedprice AS DECIMAL(12, 1)) AS DOUBLE)) FROM lineitem
        UNION ALL SELECT 'l_discount', 'double', 'int', 0, count(*) FILTER (l_discount <> trunc(l_discount)), 0 FROM lineitem
        UNION ALL SELECT 'l_tax', 'double', 'float', 0, 0, count(*) FILTER (l_tax <> CAST(CAST(l_tax AS FLOAT) AS DOUBLE)) FROM lineitem
        UNION ALL SELECT 'l_returnflag', 'string', 'int', count(*) FILTER (l_returnflag IS NOT NULL AND TRY_CAST(l_returnflag AS INT) IS NULL), 0, 0 FROM lineitem
        UNION ALL SELECT 'l_shipdate', 'timestamp_ntz', 'date', 0, count(*) FILTER (l_shipdate <> date_trunc('day', l_shipdate)), 0 FROM lineitem
        UNION ALL SELECT 'l_linenumber', 'int', 'bigint', 0, 0, 0 FROM (SELECT 1)""",
    "align_quarantine": """
        SELECT o_orderkey, o_custkey, CASE WHEN o_custkey NOT BETWEEN -128 AND 127 THEN 'nulled' END AS key_reason,
               CASE WHEN o_orderdate <> date_trunc('day', o_orderdate) THEN 'cut' END AS date_reason FROM orders""",
    "run_repeated": f"""
        WITH s AS ({_SELECTED}) SELECT {_COLUMNS} FROM s UNION ALL SELECT {_COLUMNS} FROM s WHERE n_name IS NULL""",
    "write_only_changed": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderpriority = '2-HIGH' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority, o_orderpriority = '2-HIGH' AS rewritten
        FROM orders""",
})


# ---- schema, run report, catalog and sinks -------------------------------------------------

ORACLE_SQL.update({
    "align_schema": """
        SELECT c_custkey AS C_CUSTKEY, c_name, CAST(NULL AS VARCHAR) AS c_phone,
               CAST(c_acctbal AS VARCHAR) AS c_acctbal
        FROM customer""",
    "schema_drift": """
        SELECT 'c_phone' AS "column", 'missing' AS status, count(*) AS "rows" FROM customer
        UNION ALL SELECT 'c_nationkey', 'extra', count(c_nationkey) FROM customer
        UNION ALL SELECT 'c_mktsegment', 'extra', count(c_mktsegment) FROM customer
        UNION ALL SELECT 'c_mktsegment', 'partition_removed', count(c_mktsegment) FROM customer""",
    "run_summary": """
        SELECT 'RUN_4100' AS survey, 'sluice_scratch.sl_survey_run' AS table_name, count(*) AS amount,
               '20221125' AS run_date, 'append' AS mode, 'Completed' AS status, count(*) AS held
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderstatus = 'F'""",
    "write_dry_run": """
        SELECT 'RUN_4100' AS survey, 'sluice_scratch.sl_dry_run' AS table_name, count(*) AS amount,
               '20221125' AS run_date, 'overwrite' AS mode, 'Dry run' AS status,
               count(*) FILTER (WHERE n.n_name IS NULL) AS held
        FROM orders JOIN customer ON o_custkey = c_custkey
        LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1) n ON c_nationkey = n.n_nationkey
        WHERE o_orderstatus = 'F'""",
    "view_like_filter": """
        SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE p_type LIKE 'S%'""",
    "scan_catalog": "SELECT * FROM orders",
    "write_partitioned": "SELECT * FROM orders",
    "write_append": "SELECT * FROM orders",
    "write_truncate_load": "SELECT * FROM orders",
    "write_truncate_load_external": "SELECT * FROM orders",
    "write_overwrite": "SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT'",
    "write_dynamic_overwrite": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice * 2
                    ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM orders""",
    "csv_types": """
        WITH n AS (SELECT count(*) AS n, max(length(CAST(CAST(floor(abs(o_totalprice)) AS BIGINT) AS VARCHAR))) AS d,
                          count(*) FILTER (o_orderkey % 3 <> 0) AS rest, count(*) FILTER (o_orderkey % 1000 = 7) AS odd FROM orders)
        SELECT * FROM (
            SELECT 'o_orderkey' AS "column", 0 AS position, 'bigint' AS type, n AS "values", 0::BIGINT AS "nulls", CAST(NULL AS VARCHAR) AS breaks FROM n
            UNION ALL SELECT 'price', 1, 'decimal(' || (d + 2) || ',2)', n, 0,
                      (SELECT min(CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR)) FROM orders) FROM n
            UNION ALL SELECT 'o_orderpriority', 2, 'string', n, 0, NULL FROM n
            UNION ALL SELECT 'day', 3, 'date', n, 0, NULL FROM n
            UNION ALL SELECT 'o_orderdate', 4, 'timestamp_ntz', n, 0,
                      (SELECT min(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f')) FROM orders) FROM n
            UNION ALL SELECT 'even', 5, 'boolean', n, 0, NULL FROM n
            UNION ALL SELECT 'nothing', 6, 'null', 0, n, NULL FROM n
            UNION ALL SELECT 'mixed', 7, CASE WHEN odd > 0 THEN 'double' ELSE 'bigint' END, n, 0, CASE WHEN odd > 0 THEN '7e1' END FROM n
            UNION ALL SELECT 'some', 8, 'bigint', n - rest, rest, NULL FROM n)""",
    "load_csv": "SELECT * FROM events",
    "load_csv_text": "SELECT * FROM documents",
    "load_csv_inferred": "SELECT * FROM lineitem",
    "load_csv_blank_null": """
        SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS c_name,
               c_nationkey, c_acctbal, c_mktsegment
        FROM customer""",
    "load_json": "SELECT * FROM events",
    "load_sql_dump": "SELECT * FROM documents",
    "load_sql_dump_long_lines": "SELECT * FROM documents",
    "stream_dump_ingest": "SELECT * FROM documents",
})


# ---- generator: the same md5-derived values in SQL ------------------------------------------

def _synth_sql() -> dict[str, str]:
    from ..operators.synth import (PERM_MULTIPLIER_MAX, SECONDS_PER_STEP, STEP_MIN, STEP_SPAN,
                                   STRING_LEN, perm_offset)
    from ..functions.permute import HEX_DIGITS, ROUNDS
    from .queries import SYNTH_BASE_TS, SYNTH_SEED, SYNTH_STAMP

    def h(name):
        return f"md5(concat_ws('|', '{SYNTH_SEED}', '{name}', CAST(id AS VARCHAR)))"

    def x(name):
        return f"('0x' || substr({h(name)}, 13, 8))::BIGINT"

    def choice(name, table, column=None):
        values = f"(SELECT list(v ORDER BY v) FROM (SELECT DISTINCT {column or name} AS v FROM {table}) WHERE v IS NOT NULL)"
        return f"{values}[{x(name)} % len({values}) + 1]"

    def string(name):
        return f"lpad(to_base(('0x' || substr({h(name)}, 1, 12))::BIGINT, 36), {STRING_LEN}, '0')"

    def ts(name):
        return (f"TIMESTAMP '{SYNTH_BASE_TS}' - to_seconds({SECONDS_PER_STEP} * "
                f"({STEP_MIN} + {x(name)} % {STEP_SPAN}))")

    def key(prefix, n_sql):
        # valid while the row count is below the multiplier (then it is coprime with it)
        return (f"concat_ws('_', '{prefix}', '{SYNTH_STAMP}', CAST((CAST({PERM_MULTIPLIER_MAX} AS HUGEINT) * id"
                f" + {perm_offset(prefix, SYNTH_SEED)}) % ({n_sql}) AS VARCHAR))")

    def shuffled(prefix, table, walks=8):
        """The Feistel walk as nested selects (n, a and b are those of `rectangle`)."""
        sql = f"""SELECT id, id AS y, n, a, greatest(1, (n + a - 1) // a) AS b
            FROM (SELECT id, n, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM {ids(table)}, (SELECT count(*) AS n FROM {table}))"""

        def f(i, v):
            return f"('0x' || substr(md5(concat_ws('|', '{SYNTH_SEED}|{prefix}', '{i}', CAST({v} AS VARCHAR))), 1, {HEX_DIGITS}))::BIGINT"
        for w in range(walks):
            sql = f"SELECT *, y // b AS u, y % b AS v FROM ({sql})"
            for i in range(ROUNDS):
                change = f"(u + {f(i, 'v')}) % a AS u" if i % 2 == 0 else f"(v + {f(i, 'u')}) % b AS v"
                sql = f"SELECT * REPLACE ({change}) FROM ({sql})"
            sql = f"SELECT id, {'u * b + v' if w == 0 else 'CASE WHEN y < n THEN y ELSE u * b + v END'} AS y, n, a, b FROM ({sql})"
        return sql

    whole = ["l_orderkey", "l_partkey", "l_suppkey"]
    tenths = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    columns = ([f"{x(c)} % 1000000 AS {c}" for c in whole] + [f"CAST({x('l_linenumber')} % 1000 AS INTEGER) AS l_linenumber"]
               + [f"({x(c)} % 1000000) / CAST(100.0 AS DOUBLE) AS {c}" for c in tenths]
               + [f"{string(c)} AS {c}" for c in ("l_returnflag", "l_linestatus")] + [f"{ts('l_shipdate')} AS l_shipdate"])

    def ids(table):
        return f"(SELECT row_number() OVER () - 1 AS id FROM {table})"

    return {
        "synth_table": f"""
            SELECT {x('o_orderkey')} % 1000000 AS o_orderkey,
                   {x('o_custkey')} % 1000000 AS o_custkey,
                   {choice('o_orderstatus', 'orders')} AS o_orderstatus,
                   ({x('o_totalprice')} % 1000000) / CAST(100.0 AS DOUBLE) AS o_totalprice,
                   {ts('o_orderdate')} AS o_orderdate,
                   {string('o_orderpriority')} AS o_orderpriority
            FROM {ids('orders')}""",
        "synth_lineitem": f"""
            SELECT {", ".join(columns)}
            FROM {ids('lineitem')}""",
        "synth_keys": f"""
            SELECT {key('party', 'SELECT count(*) FROM customer')} AS c_name,
                   {x('c_custkey')} % 1000000 AS c_custkey,
                   {x('s_suppkey')} % 1000000 AS s_suppkey
            FROM {ids('customer')}""",
        "synth_keys_shuffled": f"""
            SELECT concat_ws('_', 'party', '{SYNTH_STAMP}', CAST(y AS VARCHAR)) AS c_name,
                   {x('c_custkey')} % 1000000 AS c_custkey
            FROM ({shuffled('party', 'customer')})""",
        "synth_choice": f"""
            SELECT {x('c_custkey')} % 1000000 AS c_custkey, CAST(NULL AS VARCHAR) AS c_name,
                   {choice('c_nationkey', 'nation', 'n_nationkey')} AS c_nationkey,
                   ({x('c_acctbal')} % 1000000) / CAST(100.0 AS DOUBLE) AS c_acctbal,
                   {choice('c_mktsegment', 'customer')} AS c_mktsegment
            FROM {ids('customer')}""",
    }


ORACLE_SQL.update(_synth_sql())
