"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Views ``region nation customer supplier part orders lineitem events ...`` are
registered over the same parquet files.  Dialect notes: DuckDB's ``year``,
``count`` and ``sum`` widen to BIGINT/HUGEINT and its double -> int casts
round, so results are cast and truncated to Spark's types; its
``dayofweek`` is Sunday=0.  Timestamps are compared as DATEs.
"""

from __future__ import annotations

from stellate.plans.load_queries import LOAD_SQL
from stellate.plans.star_queries import STAR_SQL
from stellate.sources.tables import TABLES

_CUSTOMER_CODES = """
    (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS c_nationkey FROM customer)
"""

_LINES = """
    (SELECT CASE WHEN l_linenumber = 7 THEN l_suppkey + 1099511627776 WHEN l_linenumber = 6 THEN NULL ELSE l_suppkey END AS l_suppkey,
            CASE WHEN l_linenumber = 5 AND l_orderkey % 4 = 0 THEN l_orderkey + 1099511627776 ELSE l_orderkey END AS l_orderkey,
            l_linenumber, l_quantity, l_returnflag, l_linestatus, l_shipdate
     FROM lineitem)
"""

_ORDERS_GAPS = """
    SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, 'F') AS o_orderstatus, o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate, NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority
    FROM orders
"""


def _completeness_sql(source: str, cols: list[str]) -> str:
    counts = ", ".join(f"count({c}) AS c_{c}" for c in cols)
    parts = [
        f"SELECT '{c}' AS column_name, c_{c} AS non_null, total, "
        f"round(CAST(c_{c} AS DOUBLE) * 100.0 / CAST(total AS DOUBLE), 6) AS pct FROM k"
        for c in cols
    ]
    return f"WITH s AS ({source}), k AS (SELECT count(*) AS total, {counts} FROM s) " + " UNION ALL ".join(parts)


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

_LINE_REST = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]

_EVENTS_TEXT = """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, user_id, event_type,
           CASE WHEN value < 5 THEN 'None' WHEN value < 6 THEN NULL ELSE CAST(value AS VARCHAR) END AS value_text,
           value
    FROM events
"""

_PRICE_TEXT = "(SELECT p_partkey, CASE WHEN p_size < 5 THEN 'n/a' ELSE CAST(p_retailprice AS VARCHAR) END AS price_text FROM part)"

_DATES = "SELECT CAST(o_orderdate AS DATE) AS \"time\" FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem"

_ORDER_LINES = """
    SELECT o.o_orderkey, o.o_orderpriority, CAST(l.l_shipdate AS DATE) AS ship_date
    FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
"""

_ORDERS_MONTH_NATION = """
    SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(month(o.o_orderdate) AS INTEGER) AS month,
           n.n_name AS nation, count(*) AS n_orders
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    GROUP BY 1, 2, 3
"""

_KNOWN_ORDERS_MONTH_NATION = _ORDERS_MONTH_NATION.replace(
    "orders o JOIN customer c ON", "orders o LEFT JOIN customer c ON o.o_custkey % 10 <> 0 AND")

_LINES_MONTH_NATION = f"""
    SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year, CAST(month(l.l_shipdate) AS INTEGER) AS month,
           n.n_name AS nation, avg(l.l_quantity) AS avg_quantity
    FROM {_LINES} l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
    LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
    GROUP BY 1, 2, 3
"""

_ORDERS_SLIM = "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"

ORACLE_SQL: dict[str, str] = {
    "scan_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES
    ),
    "scan_csv": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
        FROM customer
    """,
    "scan_csv_semicolon": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
               CAST(p_retailprice AS VARCHAR) AS p_retailprice
        FROM part
    """,
    "codelist_parse": """
        SELECT 'cust_' || CAST(c_custkey // 1000 AS VARCHAR) AS list_name, CAST(c_custkey AS VARCHAR) AS code,
               c_name || '''s shop; /* open */ ''daily''' AS label
        FROM customer
    """,
    "codelist_inline": """
        SELECT v.label AS status_label, count(*) AS n
        FROM orders LEFT JOIN (VALUES ('F', 'Fulfilled'), ('O', 'Open'), ('P', 'Partial')) v(code, label)
          ON o_orderstatus = v.code
        GROUP BY 1
    """,
    "profile_completeness": _completeness_sql(_ORDERS_GAPS, _ORDER_COLS),
    "profile_schema": """
        WITH k AS (SELECT count(*) AS total, count(o_orderkey) AS a, count(o_custkey) AS b, count(o_orderstatus) AS c,
                          count(o_totalprice) AS d, count(o_orderdate) AS e, count(o_orderpriority) AS f FROM orders),
        l AS (SELECT 'o_orderkey' AS column_name, a AS non_null, total FROM k
              UNION ALL SELECT 'o_custkey', b, total FROM k UNION ALL SELECT 'o_orderstatus', c, total FROM k
              UNION ALL SELECT 'o_totalprice', d, total FROM k UNION ALL SELECT 'o_orderdate', e, total FROM k
              UNION ALL SELECT 'o_orderpriority', f, total FROM k),
        s(position, column_name, data_type, nullable) AS (VALUES
              (0, 'o_orderkey', 'bigint', true), (1, 'o_custkey', 'bigint', true),
              (2, 'o_orderstatus', 'string', true), (3, 'o_totalprice', 'double', true),
              (4, 'o_orderdate', 'timestamp_ntz', true), (5, 'o_orderpriority', 'string', true))
        SELECT CAST(s.position AS INTEGER) AS position, s.column_name, s.data_type, s.nullable, l.non_null, l.total
        FROM s JOIN l ON s.column_name = l.column_name
    """,
    "group_count": "SELECT p_type, count(*) AS n FROM part GROUP BY p_type",
    "column_mismatch_count": """
        SELECT count(*) AS n_mismatch
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        WHERE CAST(o.o_orderdate AS DATE) <> CAST(l.l_shipdate AS DATE)
    """,
    "preview_top_n": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
               o_orderpriority
        FROM orders ORDER BY o_orderkey LIMIT 5
    """,
    "filter_equals": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
               o_orderpriority
        FROM orders WHERE o_orderstatus = 'F'
    """,
    "filter_not_null": f"SELECT o_orderkey, o_orderpriority FROM ({_ORDERS_GAPS}) WHERE o_orderpriority IS NOT NULL",
    "filter_sentinel": """
        SELECT o_orderkey, status_text FROM (
          SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'None' WHEN o_orderstatus = 'P' THEN NULL
                                  ELSE o_orderstatus END AS status_text FROM orders)
        WHERE status_text <> 'None'
    """,
    "drop_columns": "SELECT p_partkey, p_type, p_size, p_retailprice FROM part",
    "rename_columns": """
        SELECT p_partkey AS part_key, p_name AS part_name, p_type AS part_type, p_size AS "size-class",
               p_retailprice AS Retail_Price
        FROM part
    """,
    "drop_low_completeness": """
        SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN NULL
                    ELSE o_orderpriority END AS o_orderpriority
        FROM orders
    """,
    "dedup_by_key": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                           ORDER BY {", ".join(c + " NULLS FIRST" for c in _LINE_REST)}) AS rn
              FROM lineitem)
        WHERE rn = 1
    """,
    "dedup_report": """
        WITH k AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
        SELECT CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_out, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
               count(*) FILTER (WHERE n > 1) AS duplicated_keys
        FROM k
    """,
    "clean_temperature": f"""
        SELECT event_id, event_type, CAST(dt AS DATE) AS event_date, TRY_CAST(value_text AS DOUBLE) AS value
        FROM ({_EVENTS_TEXT}) WHERE event_type = 'click' AND value_text <> 'None'
    """,
    "clean_airport": """
        WITH p AS (SELECT p_partkey, p_name, NULLIF(p_type, 'ECONOMY') AS p_type, p_size, p_retailprice FROM part),
        d AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey NULLS FIRST, p_type NULLS FIRST,
                                           p_size NULLS FIRST, p_retailprice NULLS FIRST) AS rn FROM p)
        SELECT p_partkey, p_name, p_type, p_size, p_retailprice FROM d WHERE rn = 1 AND p_type IS NOT NULL
    """,
    "code_lookup": f"""
        SELECT c_custkey, c_nationkey, n.n_name AS nation_name
        FROM {_CUSTOMER_CODES} c LEFT JOIN nation n ON c_nationkey = n.n_nationkey
    """,
    "code_lookup_typed": f"""
        SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS nation_code, n.n_name AS nation_name
        FROM {_CUSTOMER_CODES} c LEFT JOIN nation n ON c_nationkey = n.n_nationkey
    """,
    "code_lookup_default": f"""
        SELECT c_custkey, c_nationkey, COALESCE(n.n_name, 'Other') AS nation_name
        FROM {_CUSTOMER_CODES} c LEFT JOIN nation n ON c_nationkey = n.n_nationkey
    """,
    "role_playing_lookup": """
        SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS n_lines
        FROM """ + _LINES + """ l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
        LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
        LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
        LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
        GROUP BY 1, 2
    """,
    "sas_date": """
        SELECT o_orderkey, CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS day_number,
               CAST(o_orderdate AS DATE) AS order_date
        FROM orders
    """,
    "parse_date": """
        SELECT o_orderkey, date_text, CAST(TRY_STRPTIME(date_text, '%Y-%m-%d') AS DATE) AS parsed_date
        FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'not a date'
                                      ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS date_text
              FROM orders)
    """,
    "tolerant_cast": f"""
        SELECT p_partkey, CAST(trunc(TRY_CAST(price_text AS DOUBLE)) AS INTEGER) AS price_int,
               TRY_CAST(price_text AS DOUBLE) AS price_double
        FROM {_PRICE_TEXT}
    """,
    "cast_losses": f"""
        SELECT 'price_text' AS column_name, count(price_text) AS non_null_in,
               count(*) FILTER (WHERE price_text IS NOT NULL AND TRY_CAST(price_text AS DOUBLE) IS NULL) AS lost
        FROM {_PRICE_TEXT}
    """,
    "conform_fact": """
        SELECT l.l_orderkey, l.l_linenumber, CAST(o.o_orderdate AS DATE) AS order_date,
               CAST(l.l_shipdate AS DATE) AS ship_date, cn.n_name AS customer_nation, sn.n_name AS supplier_nation,
               CAST(trunc(l.l_quantity) AS INTEGER) AS quantity, st.label AS order_status,
               rf.label AS return_status, ls.label AS line_status
        FROM """ + _LINES + """ l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
        LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
        LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
        LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
        LEFT JOIN (VALUES ('F', 'Fulfilled'), ('O', 'Open'), ('P', 'Partial')) st(code, label) ON o.o_orderstatus = st.code
        LEFT JOIN (VALUES ('A', 'Accepted'), ('N', 'Not returned'), ('R', 'Returned')) rf(code, label) ON l.l_returnflag = rf.code
        LEFT JOIN (VALUES ('F', 'Finished'), ('O', 'Open')) ls(code, label) ON l.l_linestatus = ls.code
    """,
    "conform_measure": f"""
        SELECT row_number() OVER (ORDER BY event_id) - 1 AS id, event_id, user_id, event_type,
               CAST(dt AS DATE) AS event_date, TRY_CAST(value_text AS DOUBLE) AS value
        FROM ({_EVENTS_TEXT})
    """,
    "conform_dimension": """
        SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_type AS type, p_size AS size,
               p_retailprice AS retail_price
        FROM part
    """,
    "conform_dimension_wide": """
        SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS id, s_suppkey, s_name AS name, s_nationkey AS nation,
               s_acctbal AS acctbal, CAST(trunc(s_acctbal) AS INTEGER) AS acctbal_whole
        FROM supplier
    """,
    "time_union": _DATES,
    "time_dimension": f"""
        SELECT "time", CAST(year("time") AS INTEGER) AS year, CAST(month("time") AS INTEGER) AS month,
               CAST(dayofweek("time") + 1 AS INTEGER) AS day_of_week, CAST(isodow("time") - 1 AS INTEGER) AS weekday,
               CAST(dayofmonth("time") AS INTEGER) AS day_of_month, CAST(dayofyear("time") AS INTEGER) AS day_of_year,
               CAST(weekofyear("time") AS INTEGER) AS week_of_year
        FROM ({_DATES}) WHERE "time" IS NOT NULL
    """,
    "time_join": """
        SELECT CAST(year(CAST(l_shipdate AS DATE)) AS INTEGER) AS year,
               CAST(weekofyear(CAST(l_shipdate AS DATE)) AS INTEGER) AS week_of_year,
               count(*) AS n_lines, round(sum(l_quantity), 6) AS sum_qty
        FROM (SELECT CASE WHEN l_linenumber < 7 THEN l_shipdate END AS l_shipdate, l_quantity FROM lineitem) GROUP BY 1, 2
    """,
    "surrogate_key": """
        SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS id, o_orderkey, o_custkey FROM orders
    """,
    "write_roundtrip": "SELECT * FROM part",
    "write_sample": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
               o_orderpriority
        FROM orders ORDER BY o_orderkey LIMIT 5
    """,
    "load_table": "SELECT p_partkey, p_name, p_type, p_size, p_retailprice FROM part",
    "apply_contract": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
               o_orderpriority
        FROM orders
    """,
    "catalog_load": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
               o_orderpriority
        FROM orders
    """,
    "code_lookup_sql": f"""
        SELECT c_custkey, c_nationkey, n.n_name AS nation_name
        FROM {_CUSTOMER_CODES} c LEFT JOIN nation n ON c_nationkey = n.n_nationkey
    """,
    "contract_rejects": f"""
        WITH j AS ({_ORDER_LINES}),
        r AS (SELECT 'o_orderpriority longer than 8' AS reason FROM j WHERE length(o_orderpriority) > 8
              UNION ALL SELECT 'ship_date is null' FROM j WHERE ship_date IS NULL)
        SELECT reason, count(*) AS n_rows FROM r GROUP BY reason
    """,
    "contract_split": f"""
        SELECT count(*) FILTER (WHERE ship_date IS NOT NULL AND NOT length(o_orderpriority) > 8) AS valid_rows,
               count(*) FILTER (WHERE ship_date IS NULL OR length(o_orderpriority) > 8) AS rejected_rows
        FROM ({_ORDER_LINES})
    """,
    "contract_key_rejects": """
        SELECT 'l_orderkey, l_linenumber duplicated' AS reason, CAST(sum(n) AS BIGINT) AS n_rows
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    """,
    "key_uniqueness": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
    "bucketed_join": """
        SELECT o.o_orderstatus, count(*) AS n_lines, round(sum(l.l_quantity), 6) AS sum_qty
        FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
        GROUP BY 1
    """,
    "load_report": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, true AS timed FROM {t}"
        for t in ("part", "supplier", "customer", "orders", "lineitem")
    ),
    "quality_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS expected, count(*) AS actual, CAST(0 AS BIGINT) AS missing, "
        f"true AS ok FROM {t}"
        for t in ("part", "supplier", "customer", "orders", "lineitem")
    ),
    "quality_completeness": """
        WITH o AS (SELECT count(*) AS t, count(o_orderdate) AS a, count(NULLIF(o_orderstatus, 'F')) AS b,
                          count(NULLIF(o_orderpriority, '5-LOW')) AS c FROM orders),
        l AS (SELECT count(*) AS t, count(l_shipdate) AS a, count(l_returnflag) AS b FROM lineitem),
        c AS (SELECT count(*) AS t, count(c_name) AS a, count(c_nationkey) AS b FROM customer),
        s AS (SELECT count(*) AS t, count(s_name) AS a FROM supplier),
        p AS (SELECT count(*) AS t, count(p_name) AS a, count(NULLIF(p_type, 'PROMO')) AS b FROM part),
        r AS (
          SELECT 'orders' AS table_name, 'o_orderdate' AS column_name, a AS n, t FROM o
          UNION ALL SELECT 'orders', 'o_orderstatus', b, t FROM o
          UNION ALL SELECT 'orders', 'o_orderpriority', c, t FROM o
          UNION ALL SELECT 'lineitem', 'l_shipdate', a, t FROM l
          UNION ALL SELECT 'lineitem', 'l_returnflag', b, t FROM l
          UNION ALL SELECT 'customer', 'c_name', a, t FROM c
          UNION ALL SELECT 'customer', 'c_nationkey', b, t FROM c
          UNION ALL SELECT 'supplier', 's_name', a, t FROM s
          UNION ALL SELECT 'part', 'p_name', a, t FROM p
          UNION ALL SELECT 'part', 'p_type', b, t FROM p)
        SELECT table_name, column_name, round(CAST(n AS DOUBLE) * 100.0 / CAST(t AS DOUBLE), 6) AS pct,
               COALESCE(CAST(n AS DOUBLE) * 100.0 / CAST(t AS DOUBLE) = 100.0, false) AS ok
        FROM r
    """,
    "arrivals_by_place": _KNOWN_ORDERS_MONTH_NATION,
    "drill_across": f"""
        WITH a AS ({_KNOWN_ORDERS_MONTH_NATION}), b AS ({_LINES_MONTH_NATION})
        SELECT COALESCE(a.year, b.year) AS year, COALESCE(a.month, b.month) AS month,
               COALESCE(a.nation, b.nation) AS nation, a.n_orders, round(b.avg_quantity, 6) AS avg_quantity
        FROM a FULL JOIN b ON a.year IS NOT DISTINCT FROM b.year AND a.month IS NOT DISTINCT FROM b.month
          AND a.nation IS NOT DISTINCT FROM b.nation
    """,
    "partition_pruned_read": """
        SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS order_year
        FROM orders WHERE year(o_orderdate) >= 1998
    """,
    "incremental_append": _ORDERS_SLIM,
    "incremental_stream": _ORDERS_SLIM,
    **STAR_SQL,
    **LOAD_SQL,
}
