"""Building blocks of the SQL twins: the feeds of ``feeds`` as common table expressions."""

from __future__ import annotations


def win(w: str, size: str = "10 seconds") -> str:
    return (f"strftime({w}, '%Y-%m-%d %H:%M:%S') AS stt, "
            f"strftime({w} + INTERVAL '{size}', '%Y-%m-%d %H:%M:%S') AS edt, "
            f"strftime({w}, '%Y%m%d') AS cur_date")


def bucket(t: str = "ts", size: str = "10 seconds") -> str:
    return f"time_bucket(INTERVAL '{size}', {t})"


EVENTS = """
ev AS (SELECT event_id, user_id, event_type AS kind, value, epoch_us(ts) // 1000 AS ms,
              date_trunc('milliseconds', ts) AS ts,
              CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events),
good AS (SELECT *, CAST(user_id AS VARCHAR) AS mid, 'v' || user_id % 3 AS vc,
                'c' || user_id % 2 AS ch, 'a' || user_id % 5 AS ar,
                CASE WHEN k = 99 THEN '2' WHEN kind IN ('signup', 'view') THEN '1' ELSE '0' END AS is_new,
                CASE kind WHEN 'click' THEN 'home' WHEN 'view' THEN 'good_detail'
                          WHEN 'purchase' THEN 'payment' ELSE kind END AS page_id,
                CASE kind WHEN 'view' THEN 'search' WHEN 'purchase' THEN 'login'
                          WHEN 'signup' THEN NULL ELSE 'home' END AS last_page_id,
                NOT (kind = 'error' AND k < 20) AS has_page,
                (kind = 'signup' AND value < 10) AS has_start,
                CASE WHEN kind = 'view' AND k > 10 THEN 'Red shoe ' || k END AS item
         FROM ev WHERE k NOT IN (13, 55, 77)),
logs AS (SELECT * FROM good WHERE has_page OR has_start),
pages AS (SELECT * FROM good WHERE has_page AND NOT has_start)"""

FIXED = EVENTS + """,
first_day AS (SELECT *, first_value(CASE WHEN is_new = '1' THEN CAST(ts AS DATE)
                                         WHEN is_new = '0' THEN CAST(ts AS DATE) - 1 END IGNORE NULLS)
                OVER (PARTITION BY mid ORDER BY ts, event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM logs),
fixed AS (SELECT *, CASE WHEN is_new = '1' AND s <> CAST(ts AS DATE) THEN '0' ELSE is_new END
                    AS is_new_fixed FROM first_day)"""


def money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(16,2)) AS VARCHAR)"


def moment(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def seconds(c: str) -> str:
    return f"CAST(epoch({c}) AS BIGINT)"


LINES = f"""
lines AS (SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
                 CAST(l_partkey AS VARCHAR) AS sku_id, 'sku-' || l_partkey AS sku_name,
                 {money('l_extendedprice')} AS order_price,
                 CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS sku_num,
                 {moment('l_shipdate')} AS create_time, {money('l_extendedprice')} AS split_total_amount,
                 {money('l_discount')} AS split_activity_amount, {money('l_tax')} AS split_coupon_amount,
                 {seconds('l_shipdate')} AS ts, l_shipdate AS row_time,
                 100000000000000000 - ((CAST(l_partkey AS BIGINT) * 10000 + l_suppkey) * 10000 + CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * 100 AS BIGINT) % 10000) AS pos, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                 l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem)"""

#: the fact topic without its deletions
DETAILS = LINES + """,
details AS (SELECT id, order_id, sku_id, 'u' || l_suppkey AS user_id,
                   CASE WHEN l_discount >= 0.05 THEN 'a' || l_linenumber END AS activity_id,
                   CAST(NULL AS VARCHAR) AS activity_rule_id,
                   CASE WHEN l_tax >= 0.06 THEN 'c' || l_suppkey END AS coupon_id,
                   CAST(l_suppkey % 25 AS VARCHAR) AS province_id, sku_name, order_price, sku_num,
                   create_time, split_total_amount, split_activity_amount, split_coupon_amount, ts,
                   row_time, pos
            FROM lines WHERE NOT (l_tax = 0.08 AND l_returnflag = 'N'))"""

ORDERS = f"""
ord AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
               CAST(o_custkey % 25 AS VARCHAR) AS province_id, {seconds('o_orderdate')} AS ts,
               o_orderdate AS row_time, o_orderstatus, o_orderpriority, o_totalprice,
               CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'P' THEN '1005' ELSE '1006' END AS status,
               o_orderpriority <> '5-LOW' AS status_changed FROM orders)"""

PAYMENTS = ORDERS + f""",
pay AS (SELECT id AS order_id, user_id, '110' || substr(o_orderpriority, 1, 1) AS payment_type_code,
               {moment('row_time')} AS payment_time, {money('o_totalprice')} AS total_amount, ts, row_time
        FROM ord WHERE o_orderstatus <> 'O' AND o_orderpriority <> '3-MEDIUM')"""

DIC = "dic AS (SELECT '110' || r_regionkey AS rowkey, r_name AS dic_name FROM region)"

CONFIG = """
cfg_raw AS (SELECT (1704067200 + c_custkey) * 1000 + 500 AS ts_ms, c_mktsegment AS seg, c_nationkey AS n, c_acctbal,
              CASE c_mktsegment WHEN 'MACHINERY' THEN 'c' WHEN 'BUILDING' THEN 'r'
                   WHEN 'HOUSEHOLD' THEN 'u' WHEN 'FURNITURE' THEN 'c' ELSE 'd' END AS op,
              'table_' || c_nationkey AS after_table, 'sink_' || c_nationkey AS sink_table,
              'table_' || CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 2000
                               THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS before_table,
              CASE WHEN c_acctbal < 5000 THEN 'insert' ELSE 'update' END AS source_type,
              CASE c_mktsegment WHEN 'MACHINERY' THEN 'id,status' WHEN 'BUILDING' THEN 'id,user_id'
                   WHEN 'HOUSEHOLD' THEN 'status,total,nothing' ELSE 'id,user_id,total' END AS sink_columns
            FROM customer),
steps AS (SELECT op, ts_ms, CASE WHEN op = 'd' THEN before_table ELSE after_table END AS source_table,
                 source_type, sink_table, sink_columns FROM cfg_raw
          UNION ALL
          SELECT 'd', ts_ms, before_table, source_type, sink_table, sink_columns FROM cfg_raw
          WHERE op = 'u' AND before_table <> after_table)"""


def current(key: str) -> str:
    return f"""
cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}
          ORDER BY ts_ms DESC, (op <> 'd') DESC, op DESC, sink_columns DESC) AS rn FROM steps)
        WHERE rn = 1 AND op <> 'd')"""


def in_force(**key: str) -> str:
    """The changes with the config in force at their time; ``key`` maps config to change columns."""
    names = ", ".join(key)
    match = " AND ".join(f'chg."{c}" = s.{k}' for k, c in key.items())
    return f"""
inf AS (SELECT chg.*, s.sink_table, s.sink_columns
        FROM chg ASOF JOIN (SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY {names}, ts_ms ORDER BY op <> 'd' DESC) = 1) s
        ON {match} AND chg.ts * 1000 >= s.ts_ms WHERE s.op <> 'd')"""


ROUTED = f"""
chg AS (SELECT 'table_' || o_custkey % 30 AS "table",
               CASE o_orderstatus WHEN 'F' THEN 'insert' WHEN 'O' THEN 'update' ELSE 'delete' END AS type,
               1704067200 + o_orderkey // 8 AS ts, (o_orderkey // 8) * 1000000000000 - o_orderkey AS place, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS status,
               {money('o_totalprice')} AS total FROM orders)"""


def kept(field: str, columns: str = "sink_columns") -> str:
    return f"CASE WHEN list_contains(string_split({columns}, ','), '{field}') THEN {field} END AS {field}"
