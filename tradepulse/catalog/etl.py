"""Projection, filters and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.catalog import feeds, sql
from tradepulse.catalog.registry import query
from tradepulse.operators import changelog, logsplit, parse, routing, visitors
from tradepulse.plans import trade


def events(spark, sf):
    return feeds.table(spark, sf, "events")


def keys(rows, *more):
    common, page = F.col("common"), F.col("page")
    return rows.select("offset", common["mid"].alias("mid"), page["page_id"].alias("page_id"), "ts", *more)


@query("parse_quarantine", f"""
WITH {sql.EVENTS}
SELECT k IN (13, 55, 77) AS bad,
       CASE k WHEN 13 THEN substr('{{"common":{{"mid":"' || user_id || '","uid":"' || user_id || '","vc"', 1, 25)
              WHEN 55 THEN '[1, 2]' WHEN 77 THEN '' END AS text,
       CASE WHEN k NOT IN (13, 55, 77) THEN ms END AS ts FROM ev""")
def quarantine(spark, sf):
    """Each text: the parsed time of the good ones, the bad ones as they came."""
    parsed = parse.parse_with_quarantine(feeds.log_texts(events(spark, sf)), S.LOG)
    return parsed.select("bad", F.when(F.col("bad"), F.col("value")).alias("text"), F.when(~F.col("bad"), F.col("ts")).alias("ts"))


@query("etl_row_change", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'bootstrap-insert' WHEN 'FURNITURE' THEN 'insert'
            WHEN 'HOUSEHOLD' THEN 'update' ELSE 'delete' END AS type, c_custkey AS ts
FROM customer WHERE c_nationkey <> 7 AND c_mktsegment <> 'AUTOMOBILE' AND c_acctbal >= 0""")
def row_change(spark, sf):
    rows = parse.row_changes(feeds.changes(feeds.user_changes(spark, sf)), feeds.DATABASE)
    return rows.select(F.col("data")["id"].alias("id"), F.col("data")["name"].alias("name"), "type", "ts")


@query("etl_log", f"""
WITH {sql.EVENTS} SELECT event_id AS "offset", mid, CASE WHEN has_page THEN page_id END AS page_id, ms AS ts,
       has_start FROM logs""")
def etl_log(spark, sf):
    return keys(feeds.logs(events(spark, sf)), F.col("start").isNotNull().alias("has_start"))


@query("etl_page", f"""WITH {sql.EVENTS} SELECT event_id AS "offset", mid, page_id, ms AS ts FROM pages""")
def etl_page(spark, sf):
    return keys(parse.page_views(feeds.pages(events(spark, sf))))


@query("etl_home_detail", f"""
WITH {sql.EVENTS} SELECT event_id AS "offset", mid, page_id, ms AS ts FROM pages
WHERE page_id IN ('home', 'good_detail')""")
def etl_home_detail(spark, sf):
    return keys(parse.home_and_detail(feeds.pages(events(spark, sf))))


@query("etl_login", f"""
WITH {sql.EVENTS} SELECT event_id AS "offset", mid, page_id, ms AS ts, last_page_id FROM pages
WHERE last_page_id IS NULL OR last_page_id = 'login'""")
def etl_login(spark, sf):
    return keys(parse.login_visits(feeds.pages(events(spark, sf))),
                F.col("page")["last_page_id"].alias("last_page_id"))


@query("etl_register", """
SELECT CAST(user_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time,
       epoch_ms(date_trunc('second', ts)) AS row_ms, CAST(1 AS BIGINT) AS register_ct
FROM events WHERE event_type = 'signup' AND CAST(regexp_extract(props, '[0-9]+') AS BIGINT) <> 13""")
def etl_register(spark, sf):
    rows = parse.parse_json(feeds.register_texts(events(spark, sf)), S.strings("create_time", "id"))
    return parse.registrations(rows).select("id", "create_time", F.unix_millis("row_time").alias("row_ms"),
                                            "register_ct")


@query("etl_cart", f"""
WITH {sql.LINES} SELECT id, CAST(l_suppkey AS VARCHAR) AS user_id, ts * 1000 AS row_ms FROM lines WHERE l_tax <> 0.08""")
def etl_cart(spark, sf):
    return parse.cart_facts(feeds.cart_facts(spark, sf)).select(
        "id", "user_id", F.unix_millis("row_time").alias("row_ms"))


@query("etl_sku_order", f"WITH {sql.DETAILS} SELECT id, sku_id, split_total_amount, ts * 1000 AS row_ms FROM details")
def etl_sku_order(spark, sf):
    return parse.sku_order_facts(feeds.details(spark, sf)).select(
        "id", "sku_id", "split_total_amount", F.unix_millis("row_time").alias("row_ms"))


@query("etl_province_order", f"""
WITH {sql.DETAILS} SELECT id, order_id, province_id, ts * 1000 AS row_ms FROM details""")
def etl_province_order(spark, sf):
    return parse.province_order_facts(feeds.details(spark, sf)).select(
        "id", "order_id", "province_id", F.unix_millis("row_time").alias("row_ms"))


@query("cdc_insert_extract", f"""
WITH {sql.ORDERS} SELECT id, user_id, province_id, ts FROM ord""")
def insert_extract(spark, sf):
    return trade.new_orders(feeds.changes(feeds.orders(spark, sf), feeds.order_updates(spark, sf)))


@query("cdc_transition", f"""
WITH {sql.ORDERS} SELECT id, province_id, ts + 60 AS ts FROM ord WHERE status = '1005' AND status_changed""")
def transition(spark, sf):
    changes = feeds.changes(feeds.orders(spark, sf), feeds.order_updates(spark, sf))
    return changelog.transition(changes, "order_info", "order_status", trade.REFUNDING,
                                ["id", "province_id"], keep=["ts"])


@query("cdc_state_filter", f"""
WITH {sql.ORDERS} SELECT id AS order_id, user_id, province_id FROM ord WHERE status = '1003'""")
def state_filter(spark, sf):
    return trade.cancelled_orders(feeds.changes(feeds.orders(spark, sf), feeds.order_updates(spark, sf)))


CART_SQL = f"""
cart AS (SELECT *, l_linestatus = 'O' AS inserted,
                CASE WHEN l_tax = 0.08 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS new_num,
                CASE WHEN l_returnflag <> 'N' THEN CAST(l_linenumber * 7 AS BIGINT) END AS old_num FROM lines),
cart_add AS (SELECT id, CAST(l_suppkey AS VARCHAR) AS user_id, sku_id, order_price AS cart_price,
             CASE WHEN inserted AND l_tax = 0.08 THEN 'x' WHEN inserted THEN CAST(new_num AS VARCHAR)
                  ELSE CAST(new_num - old_num AS VARCHAR) END AS sku_num,
             sku_name, '1' AS is_checked, create_time, CAST(NULL AS VARCHAR) AS operate_time,
             CAST(NULL AS VARCHAR) AS is_ordered, CAST(NULL AS VARCHAR) AS order_time, ts
             FROM cart WHERE inserted OR new_num > old_num)"""


@query("cdc_increment", f"WITH {sql.LINES}, {CART_SQL} SELECT * FROM cart_add")
def increment(spark, sf):
    return trade.cart_add(feeds.changes(feeds.carts(spark, sf)))


@query("config_project", f"""
WITH {sql.ROUTED}, {sql.CONFIG}, {sql.current('source_table')}
SELECT chg.ts, "table", sink_table, {sql.kept('id')}, {sql.kept('user_id')}, {sql.kept('status')}, {sql.kept('total')}
FROM chg JOIN cur ON chg."table" = cur.source_table""")
def config_project(spark, sf):
    config = changelog.current_config(feeds.config_steps(spark, sf), ["source_table"], "ts_ms")
    routed = routing.project_fields(routing.by_table(feeds.changes(feeds.routed_changes(spark, sf)), config))
    data = F.col("data")
    return routed.select("ts", "table", F.col("cfg_sink_table").alias("sink_table"),
                         *[data[c].alias(c) for c in ("id", "user_id", "status", "total")])


@query("keyword_filter", f"""
WITH {sql.EVENTS} SELECT item AS keywords, ms AS row_ms FROM pages WHERE kind = 'view' AND item IS NOT NULL""")
def keyword_filter(spark, sf):
    rows = feeds.pages(events(spark, sf)).withColumn("row_time", F.timestamp_millis("ts"))
    return parse.search_keywords(rows).select("keywords", F.unix_millis("row_time").alias("row_ms"))


@query("config_decode", f"""
WITH {sql.CONFIG}
SELECT op, ts_ms, CASE WHEN op = 'd' THEN before_table ELSE after_table END AS source_table, sink_table,
       sink_columns FROM cfg_raw""")
def config_decode(spark, sf):
    return changelog.decode_config(feeds.config_changes(spark, sf)).select(
        "op", "ts_ms", "source_table", "sink_table", "sink_columns")


# -- the five outputs of the log, after the repair of is_new ---------------------------

def split_logs(spark, sf):
    return visitors.repair_new_flag(feeds.landed_logs(spark, sf))


@query("log_split_err", f"""
WITH {sql.EVENTS} SELECT CAST(k AS VARCHAR) AS error_code, 'failed' AS msg FROM logs WHERE kind = 'error'""")
def split_err(spark, sf):
    err = F.col("err")
    return logsplit.errors(feeds.logs(events(spark, sf))).select(
        err["error_code"].alias("error_code"), err["msg"].alias("msg"))


@query("log_split_start", f"""
WITH {sql.FIXED} SELECT mid, is_new_fixed AS is_new, 'icon' AS entry, page_id, ms AS ts FROM fixed WHERE has_start""")
def split_start(spark, sf):
    return logsplit.starts(split_logs(spark, sf)).select(
        F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"),
        F.col("start")["entry"].alias("entry"), F.col("page")["page_id"].alias("page_id"), "ts")


@query("log_split_display", f"""
WITH {sql.FIXED}
SELECT 'sku' || (k + pos) AS item, CAST(pos AS VARCHAR) AS pos, mid, is_new_fixed AS is_new, page_id, ms AS ts
FROM fixed, (VALUES (1), (2)) AS p(pos) WHERE kind = 'view' AND has_page AND NOT has_start""")
def split_display(spark, sf):
    item = F.col("display")
    return logsplit.displays(split_logs(spark, sf)).select(
        item["item"].alias("item"), item["pos"].alias("pos"), F.col("common")["mid"].alias("mid"),
        F.col("common")["is_new"].alias("is_new"), F.col("page")["page_id"].alias("page_id"), "ts")


@query("log_split_action", f"""
WITH {sql.FIXED}
SELECT 'cart_add' AS action_id, 'sku' || k AS item, mid, is_new_fixed AS is_new, page_id, ms AS ts
FROM fixed WHERE kind = 'click' AND has_page AND NOT has_start""")
def split_action(spark, sf):
    item = F.col("action")
    return logsplit.actions(split_logs(spark, sf)).select(
        item["action_id"].alias("action_id"), item["item"].alias("item"),
        F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"),
        F.col("page")["page_id"].alias("page_id"), "ts")


@query("log_split_page", f"""
WITH {sql.FIXED}
SELECT mid, is_new_fixed AS is_new, page_id, last_page_id,
       CASE WHEN kind = 'error' THEN CAST(k AS VARCHAR) END AS error_code, ms AS ts
FROM fixed WHERE has_page AND NOT has_start""")
def split_page(spark, sf):
    return logsplit.pages(split_logs(spark, sf)).select(
        F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"),
        F.col("page")["page_id"].alias("page_id"), F.col("page")["last_page_id"].alias("last_page_id"),
        F.col("err")["error_code"].alias("error_code"), "ts")
