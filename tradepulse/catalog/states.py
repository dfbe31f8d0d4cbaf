"""Keyed state in its closed forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepulse.catalog import feeds, sql
from tradepulse.catalog.aggregates import DELTAS
from tradepulse.catalog.registry import query
from tradepulse.operators import changelog, parse, visitors
from tradepulse.plans import windows as tables
from tradepulse.session import landed


def views(spark, sf):
    pages = feeds.pages(feeds.table(spark, sf, "events"))
    flat = visitors.page_columns(pages)
    return flat


@query("fix_is_new", f"""
WITH {sql.FIXED} SELECT event_id AS "offset", mid, is_new_fixed AS is_new, ms AS ts FROM fixed""")
def fix_is_new(spark, sf):
    fixed = visitors.repair_new_flag(feeds.landed_logs(spark, sf))
    return fixed.select("offset", F.col("common")["mid"].alias("mid"),
                        F.col("common")["is_new"].alias("is_new"), "ts")


@query("uv_daily", f"""
WITH {sql.EVENTS}, p AS (SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY mid ORDER BY ts, event_id) AS last FROM pages)
SELECT mid, ms AS ts, vc, is_new, CAST(CASE WHEN last IS NULL OR last <> CAST(ts AS DATE) THEN 1 ELSE 0 END AS BIGINT) AS uv_ct,
       CAST(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS sv_ct, CAST(1 AS BIGINT) AS pv_ct, k AS dur_sum
FROM p""")
def uv_daily(spark, sf):
    """The rows are read twice, for the first of each day and to be marked; they are parsed once."""
    rows = landed(visitors.visit_metrics(views(spark, sf)), "views")
    return visitors.flag_daily_first(rows, ["mid"], ["ts", "page_id"], "uv_ct").select(
        "mid", "ts", "vc", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum")


@query("uv_two_page", f"""
WITH {sql.EVENTS}, p AS (SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY mid, page_id ORDER BY ts, event_id) AS last
      FROM pages WHERE page_id IN ('home', 'good_detail'))
SELECT mid, ms AS ts, CAST(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END AS BIGINT) AS home_uv_ct,
       CAST(CASE WHEN page_id = 'home' THEN 0 ELSE 1 END AS BIGINT) AS good_detail_uv_ct
FROM p WHERE last IS NULL OR last <> CAST(ts AS DATE)""")
def uv_two_page(spark, sf):
    pages = parse.home_and_detail(feeds.pages(feeds.table(spark, sf, "events")))
    return visitors.home_detail_uniques(visitors.page_columns(pages)).select(
        "mid", F.unix_millis("row_time").alias("ts"), "home_uv_ct", "good_detail_uv_ct")


@query("returning_users", f"""
WITH {sql.EVENTS}, p AS (SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY mid ORDER BY ts, event_id) AS last
      FROM pages WHERE last_page_id IS NULL OR last_page_id = 'login')
SELECT mid AS uid, ms AS ts, CAST(CASE WHEN ts > CAST(last AS TIMESTAMP) + INTERVAL 7 DAYS THEN 1 ELSE 0 END AS BIGINT) AS back_ct,
       CAST(1 AS BIGINT) AS uu_ct FROM p WHERE last IS NULL OR last <> CAST(ts AS DATE)""")
def returning_users(spark, sf):
    visits = visitors.page_columns(parse.login_visits(feeds.pages(feeds.table(spark, sf, "events"))))
    return visitors.returning_users(visits).select("uid", F.unix_millis("row_time").alias("ts"), "back_ct", "uu_ct")


@query("uu_cart_daily", f"""
WITH {sql.LINES}, p AS (SELECT CAST(l_suppkey AS VARCHAR) AS user_id, id, sku_id, ts * 1000 AS ts,
        row_number() OVER (PARTITION BY l_suppkey, CAST(row_time AS DATE) ORDER BY row_time, id, sku_id) AS rn
      FROM lines WHERE l_tax <> 0.08)
SELECT user_id, id, sku_id, ts, CAST(CASE WHEN rn = 1 THEN 1 ELSE 0 END AS BIGINT) AS cart_add_uu_ct FROM p""")
def uu_cart_daily(spark, sf):
    rows = landed(parse.cart_facts(feeds.cart_facts(spark, sf)).select("user_id", "id", "sku_id", "row_time"), "carts")
    return visitors.flag_daily_first(rows, ["user_id"], ["row_time", "id", "sku_id"], "cart_add_uu_ct").select(
        "user_id", "id", "sku_id", F.unix_millis("row_time").alias("ts"), "cart_add_uu_ct")


@query("delta_multi", f"""
WITH {sql.DETAILS}, {DELTAS}
SELECT id, sku_id, epoch_ms(row_time) AS ts, CAST(ori AS DOUBLE) AS original_amount,
       CAST(act AS DOUBLE) AS activity_reduce_amount, CAST(cou AS DOUBLE) AS coupon_reduce_amount,
       CAST(tot AS DOUBLE) AS order_amount FROM sku_delta""")
def delta_multi(spark, sf):
    return tables.sku_order_deltas(feeds.details(spark, sf)).select(
        "id", "sku_id", F.unix_millis("row_time").alias("ts"), "original_amount",
        "activity_reduce_amount", "coupon_reduce_amount", "order_amount")


#: How long a version of an order line is remembered here; versions of the given lines are days apart.
KEEP = "20 days"


def ttl(c: str) -> str:
    return f"{c} - coalesce(CASE WHEN row_time <= lag(row_time) OVER v + INTERVAL {KEEP} THEN lag({c}) OVER v END, 0)"


TTL = f"""
WITH {sql.DETAILS}, {DELTAS},
t AS (SELECT id, sku_id, epoch_ms(row_time) AS ts, {ttl('ori')} AS ori, {ttl('act')} AS act, {ttl('cou')} AS cou, {ttl('tot')} AS tot FROM amt
      WINDOW v AS (PARTITION BY id ORDER BY row_time, pos, ori, act, cou, tot, sku_id))
SELECT id, sku_id, ts, CAST(ori AS DOUBLE) AS original_amount, CAST(act AS DOUBLE) AS activity_reduce_amount,
       CAST(cou AS DOUBLE) AS coupon_reduce_amount, CAST(tot AS DOUBLE) AS order_amount FROM t"""


def delta_columns(deltas):
    return deltas.select("id", "sku_id", F.unix_millis("row_time").alias("ts"), "original_amount",
                         "activity_reduce_amount", "coupon_reduce_amount", "order_amount")


@query("delta_ttl", TTL)
def delta_ttl(spark, sf):
    """A version more than KEEP after the one before counts in full again."""
    return delta_columns(tables.sku_order_deltas(feeds.details(spark, sf), keep=KEEP))


@query("delta_single", f"""
WITH {sql.DETAILS}, {DELTAS}
SELECT id, order_id, province_id, epoch_ms(row_time) AS ts, CAST(tot AS DOUBLE) AS order_amount FROM prov_delta""")
def delta_single(spark, sf):
    return tables.province_order_deltas(feeds.details(spark, sf)).select(
        "id", "order_id", "province_id", F.unix_millis("row_time").alias("ts"), "order_amount")


@query("config_current", f"""
WITH {sql.CONFIG}, {sql.current('source_table')} SELECT source_table, sink_table, sink_columns, op FROM cur""")
def config_current(spark, sf):
    return changelog.current_config(feeds.config_steps(spark, sf), ["source_table"], "ts_ms").select(
        "source_table", "sink_table", "sink_columns", "op")
