"""The warehouse jobs from raw text to table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse import schemas as S
from tradepulse.catalog import aggregates, etl, feeds, joining, sources, sql
from tradepulse.catalog.registry import query
from tradepulse.operators import logsplit, parse
from tradepulse.plans import base, trade
from tradepulse.plans import windows as tables
from tradepulse.session import scratch_dir


DIM_SYNC = f"""
WITH {sql.ROUTED}, {sql.CONFIG}, {sql.in_force(source_table='table')},
anew AS (SELECT sink_table, max(ts_ms) AS reset_at FROM steps WHERE op IN ('d', 'u') GROUP BY 1),
r AS (SELECT place AS ts, type, user_id AS row_key, sink_table, {sql.kept('id')}, {sql.kept('user_id')},
             {sql.kept('status')}, {sql.kept('total')}
      FROM inf LEFT JOIN anew USING (sink_table) WHERE reset_at IS NULL OR inf.ts * 1000 >= reset_at),
e AS (SELECT *, max(CASE WHEN type = 'delete' THEN ts END) OVER (PARTITION BY sink_table, row_key) AS gone FROM r),
m AS (SELECT sink_table, row_key, max_by(id, ts) FILTER (id IS NOT NULL) AS id,
             max_by(user_id, ts) FILTER (user_id IS NOT NULL) AS user_id,
             max_by(status, ts) FILTER (status IS NOT NULL) AS status,
             max_by(total, ts) FILTER (total IS NOT NULL) AS total
      FROM e WHERE gone IS NULL OR ts > gone GROUP BY 1, 2)
SELECT * FROM m WHERE coalesce(id, user_id, status, total) IS NOT NULL"""


@query("pipe_dim_sync", DIM_SYNC)
def dim_sync(spark, sf):
    """The config drops tables, or creates them anew, while changes come."""
    rows = base.dim_sync(feeds.changes(feeds.routed_changes(spark, sf)), feeds.config_changes(spark, sf),
                         feeds.DATABASE)
    return rows.select("sink_table", "row_key", *[F.col("data")[c].alias(c)
                                                  for c in ("id", "user_id", "status", "total")])


LOG_TOPICS = f"""
WITH {sql.FIXED},
p AS (SELECT * FROM fixed WHERE has_page AND NOT has_start)
SELECT 'err' AS topic, CAST(NULL AS VARCHAR) AS mid, CAST(NULL AS VARCHAR) AS is_new, CAST(NULL AS VARCHAR) AS page_id,
       CAST(NULL AS BIGINT) AS ts, CAST(k AS VARCHAR) AS detail FROM fixed WHERE kind = 'error'
UNION ALL SELECT 'start', mid, is_new_fixed, CASE WHEN has_page THEN page_id END, ms, CAST(k AS VARCHAR) FROM fixed WHERE has_start
UNION ALL SELECT 'display', mid, is_new_fixed, page_id, ms, 'sku' || (k + n) FROM p, (VALUES (1), (2)) AS v(n) WHERE kind = 'view'
UNION ALL SELECT 'action', mid, is_new_fixed, page_id, ms, 'sku' || k FROM p WHERE kind = 'click'
UNION ALL SELECT 'page', mid, is_new_fixed, page_id, ms, CAST(k AS VARCHAR) FROM p"""

PAYLOAD = T.StructType([T.StructField("common", S.STR_MAP), T.StructField("page", S.STR_MAP), T.StructField("start", S.STR_MAP),
                        T.StructField("ts", T.LongType()), T.StructField("item", T.StringType()), T.StructField("error_code", T.StringType())])


def topic_rows(topics):
    """Every payload of the five topics: whose it is, and the field that tells most of its kind."""
    texts = [rows.select("value", F.lit(name).alias("topic")) for name, rows in topics.items()]
    parsed = parse.parse_json(reduce(DataFrame.unionByName, texts), PAYLOAD, keep=["topic"])
    detail = F.coalesce("error_code", F.col("start")["loading_time"], "item", F.col("page")["during_time"])
    return parsed.select("topic", F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"),
                         F.col("page")["page_id"].alias("page_id"), "ts", detail.alias("detail"))


@query("pipe_log_split", LOG_TOPICS)
def log_split(spark, sf):
    topics = base.log_split(feeds.log_texts(feeds.table(spark, sf, "events")), scratch_dir(spark, "logs"))
    return topic_rows({name: logsplit.as_json(name, rows) for name, rows in topics.items()})


FACT_ROUTER = f"""
WITH {sql.ROUTED}, {sql.CONFIG}, {sql.in_force(source_table='table', source_type='type')}
SELECT sink_table, {sql.kept('id')}, {sql.kept('user_id')}, {sql.kept('status')}, {sql.kept('total')} FROM inf"""


@query("pipe_fact_router", FACT_ROUTER)
def fact_router(spark, sf):
    routed = base.fact_router(feeds.changes(feeds.routed_changes(spark, sf)),
                              feeds.config_changes(spark, sf, fact=True))
    return parse.parse_json(routed, S.strings("id", "user_id", "status", "total"), keep=["sink_table"])


@query("pipe_fact_router_snapshot", f"""
WITH {sql.ROUTED}, {sql.CONFIG}, {sources.until_half_way('source_table, source_type')},
later AS (SELECT op, ts_ms, source_table, source_type, sink_table, sink_columns FROM steps WHERE ts_ms > {sources.HALF_WAY}
          UNION ALL SELECT 'r', -1, source_table, source_type, sink_table, sink_columns FROM cur),
{sql.in_force(source_table='table', source_type='type').replace('FROM steps', 'FROM later')}
SELECT sink_table, {sql.kept('id')}, {sql.kept('user_id')}, {sql.kept('status')}, {sql.kept('total')} FROM inf""")
def fact_router_snapshot(spark, sf):
    """The config table was read half way through its captured changes; it tells what held before."""
    snapshot = sources.half_snapshot(spark, sf, ["source_table", "source_type"], fact=True)
    routed = base.fact_router(feeds.changes(feeds.routed_changes(spark, sf)), feeds.config_changes(spark, sf, fact=True),
                              snapshot=snapshot, position=sources.half_way(spark, sf))
    return parse.parse_json(routed, S.strings("id", "user_id", "status", "total"), keep=["sink_table"])


@query("pipe_cart_add", f"WITH {sql.LINES}, {etl.CART_SQL} SELECT * FROM cart_add")
def cart_add(spark, sf):
    return trade.cart_add(feeds.changes(feeds.carts(spark, sf), feeds.orders(spark, sf)))


COMMENT = f"""
WITH {joining.COMMENTS}, {sql.DIC}
SELECT id, user_id, nick_name, sku_id, spu_id, order_id, appraise_code, dic_name AS appraise_name, comment_txt,
       create_time, operate_time FROM com JOIN dic ON appraise_code = rowkey"""


@query("pipe_comment", COMMENT)
def comment_info(spark, sf):
    return trade.comment_info(feeds.changes(feeds.comments(spark, sf)), feeds.dictionary(spark, sf))


@query("pipe_order_detail", joining.WIDE)
def order_detail(spark, sf):
    return trade.order_detail(joining.wide_changes(spark, sf))


@query("pipe_order_cancel", joining.CANCEL)
def order_cancel(spark, sf):
    return trade.order_cancel(feeds.details(spark, sf),
                              feeds.changes(feeds.orders(spark, sf), feeds.order_updates(spark, sf)))


DAY = 24 * 3600


PAID = f"""
WITH {sql.DETAILS}, {sql.PAYMENTS}, {sql.DIC},
j AS (SELECT d.pos, d.id, d.order_id, pay.user_id, payment_type_code, dic_name AS payment_type_name, payment_time, sku_id, province_id,
             activity_id, activity_rule_id, coupon_id, sku_name, order_price, sku_num, split_total_amount,
             split_activity_amount, split_coupon_amount, pay.ts
      FROM details d JOIN pay ON d.order_id = pay.order_id
       AND pay.row_time BETWEEN d.row_time - INTERVAL 30 DAY AND d.row_time + INTERVAL 60 DAY
      LEFT JOIN dic ON payment_type_code = rowkey),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, pos DESC) AS rn FROM j)
SELECT * EXCLUDE (rn, pos) FROM r WHERE rn = 1"""


@query("pipe_pay_success", PAID)
def pay_success(spark, sf):
    """An order is paid once, so of several versions of its lines the one that arrived last shows."""
    return trade.pay_success_latest(feeds.details(spark, sf, timed=True),
                                    feeds.changes(feeds.payments(spark, sf)), feeds.dictionary(spark, sf),
                                    before=30 * DAY, after=60 * DAY)


@query("pipe_order_refund", f"""
WITH {sql.LINES}, {sql.ORDERS}, {sql.DIC}, {joining.ORDER_REFUND} SELECT * FROM order_refund""")
def order_refund(spark, sf):
    return trade.order_refund(joining.refund_changes(spark, sf), feeds.dictionary(spark, sf))


@query("pipe_refund_pay", f"""
WITH {sql.LINES}, {sql.ORDERS}, {sql.DIC}, {joining.REFUND}
SELECT id, user_id, order_id, sku_id, province_id, payment_type, dic_name AS payment_type_name, callback_time,
       total_amount, refund_num, ts FROM refund_pay JOIN dic ON payment_type = rowkey""")
def refund_pay(spark, sf):
    return trade.refund_pay_success(joining.refund_changes(spark, sf), feeds.dictionary(spark, sf))


def split_pages(spark, sf):
    """The page topic as the log split leaves it, ``is_new`` repaired."""
    return logsplit.pages(etl.split_logs(spark, sf))


@query("pipe_traffic", aggregates.traffic_sql("10 seconds").replace(sql.EVENTS, sql.FIXED).replace(
    "FROM pages)", "FROM fixed WHERE has_page AND NOT has_start)").replace(
    "ar, is_new, sum(uv)", "ar, is_new_fixed AS is_new, sum(uv)"))
def traffic(spark, sf):
    return tables.traffic(split_pages(spark, sf))


@query("pipe_home_detail", aggregates.home_sql("10 seconds"))
def home_detail(spark, sf):
    return tables.home_detail(feeds.pages(feeds.table(spark, sf, "events")))


@query("pipe_keyword", aggregates.KEYWORDS)
def keyword(spark, sf):
    from tradepulse.sources import topics

    return tables.keywords(topics.page_log(feeds.document_page_texts(feeds.table(spark, sf, "documents"))))


@query("pipe_login", aggregates.login_sql("10 seconds"))
def login(spark, sf):
    return tables.logins(feeds.pages(feeds.table(spark, sf, "events")))


@query("pipe_register", aggregates.register_sql("10 seconds"))
def register(spark, sf):
    return tables.registers(aggregates.register_rows(spark, sf))


CART_ADD_UU = f"""
WITH {sql.LINES}, {etl.CART_SQL},
t AS (SELECT user_id, make_timestamp(ts * 1000000) AS tm FROM cart_add),
m AS (SELECT tm, row_number() OVER (PARTITION BY user_id, CAST(tm AS DATE) ORDER BY tm) AS rn FROM t),
g AS (SELECT {sql.bucket('tm')} AS w, count(CASE WHEN rn = 1 THEN 1 END) AS cart_add_uu_ct FROM m GROUP BY 1)
SELECT {sql.win('w')}, cart_add_uu_ct FROM g"""


@query("pipe_cart_uu", CART_ADD_UU)
def cart_uu(spark, sf):
    return tables.cart_users(trade.cart_add(feeds.changes(feeds.carts(spark, sf))))


@query("pipe_sku_order", f"""
WITH {sql.DETAILS}, {aggregates.DELTAS}, {joining.DIMS},
g AS (SELECT {sql.bucket('row_time')} AS w, sku_id, {aggregates.SKU_SUMS} FROM sku_delta GROUP BY 1, 2)
SELECT {sql.win('w')}, g.sku_id, original_amount, activity_reduce_amount, coupon_reduce_amount, order_amount,
       {joining.chained()} FROM g LEFT JOIN chain ON g.sku_id = chain.sku_id""")
def sku_order(spark, sf):
    return tables.sku_orders(feeds.details(spark, sf), feeds.articles(spark, sf))


@query("pipe_province_order", f"""
WITH {sql.DETAILS}, {aggregates.DELTAS},
g AS (SELECT {sql.bucket('row_time')} AS w, province_id, CAST(count(DISTINCT order_id) AS BIGINT) AS order_count,
             CAST(sum(tot) AS DOUBLE) AS order_amount FROM prov_delta GROUP BY 1, 2)
SELECT {sql.win('w')}, province_id, n_name AS province_name, order_count, order_amount
FROM g LEFT JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR) AND n_nationkey <> 4""")
def province_order(spark, sf):
    return tables.province_orders(feeds.details(spark, sf), feeds.provinces(spark, sf))
