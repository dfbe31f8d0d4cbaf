"""The live jobs: each works off its feed as a ``Job``, then its sink is read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.catalog import aggregates, etl, feeds, jobs, joining, sql, streams
from tradepulse.catalog.registry import query
from tradepulse.operators import parse
from tradepulse.plans import live
from tradepulse.session import PACKED, scratch_dir
from tradepulse.sinks import keyed
from tradepulse.sources.topics import Topic
from tradepulse.streaming.views import OrderDetails

#: The given orders, lines and refunds are months apart; so far apart may the parts of a fact come here.
DAYS = 100


def land(topic: Topic, *texts: DataFrame) -> Topic:
    """Append texts to a topic of parquet files."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), texts)
    rows.write.mode("append").option("compression", PACKED).parquet(topic.path)
    return topic


def shop_of(spark, sf, label: str, **more) -> live.Shop:
    """A shop with empty topics in a folder of its own."""
    root = scratch_dir(spark, label)
    return live.Shop(
        root=root, database=feeds.DATABASE,
        log=Topic("log", f"{root}/in/log", file_format="parquet", columns="value string, offset bigint"),
        db=Topic("db", f"{root}/in/db", file_format="parquet", columns="value string, offset bigint"),
        dim_config=lambda: feeds.config_changes(spark, sf), fact_config=lambda: feeds.config_changes(spark, sf, fact=True),
        dictionary=lambda: feeds.dictionary(spark, sf), provinces=lambda: feeds.provinces(spark, sf),
        articles=lambda: feeds.articles(spark, sf), together=DAYS * 24 * 3600, paid=(30 * jobs.DAY, 60 * jobs.DAY), **more)


def details_topic(spark, sf, shop: live.Shop) -> live.Shop:
    """The same shop with the order line topic of the given table."""
    topic = Topic("order_detail", shop.path("in", "order_detail"), file_format="parquet", columns=live.KEYED)
    land(topic, feeds.detail_texts(feeds.table(spark, sf, "lineitem")))
    return live.Shop(**{**shop.__dict__, "facts": {"order_detail": topic}})


def run(spark, shop: live.Shop, name: str) -> None:
    live.JOBS[name](spark, shop).run(spark)


def appended(spark, shop: live.Shop, name: str, columns) -> DataFrame:
    return parse.parse_json(spark.read.text(shop.path("facts", name)), S.fact_schema(columns))


@query("stream_order_detail", joining.WIDE)
def order_detail(spark, sf):
    """Lines come first, their activities and coupons in a later batch; the table is corrected."""
    shop, by_year = shop_of(spark, sf, "order-detail"), feeds.years
    land(shop.db, feeds.lines(spark, sf, by_year), feeds.orders(spark, sf), feeds.coupons(spark, sf, by_year))
    run(spark, shop, "order_detail")
    land(shop.db, feeds.activities(spark, sf, by_year), feeds.order_updates(spark, sf))
    run(spark, shop, "order_detail")
    return OrderDetails(spark, shop.path("order_detail")).read()


@query("stream_order_cancel", f"""
WITH {sql.DETAILS}, {sql.ORDERS}
SELECT d.id, order_id, sku_id, ord.user_id, activity_id, activity_rule_id, coupon_id, ord.province_id, sku_name,
       order_price, sku_num, create_time, split_total_amount, split_activity_amount, split_coupon_amount, d.ts
FROM details d JOIN ord ON d.order_id = ord.id AND abs(d.ts - ord.ts - 60) <= {DAYS * 24 * 3600} WHERE ord.status = '1003'""")
def order_cancel(spark, sf):
    shop = details_topic(spark, sf, shop_of(spark, sf, "order-cancel"))
    land(shop.db, feeds.orders(spark, sf), feeds.order_updates(spark, sf))
    run(spark, shop, "order_cancel")
    return appended(spark, shop, "order_cancel", S.ORDER_DETAIL)


@query("stream_pay_success", jobs.PAID)
def pay_success(spark, sf):
    shop = details_topic(spark, sf, shop_of(spark, sf, "pay-success"))
    land(shop.db, feeds.payments(spark, sf))
    run(spark, shop, "pay_success")
    return live.paid_table(spark, shop).read().select(*S.PAYMENT_SUCCESS)


@query("stream_order_refund", f"""
WITH {sql.LINES}, {sql.ORDERS}, {sql.DIC}, {joining.ORDER_REFUND.replace(
    "refunding AS (SELECT id AS order_id, province_id FROM", "refunding AS (SELECT id AS order_id, province_id, ts + 60 AS at FROM").replace(
    "ON asked.order_id = refunding.order_id", f"ON asked.order_id = refunding.order_id AND abs(asked.ts - refunding.at) <= {DAYS * 24 * 3600}")}
SELECT * FROM order_refund""")
def order_refund(spark, sf):
    shop = shop_of(spark, sf, "order-refund")
    land(shop.db, feeds.refunds(spark, sf), feeds.order_updates(spark, sf))
    run(spark, shop, "order_refund")
    return appended(spark, shop, "order_refund", S.ORDER_REFUND)


@query("stream_refund_pay", f"""
WITH {sql.LINES}, {sql.ORDERS}, {sql.DIC}, {joining.REFUND.replace(
    "sku_num AS refund_num FROM lines", "sku_num AS refund_num, ts + 60 AS at FROM lines").replace(
    "refunded AS (SELECT id AS order_id, user_id, province_id FROM", "refunded AS (SELECT id AS order_id, user_id, province_id, ts + 60 AS at FROM").replace(
    "AND paid.sku_id = done.sku_id", f"AND paid.sku_id = done.sku_id AND abs(paid.ts - done.at) <= {DAYS * 24 * 3600}").replace(
    "ON paid.order_id = refunded.order_id", f"ON paid.order_id = refunded.order_id AND abs(paid.ts - refunded.at) <= {DAYS * 24 * 3600}")}
SELECT id, user_id, order_id, sku_id, province_id, payment_type, dic_name AS payment_type_name, callback_time,
       total_amount, refund_num, ts FROM refund_pay JOIN dic ON payment_type = rowkey""")
def refund_pay(spark, sf):
    shop = shop_of(spark, sf, "refund-pay")
    land(shop.db, feeds.refunds(spark, sf), feeds.refund_payments(spark, sf), feeds.order_updates(spark, sf))
    run(spark, shop, "refund_pay")
    return appended(spark, shop, "refund_pay", S.REFUND_PAY)


@query("stream_cart_add", f"WITH {sql.LINES}, {etl.CART_SQL} SELECT * FROM cart_add")
def cart_add(spark, sf):
    shop = shop_of(spark, sf, "cart-add")
    land(shop.db, feeds.carts(spark, sf), feeds.orders(spark, sf))
    run(spark, shop, "cart_add")
    return appended(spark, shop, "cart_add", S.CART_ADD)


@query("stream_comment", jobs.COMMENT)
def comment_info(spark, sf):
    shop = shop_of(spark, sf, "comment")
    land(shop.db, feeds.comments(spark, sf))
    run(spark, shop, "comment_info")
    return appended(spark, shop, "comment_info", S.COMMENT_INFO)


@query("stream_dim_sync", jobs.DIM_SYNC)
def dim_sync(spark, sf):
    """Two batches of changes; the config drops tables and creates them anew meanwhile."""
    shop, changes = shop_of(spark, sf, "dim-sync"), feeds.routed_changes(spark, sf)
    for half in (0, 1):
        land(shop.db, changes.where(F.col("offset") % 2 == half))
        run(spark, shop, "dim_sync")
    rows = keyed.DimTables(spark, shop.path("dims")).read()
    return rows.select("sink_table", "row_key", *[F.col("data")[c].alias(c) for c in ("id", "user_id", "status", "total")])


@query("stream_fact_router", jobs.FACT_ROUTER)
def fact_router(spark, sf):
    shop = shop_of(spark, sf, "fact-router")
    land(shop.db, feeds.routed_changes(spark, sf))
    run(spark, shop, "fact_router")
    written = spark.read.schema("value string, sink_table string").text(shop.path("routed"))
    return parse.parse_json(written, S.strings("id", "user_id", "status", "total"), keep=["sink_table"])


@query("live_log_traffic", streams.closed(aggregates.traffic_sql("1 hour").replace(sql.EVENTS, sql.FIXED).replace(
    "FROM pages)", "FROM fixed WHERE has_page AND NOT has_start)").replace(
    "ar, is_new, sum(uv)", "ar, is_new_fixed AS is_new, sum(uv)"), "3 seconds", size="1 hour"))
def log_traffic(spark, sf):
    """Two jobs in a row: the log split commits its topics, the traffic window follows the commits."""
    shop = shop_of(spark, sf, "log-traffic", size="1 hour")
    land(shop.log, feeds.log_texts(feeds.table(spark, sf, "events")))
    run(spark, shop, "log_split")
    run(spark, shop, "traffic")
    schema = "stt string, edt string, vc string, ch string, ar string, is_new string, uv_ct bigint, sv_ct bigint, pv_ct bigint, dur_sum bigint"
    return spark.read.schema(f"{schema}, batch_id bigint, cur_date string").parquet(shop.path("windows", "traffic")).drop("batch_id")
