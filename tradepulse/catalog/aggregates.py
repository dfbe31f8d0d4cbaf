"""Window aggregates. The given feeds are thin, so coarser windows are run as well."""

from __future__ import annotations


from tradepulse import functions as fx
from tradepulse import schemas as S
from tradepulse.catalog import feeds, sql
from tradepulse.catalog.registry import query
from tradepulse.operators import parse, windows
from tradepulse.plans import windows as tables


def events(spark, sf):
    return feeds.table(spark, sf, "events")


def traffic_sql(size: str) -> str:
    w = sql.bucket("ts", size)
    return f"""
WITH {sql.EVENTS},
m AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY mid, CAST(ts AS DATE) ORDER BY ts, event_id) = 1
                     THEN 1 ELSE 0 END AS uv FROM pages),
g AS (SELECT {w} AS w, vc, ch, ar, is_new, sum(uv) AS uv_ct,
             sum(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END) AS sv_ct, count(*) AS pv_ct, sum(k) AS dur_sum
      FROM m GROUP BY ALL)
SELECT {sql.win('w', size)}, vc, ch, ar, is_new, CAST(uv_ct AS BIGINT) AS uv_ct, CAST(sv_ct AS BIGINT) AS sv_ct,
       CAST(pv_ct AS BIGINT) AS pv_ct, CAST(dur_sum AS BIGINT) AS dur_sum FROM g"""


@query("agg_traffic", traffic_sql("10 seconds"))
def agg_traffic(spark, sf):
    return tables.traffic(feeds.pages(events(spark, sf)))


@query("agg_traffic_hour", traffic_sql("1 hour"))
def agg_traffic_hour(spark, sf):
    return tables.traffic(feeds.pages(events(spark, sf)), "1 hour")


def home_sql(size: str) -> str:
    return f"""
WITH {sql.EVENTS},
m AS (SELECT page_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY mid, page_id, CAST(ts AS DATE)
        ORDER BY ts, event_id) AS rn FROM pages WHERE page_id IN ('home', 'good_detail')) WHERE rn = 1),
g AS (SELECT {sql.bucket('ts', size)} AS w, count(CASE WHEN page_id = 'home' THEN 1 END) AS home_uv_ct,
             count(CASE WHEN page_id <> 'home' THEN 1 END) AS good_detail_uv_ct FROM m GROUP BY 1)
SELECT {sql.win('w', size)}, home_uv_ct, good_detail_uv_ct FROM g"""


@query("agg_home_detail", home_sql("10 seconds"))
def agg_home_detail(spark, sf):
    return tables.home_detail(feeds.pages(events(spark, sf)))


@query("agg_home_detail_hour", home_sql("1 hour"))
def agg_home_detail_hour(spark, sf):
    return tables.home_detail(feeds.pages(events(spark, sf)), "1 hour")


def login_sql(size: str) -> str:
    return f"""
WITH {sql.EVENTS},
d AS (SELECT mid, CAST(ts AS DATE) AS day, min(ts) AS ts FROM pages
      WHERE last_page_id IS NULL OR last_page_id = 'login' GROUP BY 1, 2),
b AS (SELECT *, lag(day) OVER (PARTITION BY mid ORDER BY day) AS last FROM d),
g AS (SELECT {sql.bucket('ts', size)} AS w, count(*) AS uu_ct,
             count(CASE WHEN ts > CAST(last AS TIMESTAMP) + INTERVAL 7 DAYS THEN 1 END) AS back_ct FROM b GROUP BY 1)
SELECT {sql.win('w', size)}, back_ct, uu_ct FROM g"""


@query("agg_login", login_sql("10 seconds"))
def agg_login(spark, sf):
    return tables.logins(feeds.pages(events(spark, sf)))


@query("agg_login_day", login_sql("1 day"))
def agg_login_day(spark, sf):
    return tables.logins(feeds.pages(events(spark, sf)), "1 day")


def register_sql(size: str) -> str:
    return f"""
WITH g AS (SELECT {sql.bucket('ts', size)} AS w, count(*) AS register_ct FROM events
           WHERE event_type = 'signup' AND CAST(regexp_extract(props, '[0-9]+') AS BIGINT) <> 13 GROUP BY 1)
SELECT {sql.win('w', size)}, register_ct FROM g"""


def register_rows(spark, sf):
    return parse.parse_json(feeds.register_texts(events(spark, sf)), S.strings("create_time", "id"))


@query("agg_register", register_sql("10 seconds"))
def agg_register(spark, sf):
    return tables.registers(register_rows(spark, sf))


@query("agg_register_hour", register_sql("1 hour"))
def agg_register_hour(spark, sf):
    return tables.registers(register_rows(spark, sf), "1 hour")


CART_UU = f"""
WITH {sql.LINES},
m AS (SELECT row_time, row_number() OVER (PARTITION BY l_suppkey, CAST(row_time AS DATE) ORDER BY row_time) AS rn
      FROM lines WHERE l_tax <> 0.08),
g AS (SELECT {sql.bucket('row_time')} AS w, count(CASE WHEN rn = 1 THEN 1 END) AS cart_add_uu_ct FROM m GROUP BY 1)
SELECT {sql.win('w')}, cart_add_uu_ct FROM g"""


@query("agg_cart_uu", CART_UU)
def agg_cart_uu(spark, sf):
    return tables.cart_users(feeds.cart_facts(spark, sf))


DELTAS = """
amt AS (SELECT id, sku_id, order_id, province_id, row_time, pos,
          CAST(CAST(order_price AS DECIMAL(16,2)) * CAST(sku_num AS BIGINT) AS DECIMAL(16,2)) AS ori,
          CAST(split_activity_amount AS DECIMAL(16,2)) AS act, CAST(split_coupon_amount AS DECIMAL(16,2)) AS cou,
          CAST(split_total_amount AS DECIMAL(16,2)) AS tot FROM details),
sku_delta AS (SELECT id, sku_id, row_time, ori - coalesce(lag(ori) OVER v, 0) AS ori, act - coalesce(lag(act) OVER v, 0) AS act,
          cou - coalesce(lag(cou) OVER v, 0) AS cou, tot - coalesce(lag(tot) OVER v, 0) AS tot FROM amt
          WINDOW v AS (PARTITION BY id ORDER BY row_time, pos, ori, act, cou, tot, sku_id)),
prov_delta AS (SELECT id, order_id, province_id, row_time, tot - coalesce(lag(tot) OVER v, 0) AS tot FROM amt
          WINDOW v AS (PARTITION BY id ORDER BY row_time, pos, tot, order_id, province_id))"""

SKU_SUMS = """CAST(sum(ori) AS DOUBLE) AS original_amount, CAST(sum(act) AS DOUBLE) AS activity_reduce_amount,
       CAST(sum(cou) AS DOUBLE) AS coupon_reduce_amount, CAST(sum(tot) AS DOUBLE) AS order_amount"""


def sku_sql(size: str) -> str:
    return f"""
WITH {sql.DETAILS}, {DELTAS},
g AS (SELECT {sql.bucket('row_time', size)} AS w, sku_id, {SKU_SUMS} FROM sku_delta GROUP BY 1, 2)
SELECT {sql.win('w', size)}, sku_id, original_amount, activity_reduce_amount, coupon_reduce_amount, order_amount FROM g"""


@query("agg_sku_order", sku_sql("10 seconds"))
def agg_sku_order(spark, sf):
    return windows.sku_orders(tables.sku_order_deltas(feeds.details(spark, sf)))


def province_sql(size: str) -> str:
    return f"""
WITH {sql.DETAILS}, {DELTAS},
g AS (SELECT {sql.bucket('row_time', size)} AS w, province_id, CAST(count(DISTINCT order_id) AS BIGINT) AS order_count,
             CAST(sum(tot) AS DOUBLE) AS order_amount FROM prov_delta GROUP BY 1, 2)
SELECT {sql.win('w', size)}, province_id, order_count, order_amount FROM g"""


@query("agg_province_order", province_sql("10 seconds"))
def agg_province_order(spark, sf):
    return windows.province_orders(tables.province_order_deltas(feeds.details(spark, sf)))


@query("agg_province_order_day30", province_sql("30 days").replace(
    "time_bucket(INTERVAL '30 days', row_time)", "time_bucket(INTERVAL '30 days', row_time, TIMESTAMP '1970-01-01')"))
def agg_province_order_month(spark, sf):
    deltas = tables.province_order_deltas(feeds.details(spark, sf), "30 days")
    return windows.province_orders(deltas, "30 days")


KEYWORDS = f"""
WITH w AS (SELECT TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * doc_id AS ts,
                  unnest(CASE WHEN len(t) = 0 THEN [NULL] ELSE t END) AS keyword
           FROM (SELECT doc_id, regexp_extract_all(lower(text), '\\p{{L}}+') AS t FROM documents WHERE source <> 'src3')),
g AS (SELECT {sql.bucket('ts')} AS w, keyword, count(*) AS keyword_count FROM w GROUP BY ALL)
SELECT {sql.win('w')}, keyword, keyword_count FROM g"""


@query("agg_keyword", KEYWORDS)
def agg_keyword(spark, sf):
    pages = parse.parse_json(feeds.document_page_texts(feeds.table(spark, sf, "documents")), S.PAGE)
    return tables.keywords(pages.withColumn("row_time", fx.from_millis("ts")))
