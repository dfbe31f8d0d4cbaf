"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepulse import functions as fx
from tradepulse import schemas as S
from tradepulse.catalog import feeds, sql
from tradepulse.catalog.registry import query
from tradepulse.operators import changelog, joins, routing, segment
from tradepulse.plans import trade

#: Versions by year: many of one line share their time, and the one that arrived last counts.
YEARS = "years AS (SELECT * REPLACE (CAST(epoch(date_trunc('year', row_time)) AS BIGINT) AS ts) FROM lines)"

LATEST_LINE = f"""
{YEARS},
line AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, pos DESC) AS rn FROM years) WHERE rn = 1)"""

ACTIVITY = """
act AS (SELECT id, max_by(activity_id, (ts, pos)) AS activity_id, max_by(activity_rule_id, (ts, pos)) AS activity_rule_id
        FROM (SELECT id, ts, pos, 'a' || l_linenumber AS activity_id, 'r' || l_suppkey AS activity_rule_id
              FROM years WHERE l_discount >= 0.05) GROUP BY id),
cou AS (SELECT id, max_by(coupon_id, (ts, pos)) AS coupon_id
        FROM (SELECT id, ts, pos, 'c' || l_suppkey AS coupon_id FROM years WHERE l_tax >= 0.06) GROUP BY id)"""


def order_changes(spark, sf):
    return feeds.landed(spark, feeds.lines(spark, sf), feeds.orders(spark, sf))


@query("join_order_inner", f"""
WITH {sql.LINES}, {sql.ORDERS}
SELECT lines.id, order_id, sku_id, user_id, province_id, split_total_amount, lines.ts
FROM lines JOIN ord ON lines.order_id = ord.id""")
def order_inner(spark, sf):
    changes = order_changes(spark, sf)
    orders = trade.new_orders(changes).drop("ts").withColumnRenamed("id", "order_id")
    return trade.order_lines(changes).join(orders, "order_id", "inner").select(
        "id", "order_id", "sku_id", "user_id", "province_id", "split_total_amount", "ts")


WIDE = f"""
WITH {sql.LINES}, {sql.ORDERS}, {LATEST_LINE}, {ACTIVITY}
SELECT line.id, order_id, sku_id, user_id, activity_id, activity_rule_id, coupon_id, province_id, sku_name,
       order_price, sku_num, create_time, split_total_amount, split_activity_amount, split_coupon_amount, line.ts
FROM line JOIN ord ON line.order_id = ord.id LEFT JOIN act ON line.id = act.id LEFT JOIN cou ON line.id = cou.id"""


def wide_changes(spark, sf):
    by_year = feeds.years
    return feeds.landed(spark, feeds.lines(spark, sf, by_year), feeds.orders(spark, sf), feeds.order_updates(spark, sf),
                        feeds.activities(spark, sf, by_year), feeds.coupons(spark, sf, by_year))


@query("order_detail_wide", WIDE)
def order_detail_wide(spark, sf):
    """Of versions of one time the last to arrive counts, whatever its values."""
    return joins.order_lines(*trade.order_sides(wide_changes(spark, sf))).select(*S.ORDER_DETAIL)


CANCEL = f"""
WITH {sql.DETAILS}, {sql.ORDERS}
SELECT d.id, order_id, sku_id, ord.user_id, activity_id, activity_rule_id, coupon_id, ord.province_id, sku_name,
       order_price, sku_num, create_time, split_total_amount, split_activity_amount, split_coupon_amount, d.ts
FROM details d JOIN ord ON d.order_id = ord.id WHERE ord.status = '1003'"""


@query("order_cancel_join", CANCEL)
def order_cancel_join(spark, sf):
    lines = feeds.details(spark, sf).drop("user_id", "province_id")
    cancelled = trade.cancelled_orders(feeds.changes(feeds.order_updates(spark, sf)))
    return lines.join(cancelled, "order_id", "inner").select(*S.ORDER_DETAIL)


@query("interval_join", f"""
WITH {sql.EVENTS}
SELECT p.event_id AS order_event, c.event_id AS pay_event, p.mid, p.ms AS order_ms, c.ms AS pay_ms
FROM good p JOIN good c ON p.mid = c.mid AND c.ts BETWEEN p.ts - INTERVAL 1 HOUR AND p.ts + INTERVAL 24 HOUR
WHERE p.kind = 'click' AND c.kind = 'purchase' AND p.has_page AND c.has_page""")
def interval_join(spark, sf):
    rows = feeds.pages(feeds.table(spark, sf, "events")).select(
        "offset", F.col("common")["mid"].alias("mid"), F.col("page")["page_id"].alias("page_id"),
        F.timestamp_millis("ts").alias("at"))
    orders = rows.where("page_id = 'home'").select("mid", F.col("offset").alias("order_event"),
                                                   F.col("at").alias("order_at"))
    pays = rows.where("page_id = 'payment'").select("mid", F.col("offset").alias("pay_event"),
                                                    F.col("at").alias("pay_at"))
    both = joins.interval_join(pays, orders, ["mid"], "pay_at", "order_at", 3600, 24 * 3600)
    return both.select("order_event", "pay_event", "mid", F.unix_millis("order_at").alias("order_ms"),
                       F.unix_millis("pay_at").alias("pay_ms"))


REFUND = f"""
paid AS (SELECT 'rp' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, order_id, sku_id,
                '110' || l_linenumber % 7 AS payment_type, create_time AS callback_time,
                split_total_amount AS total_amount, ts + 120 AS ts
         FROM lines WHERE l_returnflag = 'R' AND l_tax < 0.08),
done AS (SELECT order_id, sku_id, sku_num AS refund_num FROM lines WHERE l_returnflag = 'R' AND l_linestatus = 'F'),
refunded AS (SELECT id AS order_id, user_id, province_id FROM ord WHERE status = '1006' AND status_changed),
refund_pay AS (SELECT paid.id, user_id, paid.order_id, paid.sku_id, province_id, payment_type, callback_time,
                      total_amount, refund_num, paid.ts
               FROM paid JOIN done ON paid.order_id = done.order_id AND paid.sku_id = done.sku_id
               JOIN refunded ON paid.order_id = refunded.order_id)"""


def refund_changes(spark, sf):
    return feeds.landed(spark, feeds.refunds(spark, sf), feeds.refund_payments(spark, sf),
                        feeds.order_updates(spark, sf))


@query("refund_pay_join", f"WITH {sql.LINES}, {sql.ORDERS}, {REFUND} SELECT * FROM refund_pay")
def refund_pay_join(spark, sf):
    return trade.refunds_paid(refund_changes(spark, sf)).select(
        "id", "user_id", "order_id", "sku_id", "province_id", "payment_type", "callback_time",
        "total_amount", "refund_num", "ts")


COMMENTS = """
com AS (SELECT CAST(doc_id AS VARCHAR) AS id, source AS user_id, lang AS nick_name, CAST(doc_id AS VARCHAR) AS sku_id,
               's' || lang AS spu_id, 'o' || doc_id AS order_id,
               CASE lang WHEN 'en' THEN '1101' WHEN 'fr' THEN '1102' WHEN 'de' THEN '1103' ELSE '1109' END AS appraise_code,
               text AS comment_txt, '2024-01-01 00:00:00' AS create_time, CAST(NULL AS VARCHAR) AS operate_time
        FROM documents)"""


@query("lookup_inner", f"""
WITH {COMMENTS}, {sql.DIC} SELECT id, appraise_code, dic_name AS appraise_name FROM com JOIN dic ON appraise_code = rowkey""")
def lookup_inner(spark, sf):
    comments = trade.comments(feeds.changes(feeds.comments(spark, sf)))
    return joins.lookup(comments, feeds.dictionary(spark, sf), "appraise", "rowkey",
                        {"appraise_name": "info.dic_name"}, "inner").select(
        "id", F.col("appraise").alias("appraise_code"), "appraise_name")


@query("lookup_left", f"""
WITH {sql.PAYMENTS}, {sql.DIC}
SELECT order_id, payment_type_code, dic_name AS payment_type_name, payment_time, ts
FROM pay LEFT JOIN dic ON payment_type_code = rowkey""")
def lookup_left(spark, sf):
    pays = trade.payments(feeds.changes(feeds.payments(spark, sf)))
    return joins.lookup(pays, feeds.dictionary(spark, sf), "payment_type_code", "rowkey",
                        {"payment_type_name": "info.dic_name"}, "left").select(
        "order_id", "payment_type_code", "payment_type_name", "payment_time", "ts")


ORDER_REFUND = f"""
asked AS (SELECT 'r' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, 'u' || l_suppkey AS user_id,
                 order_id, sku_id, '110' || l_linenumber % 7 AS refund_type, sku_num AS refund_num,
                 split_total_amount AS refund_amount, '13' || l_linenumber AS refund_reason_type,
                 'late' AS refund_reason_txt, create_time, ts FROM lines WHERE l_returnflag = 'R'),
refunding AS (SELECT id AS order_id, province_id FROM ord WHERE status = '1005' AND status_changed),
order_refund AS (SELECT asked.id, province_id, user_id, asked.order_id, sku_id, refund_type, refund_num, refund_amount,
                        refund_reason_type, refund_reason_txt, create_time, rowkey, dic_name, ts
                 FROM asked JOIN refunding ON asked.order_id = refunding.order_id JOIN dic ON refund_type = rowkey)"""


@query("dict_join", f"""
WITH {sql.LINES}, {sql.ORDERS}, {sql.DIC}, {ORDER_REFUND}
SELECT asked.id, refund_type, rowkey, dic_name FROM asked JOIN dic ON refund_type = rowkey""")
def dict_join(spark, sf):
    asked = trade.refund_requests(feeds.changes(feeds.refunds(spark, sf)))
    return joins.lookup(asked, feeds.dictionary(spark, sf), "refund_type", "rowkey",
                        {"rowkey": "rowkey", "dic_name": "info.dic_name"}, "inner").select(
        "id", "refund_type", "rowkey", "dic_name")


DIMS = """
sku AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_size % 30 AS c3, p_brand, p_type, p_name FROM part WHERE p_size <> 50),
chain AS (SELECT sku.id AS sku_id, p_name AS sku_name, p_type AS spu_id,
            CASE WHEN p_type <> 'PROMO' THEN 'spu ' || p_type END AS spu_name,
            CAST(c3 AS VARCHAR) AS category3_id, n3.n_name AS category3_name,
            CAST(n3.n_regionkey AS VARCHAR) AS category2_id, r2.r_name AS category2_name,
            CASE WHEN r2.r_regionkey IS NOT NULL THEN CAST(r2.r_regionkey + 1 AS VARCHAR) END AS category1_id,
            r1.r_name AS category1_name, p_brand AS trademark_id, 'tm ' || p_brand AS trademark_name
          FROM sku LEFT JOIN nation n3 ON sku.c3 = n3.n_nationkey
          LEFT JOIN region r2 ON n3.n_regionkey = r2.r_regionkey AND r2.r_regionkey <> 3
          LEFT JOIN region r1 ON r2.r_regionkey + 1 = r1.r_regionkey)"""

CHAIN_COLUMNS = ["sku_name", "spu_id", "spu_name", "category3_id", "category3_name", "category2_id",
                 "category2_name", "category1_id", "category1_name", "trademark_id", "trademark_name"]


def chained(cols="t."):
    return ", ".join(f"chain.{c}" for c in CHAIN_COLUMNS)


@query("dim_chain", f"""
WITH {DIMS}
SELECT CAST(l_partkey AS VARCHAR) AS sku_id, CAST(count(*) AS BIGINT) AS lines, {chained()}
FROM lineitem t LEFT JOIN chain ON CAST(l_partkey AS VARCHAR) = chain.sku_id GROUP BY ALL""")
def dim_chain(spark, sf):
    facts = (feeds.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("sku_id"))
             .agg(F.count("*").alias("lines")))
    return joins.dim_chain(facts, feeds.sku_dims(spark, sf)).select("sku_id", "lines", *CHAIN_COLUMNS)


PROVINCE = """
SELECT CAST(o_custkey % 25 AS VARCHAR) AS province_id, n_name AS province_name, CAST(count(*) AS BIGINT) AS orders
FROM orders LEFT JOIN nation ON o_custkey % 25 = n_nationkey AND n_nationkey <> 4 GROUP BY ALL"""


def per_province(spark, sf):
    return (feeds.table(spark, sf, "orders").groupBy((F.col("o_custkey") % 25).cast("string").alias("province_id"))
            .agg(F.count("*").alias("orders")))


@query("lookup_cached", PROVINCE)
def lookup_cached(spark, sf):
    dims = joins.CachedDims(spark, lambda s, _name: feeds.provinces(s, sf))
    return joins.lookup(per_province(spark, sf), dims.get("dim_base_province"), "province_id", "id",
                        {"province_name": "name"})


@query("dim_join_generic", PROVINCE)
def dim_join_generic(spark, sf):
    return joins.lookup(per_province(spark, sf), feeds.provinces(spark, sf), "province_id", "id",
                        {"province_name": "name"})


@query("config_route_dim", f"""
WITH {sql.ROUTED}, {sql.CONFIG}, {sql.in_force(source_table='table')}
SELECT ts, "table", id, sink_table, sink_columns FROM inf""")
def route_dim(spark, sf):
    routed = routing.in_force(feeds.changes(feeds.routed_changes(spark, sf)), feeds.config_steps(spark, sf),
                              ["source_table"], ["table"], "ts_ms", F.col("ts") * 1000)
    return routed.select("ts", "table", F.col("data")["id"].alias("id"),
                         F.col("cfg_sink_table").alias("sink_table"), F.col("cfg_sink_columns").alias("sink_columns"))


@query("config_route_fact", f"""
WITH {sql.ROUTED}, {sql.CONFIG}, {sql.current('source_table, source_type')}
SELECT ts, "table", type, id, sink_table, sink_columns FROM chg JOIN cur
ON chg."table" = cur.source_table AND chg.type = cur.source_type""".replace("SELECT ts, ", "SELECT chg.ts, "))
def route_fact(spark, sf):
    config = changelog.current_config(feeds.config_steps(spark, sf, fact=True),
                                      ["source_table", "source_type"], "ts_ms")
    routed = routing.by_table_and_type(feeds.changes(feeds.routed_changes(spark, sf)), config)
    return routed.select("ts", "table", "type", F.col("data")["id"].alias("id"),
                         F.col("cfg_sink_table").alias("sink_table"), F.col("cfg_sink_columns").alias("sink_columns"))


@query("keyword_lateral", """
SELECT doc_id, keyword, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT doc_id, unnest(CASE WHEN len(t) = 0 THEN [NULL] ELSE t END) AS keyword
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '\\p{L}+') AS t FROM documents)) GROUP BY ALL""")
def keyword_lateral(spark, sf):
    words = feeds.table(spark, sf, "documents").select("doc_id", fx.keywords("text").alias("keyword"))
    return words.groupBy("doc_id", "keyword").agg(F.count("*").alias("n"))


@query("keyword_segmented", """
WITH RECURSIVE own AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS run FROM documents),
runs AS MATERIALIZED (SELECT run, count(*) AS n FROM own GROUP BY run),
total AS (SELECT CAST(sum(n * length(run)) AS DOUBLE) AS letters FROM runs),
grams AS MATERIALIZED (SELECT substr(run, a, s) AS word, sum(n) AS n FROM runs, unnest(range(1, length(run) + 1)) t(a), range(1, 7) u(s)
          WHERE a + s - 1 <= length(run) GROUP BY 1),
held AS (SELECT g.word, g.n FROM grams g, range(1, 6) t(c), grams a, grams b
         WHERE g.n >= 5 AND c < length(g.word) AND a.word = substr(g.word, 1, c) AND b.word = substr(g.word, c + 1)
         GROUP BY g.word, g.n HAVING g.n * (SELECT letters FROM total) >= 4.0 * max(CAST(a.n AS DOUBLE) * b.n)),
words AS MATERIALIZED (SELECT word, CAST(round(ln((SELECT letters FROM total) / n) * 1000) AS BIGINT) AS cost
          FROM (SELECT * FROM held UNION ALL SELECT word, n FROM grams WHERE length(word) = 1)),
edges AS MATERIALIZED (SELECT run, CAST(a + s - 1 AS INTEGER) AS stop, list(struct_pack(s := CAST(s AS INTEGER), cost := cost)) AS es
          FROM runs, unnest(range(1, length(run) + 1)) t(a), range(1, 7) u(s), words WHERE a + s - 1 <= length(run) AND word = substr(run, a, s) GROUP BY 1, 2),
walk AS (SELECT run, 0 AS stop, [struct_pack(cost := CAST(0 AS BIGINT), k := 0, start := 0)] AS best FROM runs
         UNION ALL
         SELECT w.run, e.stop, list_append(w.best, list_min(list_transform(e.es, lambda x: struct_pack(
                cost := w.best[e.stop - x.s + 1].cost + x.cost, k := w.best[e.stop - x.s + 1].k + 1, start := e.stop - x.s))))
         FROM walk w JOIN edges e ON e.run = w.run AND e.stop = w.stop + 1),
back AS (SELECT run, best, stop AS p FROM walk WHERE stop = length(run)
         UNION ALL SELECT run, best, best[p + 1].start FROM back WHERE best[p + 1].start > 0),
cut AS (SELECT run, substr(run, best[p + 1].start + 1, p - best[p + 1].start) AS keyword FROM back)
SELECT doc_id, keyword, CAST(count(*) AS BIGINT) AS n FROM own JOIN cut USING (run) GROUP BY ALL""")
def keyword_segmented(spark, sf):
    """Words of a list mined from the texts, by the best path; the twin walks each run letter by letter."""
    docs = feeds.table(spark, sf, "documents").select("doc_id", "text")
    return segment.segmented_keywords(docs, "doc_id")
