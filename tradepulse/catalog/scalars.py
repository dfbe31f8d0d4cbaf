"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepulse import functions as fx
from tradepulse.catalog import feeds
from tradepulse.catalog.registry import query


@query("scalar_time", """
SELECT event_id, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime,
       strftime(ts, '%Y%m%d') AS part, epoch_ms(date_trunc('second', ts)) AS parsed_ms,
       epoch_ms(date_trunc('day', ts)) AS day_ms, epoch_ms(date_trunc('second', ts)) AS second_ms,
       CAST(NULL AS BIGINT) AS bad_ms FROM events""")
def scalar_time(spark, sf):
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = feeds.table(spark, sf, "events").select("event_id", "event_type", at.alias("ms"))
    t = fx.from_millis("ms")
    return rows.select("event_id", "ms", fx.date_text(t).alias("date"), fx.datetime_text(t).alias("datetime"),
                       fx.partition_text(t).alias("part"),
                       fx.datetime_to_millis(fx.datetime_text(t)).alias("parsed_ms"),
                       fx.date_to_millis(fx.date_text(t)).alias("day_ms"),
                       F.unix_millis(fx.from_seconds(F.floor(F.col("ms") / 1000))).alias("second_ms"),
                       fx.datetime_to_millis("event_type").alias("bad_ms"))


@query("scalar_cast", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS BIGINT) AS quantity, CAST(NULL AS BIGINT) AS no_number,
       CASE WHEN l_linestatus = 'O' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
            ELSE CAST(CAST(l_quantity AS BIGINT) - l_linenumber AS VARCHAR) END AS amount,
       CAST(l_partkey AS VARCHAR) || ':' || l_suppkey AS "key" FROM lineitem""")
def scalar_cast(spark, sf):
    rows = feeds.table(spark, sf, "lineitem")
    text = F.col("l_quantity").cast("bigint").cast("string")
    number = fx.to_long(text)
    return rows.select("l_orderkey", "l_linenumber", number.alias("quantity"),
                       fx.to_long("l_returnflag").alias("no_number"),
                       F.when(F.col("l_linestatus") == "O", text)
                       .otherwise((number - F.col("l_linenumber")).cast("string")).alias("amount"),
                       F.concat_ws(":", "l_partkey", "l_suppkey").alias("key"))


@query("scalar_map", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS present, CAST(NULL AS VARCHAR) AS missing,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) END AS kept,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS kept_keys FROM orders""")
def scalar_map(spark, sf):
    data = F.create_map(F.lit("user"), F.col("o_custkey").cast("string"),
                        F.lit("status"), F.col("o_orderstatus"))
    rows = feeds.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", data.alias("data"))
    wanted = F.when(F.col("o_orderstatus") == "F", "user,other").otherwise("other")
    kept = fx.keep_keys("data", wanted)
    return rows.select("o_orderkey", F.col("data")["user"].alias("present"), F.col("data")["none"].alias("missing"),
                       kept["user"].alias("kept"), F.size(kept).alias("kept_keys"))


@query("scalar_decimal", """
SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS DOUBLE) AS total,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(16,2)) - CAST(l_tax AS DECIMAL(16,2))) AS DOUBLE) AS net,
       CAST(sum(CAST(l_discount AS DECIMAL(16,2)) * CAST(l_quantity AS BIGINT)) AS DOUBLE) AS product,
       CAST(0 AS DOUBLE) AS unreadable FROM lineitem GROUP BY 1""")
def scalar_decimal(spark, sf):
    price, tax, discount = (fx.money(feeds.cents(c)) for c in ("l_extendedprice", "l_tax", "l_discount"))
    return feeds.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum(price).alias("total"), F.sum(price - tax).alias("net"),
        F.sum(discount * F.col("l_quantity").cast("bigint").cast("decimal(16,0)")).cast("decimal(18,2)").alias("product"),
        F.sum(fx.money_or_zero("l_returnflag")).alias("unreadable"))


@query("scalar_text_split", """
SELECT doc_id, CAST(len(t) AS BIGINT) AS tokens, CAST(len(list_distinct(t)) AS BIGINT) AS words, t[1] AS first
FROM (SELECT doc_id, regexp_extract_all(lower(text), '\\p{L}+') AS t FROM documents)""")
def scalar_text_split(spark, sf):
    rows = feeds.table(spark, sf, "documents").select("doc_id", fx.tokens("text").alias("t"))
    return rows.select("doc_id", F.size("t").alias("tokens"), F.size(F.array_distinct("t")).alias("words"),
                       F.try_element_at("t", F.lit(1)).alias("first"))
