"""Sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.catalog import feeds, sql
from tradepulse.catalog.registry import query
from tradepulse.operators import changelog
from tradepulse.session import scratch_dir
from tradepulse.sources import tables, topics


@query("src_raw_text", """
SELECT coalesce(text, '') AS value FROM documents
UNION ALL SELECT '' FROM documents WHERE doc_id % 50 = 7""")
def raw_text(spark, sf):
    """A topic of all texts with tombstones among them, as the reader gives it."""
    path = scratch_dir(spark, "raw-text")
    docs = feeds.table(spark, sf, "documents")
    tombstones = docs.where("doc_id % 50 = 7").select(F.lit(None).cast("string").alias("value"))
    docs.select(F.col("text").alias("value")).unionByName(tombstones).write.parquet(path)
    return topics.raw_text(spark, topics.Topic("raw", path, file_format="parquet"), streaming=False)


@query("src_config_changes", f"""
WITH {sql.CONFIG}
SELECT op, ts_ms, CASE WHEN op IN ('u', 'd') THEN before_table END AS before_table,
       CASE WHEN op <> 'd' THEN after_table END AS after_table,
       CASE WHEN op <> 'd' THEN sink_columns END AS after_columns FROM cfg_raw""")
def config_changes(spark, sf):
    return feeds.config_changes(spark, sf).select(
        "op", "ts_ms", F.col("before.source_table").alias("before_table"),
        F.col("after.source_table").alias("after_table"),
        F.col("after.sink_columns").alias("after_columns"))


#: A place in the middle of the captured config changes.
HALF_WAY = "(SELECT (1704067200 + max(c_custkey) // 2) * 1000 + 500 FROM customer)"


def half_way(spark, sf) -> int:
    return (feeds.START + feeds.table(spark, sf, "customer").agg(F.max("c_custkey")).first()[0] // 2) * 1000 + 500


def half_snapshot(spark, sf, key, fact=False):
    """The config table as it was half way, from a parquet export."""
    path = scratch_dir(spark, "half-way")
    steps = feeds.config_steps(spark, sf, fact).where(F.col("ts_ms") <= half_way(spark, sf))
    now = changelog.current_config(steps, key, "ts_ms")
    now.select((S.FACT_CONFIG if fact else S.DIM_CONFIG).names).write.parquet(path)
    return tables.snapshot(spark, path)


def until_half_way(key):
    return sql.current(key).replace("FROM steps)", f"FROM steps WHERE ts_ms <= {HALF_WAY})")


@query("src_snapshot_then_changes", f"""
WITH {sql.CONFIG}, {until_half_way('source_table')}
SELECT 'r' AS op, {HALF_WAY} AS ts_ms, CAST(NULL AS VARCHAR) AS before_table, source_table AS after_table, sink_columns AS after_columns FROM cur
UNION ALL
SELECT op, ts_ms, CASE WHEN op IN ('u', 'd') THEN before_table END, CASE WHEN op <> 'd' THEN after_table END,
       CASE WHEN op <> 'd' THEN sink_columns END FROM cfg_raw WHERE ts_ms > {HALF_WAY}""")
def snapshot_then_changes(spark, sf):
    """The capture holds all changes from the first on, so half of them are in the snapshot too."""
    rows = tables.snapshot_then_changes(half_snapshot(spark, sf, ["source_table"]), feeds.config_changes(spark, sf), half_way(spark, sf))
    return rows.select("op", "ts_ms", F.col("before.source_table").alias("before_table"),
                       F.col("after.source_table").alias("after_table"), F.col("after.sink_columns").alias("after_columns"))


@query("src_json_table", f"""
WITH {sql.LINES}
SELECT id, CASE WHEN l_tax <> 0.08 THEN CAST(l_suppkey AS VARCHAR) END AS user_id, sku_id, ts FROM lines""")
def json_table(spark, sf):
    raw = feeds.cart_fact_texts(feeds.table(spark, sf, "lineitem"))
    return topics.json_table(raw, S.fact_schema(S.CART_ADD)).select("id", "user_id", "sku_id", "ts")


@query("src_change_envelope", f"""
WITH {sql.ORDERS}
SELECT 'shop' AS "database", 'order_info' AS "table", 'update' AS type, ts + 60 AS ts,
       epoch_ms(row_time) + 60000 AS row_ms, id, status,
       CASE WHEN status_changed THEN '1001' END AS old_status FROM ord""")
def change_envelope(spark, sf):
    rows = topics.change_envelope(feeds.order_updates(spark, sf))
    return rows.where(F.col("proc_time").isNotNull()).select(
        "database", "table", "type", "ts", F.unix_millis("row_time").alias("row_ms"),
        F.col("data")["id"].alias("id"), F.col("data")["order_status"].alias("status"),
        F.col("old")["order_status"].alias("old_status"))


@query("src_page_log", f"""
WITH {sql.EVENTS}
SELECT mid, page_id, CAST(k AS VARCHAR) AS during_time, last_page_id, ms AS ts, ms AS row_ms FROM pages""")
def page_log(spark, sf):
    rows = topics.page_log(feeds.page_texts(feeds.table(spark, sf, "events")))
    page = F.col("page")
    return rows.select(F.col("common")["mid"].alias("mid"), page["page_id"].alias("page_id"),
                       page["during_time"].alias("during_time"),
                       page["last_page_id"].alias("last_page_id"), "ts",
                       F.unix_millis("row_time").alias("row_ms"))


@query("src_fact_reread", f"""
WITH {sql.DETAILS}
SELECT id, order_id, sku_id, user_id, activity_id, coupon_id, order_price, ts, ts * 1000 AS row_ms FROM details""")
def fact_reread(spark, sf):
    return feeds.details(spark, sf, timed=True).select(
        "id", "order_id", "sku_id", "user_id", "activity_id", "coupon_id", "order_price", "ts",
        F.unix_millis("row_time").alias("row_ms"))


@query("src_snapshot_config", f"""
WITH {sql.CONFIG}, {sql.current('source_table')}
SELECT source_table AS "sourceTable", sink_table AS "sinkTable", sink_columns AS "sinkColumns" FROM cur""")
def snapshot_config(spark, sf):
    path = scratch_dir(spark, "config")
    current = changelog.current_config(feeds.config_steps(spark, sf), ["source_table"], "ts_ms")
    current.select("source_table", "sink_table", "sink_columns").write.parquet(path)
    return tables.snapshot(spark, path, camel=True)


@query("src_dim_nested", "SELECT CAST(p_partkey AS VARCHAR) AS rowkey, p_name AS dic_name FROM part")
def dim_nested(spark, sf):
    dim = feeds.table(spark, sf, "part")
    return tables.nested_dictionary(dim, "p_partkey", "p_name").select(
        "rowkey", F.col("info.dic_name").alias("dic_name"))
