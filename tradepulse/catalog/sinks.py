"""Sinks: what was written is read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse import schemas as S
from tradepulse.catalog import aggregates, etl, feeds, joining, sql
from tradepulse.catalog.registry import query
from tradepulse.operators import changelog, parse, routing, shape
from tradepulse.plans import base, trade
from tradepulse.plans import windows as tables
from tradepulse.session import scratch_dir
from tradepulse.sources import topics
from tradepulse.sinks import keyed
from tradepulse.sinks import topics as out
from tradepulse.streaming import views
from tradepulse.streaming.jobs import each_batch


@query("sink_append", f"WITH {sql.EVENTS} SELECT mid, page_id, ms AS ts FROM pages")
def sink_append(spark, sf):
    path = scratch_dir(spark, "append")
    texts = feeds.page_texts(feeds.stream(spark, sf, "events")).select("value")
    writer = out.append_stream(texts, path + "/out", path + "/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    rows = parse.parse_json(spark.read.text(path + "/out"), S.PAGE)
    return rows.select(F.col("common")["mid"].alias("mid"), F.col("page")["page_id"].alias("page_id"), "ts")


@query("sink_routed", f"""
WITH {sql.ROUTED}, {sql.CONFIG}, {sql.in_force(source_table='table', source_type='type')}
SELECT sink_table, {sql.kept('id')}, {sql.kept('user_id')}, {sql.kept('status')}, {sql.kept('total')} FROM inf""")
def sink_routed(spark, sf):
    path = scratch_dir(spark, "routed")
    routed = base.fact_router(feeds.changes(feeds.routed_changes(spark, sf)), feeds.config_changes(spark, sf, fact=True))
    odd = F.length("sink_table") == 7
    for number, part in ((0, odd), (1, ~odd), (1, ~odd)):  # the second batch is repeated
        out.write_routed(routed.where(part), path, number)
    written = spark.read.schema("value string, sink_table string").text(path)
    return parse.parse_json(written, S.strings("id", "user_id", "status", "total"), keep=["sink_table"])


@query("sink_json", f"WITH {sql.LINES}, {etl.CART_SQL} SELECT * FROM cart_add")
def sink_json(spark, sf):
    path = scratch_dir(spark, "json")
    payload = out.json_payload(trade.cart_add(feeds.changes(feeds.carts(spark, sf))))
    for number in (0, 0):  # the batch is repeated
        out.write_text(payload, path, number)
    return parse.parse_json(spark.read.text(path), S.fact_schema(S.CART_ADD))


@query("sink_upsert_latest", f"""
WITH {sql.LINES},
v AS (SELECT *, (l_tax = 0.08 AND l_returnflag = 'N') AS gone, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS rn FROM lines)
SELECT id, ts, order_price, sku_id FROM v WHERE rn = 1 AND NOT gone""")
def sink_upsert_latest(spark, sf):
    """The topic's last word on each line; where that is a deletion, there is no row."""
    path = scratch_dir(spark, "upsert")
    names = ["id", "ts", "order_price", "sku_id"]
    schema = T.StructType([*S.fact_schema(names).fields, T.StructField("pos", T.LongType())])
    store = keyed.UpsertTable(spark, path + "/table", ["id"], ["pos"], schema)
    facts = topics.fact_versions(feeds.detail_texts(feeds.stream(spark, sf, "lineitem")), names)
    (each_batch(facts, store.write_batch).option("checkpointLocation", path + "/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    store.compact()
    return store.read().drop("pos")


@query("sink_dws_table", aggregates.home_sql("1 hour"))
def sink_dws_table(spark, sf):
    path = scratch_dir(spark, "window-table")
    rows = tables.home_detail(feeds.pages(feeds.table(spark, sf, "events")), "1 hour")
    write = out.window_table_batch(path)
    write(rows, 0)
    write(rows, 0)  # a repeated batch leaves no second copy
    schema = "stt string, edt string, home_uv_ct bigint, good_detail_uv_ct bigint, batch_id bigint, cur_date string"
    return spark.read.schema(schema).parquet(path).drop("batch_id")


@query("snake_json", """
SELECT '{"l_order_key":' || l_orderkey || ',"line_number":' || l_linenumber || ',"return_flag":"' || l_returnflag || '"}' AS value
FROM lineitem""")
def snake_json(spark, sf):
    rows = feeds.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("lOrderKey"), F.col("l_linenumber").alias("lineNumber"),
        F.col("l_returnflag").alias("returnFlag"), F.col("l_suppkey").alias("orderIdSet"))
    return shape.json_lines(rows, hidden=["orderIdSet"])


@query("dim_partial_merge", f"""
WITH {sql.ROUTED},
e AS (SELECT *, max(CASE WHEN type = 'delete' THEN place END) OVER (PARTITION BY user_id) AS gone FROM chg),
live AS (SELECT * FROM e WHERE gone IS NULL OR place > gone)
SELECT user_id, max_by(id, place) AS id, max_by(status, place) FILTER (status IS NOT NULL) AS status, max_by(total, place) AS total
FROM live GROUP BY user_id""")
def dim_partial_merge(spark, sf):
    rows = feeds.changes(feeds.routed_changes(spark, sf)).select(
        "ts", "pos", "type", *[F.col("data")[c].alias(c) for c in ("id", "user_id", "status", "total")])
    return changelog.fold_cells(rows, ["user_id"], ["id", "status", "total"], ["ts", "pos"])


@query("dim_compacted", f"""
WITH {sql.ROUTED},
e AS (SELECT *, max(CASE WHEN type = 'delete' THEN place END) OVER (PARTITION BY user_id) AS gone FROM chg),
live AS (SELECT * FROM e WHERE gone IS NULL OR place > gone)
SELECT user_id AS id, max_by(status, place) FILTER (status IS NOT NULL) AS status, max_by(total, place) AS total
FROM live GROUP BY user_id""")
def dim_compacted(spark, sf):
    """Changes in three batches out of their order, with a compaction after each."""
    store = keyed.DimTables(spark, scratch_dir(spark, "compacted"))
    rows = feeds.changes(feeds.routed_changes(spark, sf)).select(
        F.col("data")["user_id"].alias("row_key"), F.map_filter("data", lambda k, _v: k.isin("status", "total")).alias("data"),
        "type", F.col("ts").alias("version"), "pos", F.lit("dim_user").alias("sink_table"))
    for n, part in enumerate((2, 0, 1)):
        store.write_batch(rows.where(F.col("pos") % 3 == part), n)
        store.compact()
    return store.dim("dim_user", ["status", "total"])


@query("dim_refresh", """
SELECT CAST(o_custkey AS VARCHAR) AS id, arg_max(o_orderpriority, o_orderkey) AS priority, CAST(max(o_orderkey) AS VARCHAR) AS last_order
FROM orders GROUP BY 1""")
def dim_refresh(spark, sf):
    """Two batches of dimension changes; the read after the second sees its values."""
    store = keyed.DimTables(spark, scratch_dir(spark, "dims"))
    rows = feeds.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("row_key"),
        F.create_map(F.lit("priority"), F.col("o_orderpriority"),
                     F.lit("last_order"), F.col("o_orderkey").cast("string")).alias("data"),
        F.lit("update").alias("type"), F.col("o_orderkey").alias("version"),
        F.lit("dim_user").alias("sink_table"))
    early = F.col("data")["priority"].isin("1-URGENT", "2-HIGH")
    store.write_batch(rows.where(early), 0)
    store.write_batch(rows.where(~early), 1)
    return store.dim("dim_user", ["priority", "last_order"])


@query("dim_wide_articles", f"""
WITH {joining.DIMS.replace("n3.n_name AS category3_name", "n3.n_name || CASE WHEN n3.n_nationkey % 2 = 0 THEN ' (new)' ELSE '' END AS category3_name")}
SELECT sku_id, {joining.chained()} FROM chain""")
def dim_wide_articles(spark, sf):
    """All levels in one batch of dimension changes, new names of some categories in the next."""
    path, dims = scratch_dir(spark, "wide"), feeds.sku_dims(spark, sf)
    store = keyed.DimTables(spark, f"{path}/dims")
    wide = views.WideDimension(store, f"{path}/articles")

    def changes(name, rows, version):
        cells = [x for c in rows.columns if c != "id" for x in (F.lit(c), F.col(c))]
        return rows.select(F.col("id").alias("row_key"), F.create_map(*cells).alias("data"), F.lit("update").alias("type"),
                           F.lit(version).cast("bigint").alias("version"), F.lit(0).cast("bigint").alias("pos"), F.lit(name).alias("sink_table"))

    named = dims["dim_base_category3"].where("id % 2 = 0").select("id", F.concat("name", F.lit(" (new)")).alias("name"))
    batches = [reduce(DataFrame.unionByName, [changes(n, d, 1) for n, d in dims.items()]), changes("dim_base_category3", named, 2)]
    for number, batch in enumerate(batches):
        store.write_batch(batch, number)
        wide.update(number)
    return wide.read().select("sku_id", *joining.CHAIN_COLUMNS)


@query("dim_table_lifecycle", f"""
WITH {sql.CONFIG},
r AS (SELECT *, row_number() OVER (PARTITION BY sink_table ORDER BY ts_ms DESC, (op <> 'd') DESC) AS rn FROM steps)
SELECT sink_table, CASE op WHEN 'd' THEN 'dropped' WHEN 'u' THEN 'reset' ELSE 'active' END AS state FROM r WHERE rn = 1""")
def dim_table_lifecycle(spark, sf):
    return routing.table_lifecycle(feeds.config_steps(spark, sf), "ts_ms").select("sink_table", "state")
