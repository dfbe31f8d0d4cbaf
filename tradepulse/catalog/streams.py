"""Streaming queries: each stream works off its input, then its output is read back.

A window stays open until the watermark passes its end, so the SQL twins keep to windows
that end before the newest time minus the lateness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse import schemas as S
from tradepulse.catalog import aggregates, feeds, jobs, joining, sql, states
from tradepulse.catalog.registry import query
from tradepulse.operators import joins, logsplit, parse, visitors, windows
from tradepulse.plans import windows as tables
from tradepulse.session import scratch_dir
from tradepulse.sinks import fanout
from tradepulse.sinks import topics as out
from tradepulse.sources import topics
from tradepulse.streaming import firstdays, stores
from tradepulse.streaming.jobs import Job, each_batch


def run(spark: SparkSession, rows: DataFrame, label: str, path: str | None = None) -> DataFrame:
    path = path or scratch_dir(spark, label)
    job = Job(label, lambda _s: rows, lambda r: r,
              lambda r: out.append_stream(r, f"{path}/out", f"{path}/checkpoint", "parquet"),
              f"{path}/checkpoint")
    job.run(spark)
    return spark.read.schema(rows.schema).parquet(f"{path}/out")


def run_batches(spark: SparkSession, rows: DataFrame, label: str, form, schema: str) -> DataFrame:
    """Work a stream off by a ``foreachBatch`` form, built from a folder and a writer, and read its window table."""
    path = scratch_dir(spark, label)
    each = form(path, out.plain_batch(f"{path}/out"))
    Job(label, lambda _s: rows, lambda r: r, lambda r: each_batch(r, each), f"{path}/checkpoint").run(spark)
    return spark.read.schema(schema).parquet(f"{path}/out").drop("batch_id")


WINDOW_COLUMNS = "stt string, edt string, cur_date string"


def page_stream(spark, sf) -> DataFrame:
    return feeds.pages(feeds.stream(spark, sf, "events"))


def closed(body: str, late: str, time: str = "ts", of: str = "pages", size: str = "10 seconds") -> str:
    """Keep the windows ``w`` of ``g`` that were closed at the end of the stream."""
    assert body.endswith("FROM g")
    return f"{body} WHERE w + INTERVAL '{size}' <= (SELECT max({time}) FROM {of}) - INTERVAL '{late}'"


@query("stream_fix_is_new", f"WITH {sql.FIXED} SELECT mid, is_new_fixed AS is_new, ms AS ts FROM fixed")
def stream_fix_is_new(spark, sf):
    logs = parse.behaviour_logs(parse.parse_json(feeds.log_texts(feeds.stream(spark, sf, "events")), S.LOG))
    path = scratch_dir(spark, "fix-is-new")
    flags = lambda rows: rows.select(F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"), "ts")
    write = firstdays.repair(firstdays.FirstDays(spark, f"{path}/first"),
                             lambda fixed, n: flags(fixed).write.mode("overwrite").parquet(f"{path}/out/batch_id={n}"))
    each_batch(logs, write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(flags(logs).schema).parquet(f"{path}/out").select("mid", "is_new", "ts")


@query("stream_window_append", closed(f"""
WITH {sql.EVENTS}, g AS (SELECT {sql.bucket()} AS w, page_id, count(*) AS pv_ct FROM pages GROUP BY ALL)
SELECT {sql.win('w')}, page_id, pv_ct FROM g""", "3 seconds"))
def stream_window_append(spark, sf):
    views = visitors.page_columns(page_stream(spark, sf)).withWatermark("row_time", windows.LATENESS["traffic"])
    return run(spark, windows.tumble(views, [F.count("*").alias("pv_ct")], ["page_id"]), "window-append")


@query("stream_window_monotonic", closed(f"""
WITH {sql.EVENTS}, g AS (SELECT {sql.bucket('ts', '1 hour')} AS w, mid, count(*) AS n FROM logs GROUP BY ALL)
SELECT {sql.win('w', '1 hour')}, mid, n FROM g""", "0 seconds", of="logs", size="1 hour"))
def stream_window_monotonic(spark, sf):
    """Logs come in order of time: a window closes with the first log beyond it."""
    logs = feeds.logs(feeds.stream(spark, sf, "events")).select(F.col("common")["mid"].alias("mid"), F.timestamp_millis("ts").alias("row_time"))
    timed = logs.withWatermark("row_time", windows.LATENESS["log"])
    return run(spark, windows.tumble(timed, [F.count("*").alias("n")], ["mid"], size="1 hour"), "monotonic")


SPLIT = "2024-01-16 00:00:00"


@query("stream_late_drop", f"""
WITH {sql.EVENTS}, p AS (SELECT * FROM pages WHERE ts >= TIMESTAMP '{SPLIT}'),
g AS (SELECT {sql.bucket('ts', '1 hour')} AS w, count(*) AS pv_ct FROM p GROUP BY ALL)
SELECT {sql.win('w', '1 hour')}, pv_ct FROM g
WHERE w + INTERVAL '1 hour' <= (SELECT max(ts) FROM p) - INTERVAL '5 seconds'""")
def stream_late_drop(spark, sf):
    """The first half of the month arrives after the second half and is dropped as late."""
    path = scratch_dir(spark, "late")
    texts = feeds.page_texts(feeds.table(spark, sf, "events")).withColumn(
        "late", F.get_json_object("value", "$.ts").cast("bigint") < F.unix_millis(F.lit(SPLIT).cast("timestamp")))
    job = None
    for late in (False, True):
        texts.where(F.col("late") == late).select("value").write.mode("append").text(f"{path}/in")
        raw = topics.raw_text(spark, topics.Topic("page", f"{path}/in"))
        counts = windows.tumble(topics.page_log(raw), [F.count("*").alias("pv_ct")], size="1 hour")
        job = run(spark, counts, "late-drop", path)
    return job


@query("stream_interval_join", f"""
WITH {sql.EVENTS}
SELECT p.event_id AS order_event, c.event_id AS pay_event, p.mid
FROM good p JOIN good c ON p.mid = c.mid AND c.ts BETWEEN p.ts - INTERVAL 1 HOUR AND p.ts + INTERVAL 24 HOUR
WHERE p.kind = 'click' AND c.kind = 'purchase' AND p.has_page AND c.has_page""")
def stream_interval_join(spark, sf):
    def side(page: str, name: str) -> DataFrame:
        return page_stream(spark, sf).where(F.col("page")["page_id"] == page).select(
            F.col("common")["mid"].alias("mid"), F.col("offset").alias(f"{name}_event"),
            F.timestamp_millis("ts").alias(f"{name}_at")).withWatermark(f"{name}_at", windows.LATENESS["sql"])

    both = joins.interval_join(side("payment", "pay"), side("home", "order"), ["mid"], "pay_at", "order_at",
                               3600, 24 * 3600)
    return run(spark, both.select("order_event", "pay_event", "mid"), "interval-join")


@query("stream_uv_daily", f"""
WITH {sql.EVENTS}, p AS (SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY mid ORDER BY ts, event_id) AS last FROM pages)
SELECT mid, ms AS ts, CAST(CASE WHEN last IS NULL OR last <> CAST(ts AS DATE) THEN 1 ELSE 0 END AS BIGINT) AS uv_ct FROM p""")
def stream_uv_daily(spark, sf):
    path = scratch_dir(spark, "uv-daily")
    seen = stores.SeenDays(spark, f"{path}/seen", [T.StructField("mid", T.StringType())])
    views = page_stream(spark, sf).select(F.col("common")["mid"].alias("mid"), "ts", "offset", F.timestamp_millis("ts").alias("row_time"))

    def each(batch, batch_id):
        fresh = seen.add(visitors.day_firsts(batch, ["mid"], ["offset"]), batch_id)
        marked = visitors.with_first(batch, fresh, ["mid"], ["row_time", "offset"], "uv_ct")
        out.plain_batch(f"{path}/out")(marked.select("mid", "ts", "uv_ct"), batch_id)

    Job("uv-daily", lambda _s: views, lambda r: r, lambda r: each_batch(r, each), f"{path}/checkpoint").run(spark)
    return spark.read.schema("mid string, ts bigint, uv_ct bigint").parquet(f"{path}/out").drop("batch_id")


@query("stream_restart", closed(f"""
WITH {sql.EVENTS}, g AS (SELECT {sql.bucket('ts', '1 hour')} AS w, count(*) AS pv_ct FROM pages GROUP BY ALL)
SELECT {sql.win('w', '1 hour')}, pv_ct FROM g""", "5 seconds", size="1 hour"))
def stream_restart(spark, sf):
    """Half of the input, a stop, the other half under the same checkpoint."""
    path = scratch_dir(spark, "restart")
    texts = feeds.page_texts(feeds.table(spark, sf, "events")).withColumn(
        "second", F.get_json_object("value", "$.ts").cast("bigint") >= F.unix_millis(F.lit(SPLIT).cast("timestamp")))
    done = None
    for second in (False, True):
        texts.where(F.col("second") == second).select("value").write.mode("append").text(f"{path}/in")
        raw = topics.raw_text(spark, topics.Topic("page", f"{path}/in"))
        counts = windows.tumble(topics.page_log(raw), [F.count("*").alias("pv_ct")], size="1 hour")
        done = run(spark, counts, "restart", path)
    return done


@query("stream_log_split", jobs.LOG_TOPICS)
def stream_log_split(spark, sf):
    path = scratch_dir(spark, "log-split")
    logs = parse.behaviour_logs(parse.parse_json(feeds.log_texts(feeds.stream(spark, sf, "events")), S.LOG))

    topics_of = fanout.FanOut(spark, f"{path}/topics", logsplit.TOPICS)
    split = lambda batch: {name: logsplit.as_json(name, rows) for name, rows in logsplit.split(batch).items()}
    repaired = firstdays.repair(firstdays.FirstDays(spark, f"{path}/first"), topics_of.writer(split))
    Job("log-split", lambda _s: logs, lambda r: r, lambda r: each_batch(r, repaired), f"{path}/checkpoint").run(spark)
    return jobs.topic_rows({name: topics_of.read(name) for name in logsplit.TOPICS})


@query("stream_traffic", closed(aggregates.traffic_sql("1 hour"), "3 seconds", size="1 hour"))
def stream_traffic(spark, sf):
    return run_batches(spark, page_stream(spark, sf), "traffic", lambda p, w: tables.traffic_batches(spark, p, w, "1 hour"),
                       f"{WINDOW_COLUMNS}, vc string, ch string, ar string, is_new string, uv_ct bigint, sv_ct bigint, pv_ct bigint, dur_sum bigint")


@query("stream_home_detail", closed(aggregates.home_sql("1 hour"), "5 seconds",
                                    of="(SELECT * FROM pages WHERE page_id IN ('home', 'good_detail'))", size="1 hour"))
def stream_home_detail(spark, sf):
    return run_batches(spark, page_stream(spark, sf), "home-detail", lambda p, w: tables.home_detail_batches(spark, p, w, "1 hour"),
                       f"{WINDOW_COLUMNS}, home_uv_ct bigint, good_detail_uv_ct bigint")


@query("stream_login", closed(aggregates.login_sql("1 day"), "5 seconds", size="1 day",
                              of="(SELECT * FROM pages WHERE last_page_id IS NULL OR last_page_id = 'login')"))
def stream_login(spark, sf):
    return run_batches(spark, page_stream(spark, sf), "login", lambda p, w: tables.logins_batches(spark, p, w, "1 day"),
                       f"{WINDOW_COLUMNS}, back_ct bigint, uu_ct bigint")


@query("stream_cart_uu", closed(aggregates.CART_UU, "1 second", "row_time", "(SELECT * FROM lines WHERE l_tax <> 0.08)"))
def stream_cart_uu(spark, sf):
    carts = parse.parse_json(feeds.cart_fact_texts(feeds.stream(spark, sf, "lineitem")), S.fact_schema(S.CART_ADD))
    return run_batches(spark, carts, "cart-uu", lambda p, w: tables.cart_users_batches(spark, p, w), f"{WINDOW_COLUMNS}, cart_add_uu_ct bigint")


@query("stream_register", closed(aggregates.register_sql("1 hour"), "5 seconds", size="1 hour",
                                 of="(SELECT * FROM events WHERE event_type = 'signup' AND CAST(regexp_extract(props, '[0-9]+') AS BIGINT) <> 13)"))
def stream_register(spark, sf):
    facts = parse.parse_json(feeds.register_texts(feeds.stream(spark, sf, "events")), S.strings("create_time", "id"))
    return run(spark, tables.registers_stream(facts, "1 hour"), "register")


@query("stream_keyword", closed(aggregates.KEYWORDS, "5 seconds",
                                of="(SELECT TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * doc_id AS ts FROM documents)"))
def stream_keyword(spark, sf):
    pages = topics.page_log(feeds.document_page_texts(feeds.stream(spark, sf, "documents")))
    return run_batches(spark, pages, "keyword", lambda p, w: tables.keywords_batches(spark, p, w, all_pages=True),
                       f"{WINDOW_COLUMNS}, keyword string, keyword_count bigint")


def late_lines(sf_stream: DataFrame) -> DataFrame:
    return topics.fact_reread(feeds.detail_texts(sf_stream), S.ORDER_DETAIL)


CLOSED_LINES = "w + INTERVAL '10 seconds' <= (SELECT max(row_time) FROM details) - INTERVAL '5 seconds'"


@query("stream_sku_order", f"""
WITH {sql.DETAILS}, {aggregates.DELTAS}, {joining.DIMS},
g AS (SELECT {sql.bucket('row_time')} AS w, sku_id, {aggregates.SKU_SUMS} FROM sku_delta GROUP BY 1, 2)
SELECT {sql.win('w')}, g.sku_id, original_amount, activity_reduce_amount, coupon_reduce_amount, order_amount,
       {joining.chained()} FROM g LEFT JOIN chain ON g.sku_id = chain.sku_id WHERE {CLOSED_LINES}""")
def stream_sku_order(spark, sf):
    """Versions are kept for good, as the batch form does; ``stream_delta_ttl`` forgets them."""
    money = ", ".join(f"{a} decimal(18,2)" for a in windows.SKU_AMOUNTS)
    names = ", ".join(f"{c} string" for c in joining.CHAIN_COLUMNS)
    form = lambda p, w: tables.sku_orders_batches(spark, p, w, lambda: feeds.articles(spark, sf), keep=None)
    return run_batches(spark, late_lines(feeds.stream(spark, sf, "lineitem")), "sku-order", form, f"{WINDOW_COLUMNS}, sku_id string, {money}, {names}")


@query("stream_province_order", f"""
WITH {sql.DETAILS}, {aggregates.DELTAS},
g AS (SELECT {sql.bucket('row_time')} AS w, province_id, CAST(count(DISTINCT order_id) AS BIGINT) AS order_count,
             CAST(sum(tot) AS DOUBLE) AS order_amount FROM prov_delta GROUP BY 1, 2)
SELECT {sql.win('w')}, province_id, n_name AS province_name, order_count, order_amount
FROM g LEFT JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR) AND n_nationkey <> 4 WHERE {CLOSED_LINES}""")
def stream_province_order(spark, sf):
    form = lambda p, w: tables.province_orders_batches(spark, p, w, lambda: feeds.provinces(spark, sf), keep=None)
    return run_batches(spark, late_lines(feeds.stream(spark, sf, "lineitem")), "province-order", form,
                       f"{WINDOW_COLUMNS}, province_id string, order_count bigint, order_amount decimal(18,2), province_name string")


@query("stream_delta_ttl", states.TTL)
def stream_delta_ttl(spark, sf):
    """The stream form of ``delta_ttl``."""
    path = scratch_dir(spark, "delta-ttl")
    rows = late_lines(feeds.stream(spark, sf, "lineitem"))
    each = tables.sku_deltas_batches(spark, path, out.plain_batch(f"{path}/out"), keep=states.KEEP)
    Job("delta-ttl", lambda _s: rows, lambda r: r, lambda r: each_batch(r, each), f"{path}/checkpoint").run(spark)
    return states.delta_columns(spark.read.parquet(f"{path}/out"))
