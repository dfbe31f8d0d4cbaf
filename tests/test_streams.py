import datetime as dt
import json
import os
import random

from conftest import ms, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_visitors import fixed_by_hand, pages, some

from tradepulse import schemas as S
from tradepulse.operators import joins, visitors, windows
from tradepulse.plans import base, trade
from tradepulse.plans import windows as tables
from tradepulse.sinks import keyed
from tradepulse.sinks import topics as out
from tradepulse.sources import topics
from tradepulse.streaming import firstdays, stores
from tradepulse.streaming.jobs import Job, each_batch, late_rows


def feed(df, path, pieces):
    """One text file per piece, in order of event time."""
    ordered = sorted(df.select(F.to_json(F.struct(*df.columns)).alias("value"), "ts").collect(), key=lambda r: r.ts)
    step = -(-len(ordered) // pieces)
    path.mkdir(parents=True, exist_ok=True)
    for n in range(pieces):
        piece = path / f"part-{n}.txt"
        piece.write_text("\n".join(r.value for r in ordered[n * step:(n + 1) * step]) + "\n")
        os.utime(piece, (1_700_000_000 + n, 1_700_000_000 + n))  # files are taken by age


def page_stream(spark, path):
    raw = topics.raw_text(spark, topics.Topic("page", str(path), per_trigger=1))
    return topics.json_table(raw, S.PAGE)


def finish(spark, rows_, path):
    job = Job("t", lambda _s: rows_, lambda r: r, lambda r: out.append_stream(r, f"{path}/out", f"{path}/cp", "parquet"), f"{path}/cp")
    job.run(spark, timeout=300)
    return spark.read.schema(rows_.schema).parquet(f"{path}/out")


def finish_batches(spark, rows_, path, form, **each):
    """Work a stream off by a window form and read what it wrote, batch by batch in one frame."""
    work = form(spark, str(path / "state"), out.window_table_batch(f"{path}/out"), **each)
    job = Job("t", lambda _s: rows_, lambda r: r, lambda r: each_batch(r, work), f"{path}/cp")
    job.run(spark, timeout=300)
    return spark.read.parquet(f"{path}/out").drop("batch_id").withColumn("cur_date", F.col("cur_date").cast("string"))


def test_new_flag_over_several_batches(spark, tmp_path):
    items = some(11, 200)
    feed(pages(spark, items), tmp_path / "in", 3)
    raw = topics.raw_text(spark, topics.Topic("log", str(tmp_path / "in"), per_trigger=1))
    out_rows = lambda r: r.select(F.col("common")["mid"].alias("mid"), "ts", F.col("common")["is_new"].alias("n"))
    store = firstdays.FirstDays(spark, str(tmp_path / "first"), compact_every=2)
    write = firstdays.repair(store, lambda fixed, n: out_rows(fixed).write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={n}"))
    each_batch(topics.json_table(raw, S.LOG), write).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").select("mid", "ts", "n")
    assert sorted(map(tuple, got.collect())) == fixed_by_hand(items)
    assert os.path.exists(tmp_path / "first" / "base")


def test_new_flag_of_a_repeated_batch(spark, tmp_path):
    """A batch that runs again sees what it saw the first time, and not itself."""
    items = some(13, 60)
    store = firstdays.FirstDays(spark, str(tmp_path / "first"))
    seen = []
    each = firstdays.repair(store, lambda fixed, n: seen.append(rows(fixed.select(F.col("common")["mid"], "ts", F.col("common")["is_new"]))))
    logs = pages(spark, items)
    each(logs, 0)
    each(logs, 0)
    assert seen[0] == seen[1] == fixed_by_hand(items)


def closed(batch, items, late):
    return batch.where(F.unix_millis(F.to_timestamp("edt")) <= max(i[4] for i in items) - late)


def test_window_streams_equal_batch_on_closed_windows(spark, tmp_path):
    items = some(12)
    feed(pages(spark, items), tmp_path / "in", 4)
    for name, form, batch, late, size in (("traffic", tables.traffic_batches, tables.traffic, 3000, "1 hour"),
                                          ("home", tables.home_detail_batches, tables.home_detail, 5000, "1 hour"),
                                          ("login", tables.logins_batches, tables.logins, 5000, "1 day")):
        got = finish_batches(spark, page_stream(spark, tmp_path / "in"), tmp_path / name, form, size=size)
        want = closed(batch(pages(spark, items), size), items, late)
        assert rows(got, *want.columns) == rows(want), name


def test_a_device_with_a_third_of_all_rows(spark, tmp_path):
    """Its rows are merged before the shuffle: what the store learns of it is one row a day."""
    start = ms("2024-01-01T00:00:00")
    hot = [("hot" if i % 3 == 0 else f"m{i % 50}", "0", "home", None, start + i * 400) for i in range(3000)]
    feed(pages(spark, hot), tmp_path / "in", 2)
    got = finish_batches(spark, page_stream(spark, tmp_path / "in"), tmp_path, tables.traffic_batches)
    want = closed(tables.traffic(pages(spark, hot)), hot, 3000)
    assert rows(got, *want.columns) == rows(want)
    seen = stores.SeenDays(spark, f"{tmp_path}/state/seen", [T.StructField("mid", T.StringType())])
    assert seen.raw().where("mid = 'hot'").count() == 1


def test_folded_stores_give_the_same(spark, tmp_path):
    """Windows closed and days past leave the tables; results do not change."""
    items = some(14, 150)
    feed(pages(spark, items), tmp_path / "in", 6)
    results = []
    for name, every in (("plain", 100), ("folded", 2)):
        path = tmp_path / name
        work = tables.logins_batches(spark, str(path / "state"), out.window_table_batch(f"{path}/out"), "1 day", compact_every=every)
        Job("t", lambda _s: page_stream(spark, tmp_path / "in"), lambda r: r, lambda r: each_batch(r, work), f"{path}/cp").run(spark, timeout=300)  # noqa: B023
        results.append(rows(spark.read.parquet(f"{path}/out").drop("batch_id")))
    assert results[0] == results[1]
    assert os.path.exists(tmp_path / "folded" / "state" / "seen" / "base")


LINE = ["id", "sku_id", "order_price", "sku_num", "split_total_amount", "split_activity_amount", "split_coupon_amount", "ts"]


def finish_deltas(spark, lines, path, **keep):
    raw = topics.raw_text(spark, topics.Topic("detail", str(path / "in"), per_trigger=1))
    work = tables.sku_deltas_batches(spark, str(path / "state"), lambda r, n: r.write.mode("overwrite").parquet(f"{path}/out/batch_id={n}"), **keep)
    Job("t", lambda _s: topics.fact_reread(raw, LINE), lambda r: r, lambda r: each_batch(r, work), f"{path}/cp").run(spark, timeout=300)
    return spark.read.parquet(f"{path}/out")


def test_sku_deltas_keep_versions_between_batches(spark, tmp_path):
    rnd = random.Random(5)
    start = ms("2024-01-01T00:00:00") // 1000
    items = [(rnd.choice("abc"), rnd.choice("xy"), str(rnd.randint(1, 90)), str(rnd.randint(1, 5)), str(rnd.randint(1, 90)),
              str(rnd.randint(0, 5)), str(rnd.randint(0, 5)), start + t) for t in rnd.sample(range(3000), 60)]
    df = spark.createDataFrame(items, S.fact_schema(LINE))
    feed(df, tmp_path / "in", 3)
    got = finish_deltas(spark, df, tmp_path, keep=None)
    cols = ["id", "sku_id", F.unix_seconds("row_time").alias("ts"), "original_amount", "order_amount"]
    assert rows(got.select(*cols)) == rows(tables.sku_order_deltas(df).select(*cols))


def test_forgotten_versions_start_again(spark, tmp_path):
    """In one batch or in many, a version too old for the next counts no more."""
    start = ms("2024-01-01T00:00:00") // 1000
    line = lambda total, t, i="a": (i, "x", "1", "1", total, "0", "0", start + t)
    df = spark.createDataFrame([line("10", 0), line("11", 30), line("1", 500, "b"), line("1", 600, "b"), line("15", 700), line("16", 731)], S.fact_schema(LINE))
    want = [("a", 1), ("a", 10), ("a", 15), ("a", 16), ("b", 1), ("b", 1)]
    for pieces in (6, 1):
        feed(df, tmp_path / str(pieces) / "in", pieces)
        got = finish_deltas(spark, df, tmp_path / str(pieces))
        assert sorted((r.id, int(r.order_amount)) for r in got.collect()) == want
    assert sorted((r.id, int(r.order_amount)) for r in tables.sku_order_deltas(df, keep="30 seconds").collect()) == want


def test_late_versions_telescope_in_order_of_arrival(spark, tmp_path):
    """An old version that comes in a later batch is what the next one is compared with."""
    schema = S.fact_schema([*LINE])
    line = lambda total, t: ("a", "x", "1", "1", total, "0", "0", 1_704_067_200 + t)
    store, seen = tmp_path / "state", []
    work = tables.sku_deltas_batches(spark, str(store), lambda r, n: seen.append([int(x.order_amount) for x in r.orderBy("row_time").collect()]), keep=None)
    for n, batch in enumerate(([line("10", 0), line("30", 30)], [line("20", 20)], [line("40", 40)])):
        work(topics.fact_reread(spark.createDataFrame(batch, schema).select(F.to_json(F.struct(*LINE)).alias("value")), LINE), n)
    assert seen == [[10, 20], [-10], [20]]


def test_restart_gives_the_same_as_one_run(spark, tmp_path):
    items = some(13, 120)
    feed(pages(spark, items), tmp_path / "all", 4)
    (tmp_path / "in").mkdir()
    one = finish_batches(spark, page_stream(spark, tmp_path / "all"), tmp_path / "one", tables.traffic_batches, size="1 hour")
    for n in range(4):
        (tmp_path / "in" / f"part-{n}.txt").write_text((tmp_path / "all" / f"part-{n}.txt").read_text())
        two = finish_batches(spark, page_stream(spark, tmp_path / "in"), tmp_path / "two", tables.traffic_batches, size="1 hour")
    assert rows(one) == rows(two)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    """What a batch leaves behind is overwritten when it runs again after a failure."""
    items = some(15, 90)
    parts = [items[:50], items[50:]]
    results = []
    for name, runs in (("once", [0, 1]), ("again", [0, 0, 1, 1])):
        path = tmp_path / name
        work = tables.traffic_batches(spark, str(path / "state"), out.window_table_batch(f"{path}/out"), "1 hour")
        for n in runs:
            work(pages(spark, parts[n]), n)
        results.append(rows(spark.read.parquet(f"{path}/out").drop("batch_id")))
    assert results[0] == results[1] and results[0]


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    """The watermark that tells late rows is the one of the batch before."""
    t = ms("2024-01-01T00:00:00")
    item = lambda at: ("m", "0", "home", None, t + at)
    (tmp_path / "in").mkdir()
    for n, at in enumerate((60_000, 90_000, 1_000)):
        feed(pages(spark, [item(at)]), tmp_path / f"f{n}", 1)
        piece = tmp_path / "in" / f"{n}.txt"
        piece.write_text((tmp_path / f"f{n}" / "part-0.txt").read_text())
        os.utime(piece, (1_700_000_000 + n, 1_700_000_000 + n))
    rows_ = windows.tumble(visitors.page_columns(page_stream(spark, tmp_path / "in")).withWatermark("row_time", "3 seconds"),
                           [F.count("*").alias("n")])
    job = Job("late", lambda _s: rows_, lambda r: r, lambda r: out.append_stream(r, f"{tmp_path}/out", f"{tmp_path}/cp", "parquet"),
              f"{tmp_path}/cp")
    query = job.start(spark, available_now=True)
    query.awaitTermination(300)
    assert late_rows(query) == 1
    assert rows(spark.read.schema(rows_.schema).parquet(f"{tmp_path}/out"), "stt", "n") == [("2024-01-01 00:01:00", 1)]


def test_upsert_table(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("ts", T.LongType()), T.StructField("v", T.StringType())])
    store = keyed.UpsertTable(spark, str(tmp_path / "t"), ["id"], ["ts"], schema)
    assert store.read().count() == 0
    batch = lambda *r: spark.createDataFrame(list(r), schema)
    store.write_batch(batch(("a", 1, "a1"), ("a", 2, "a2"), ("b", 1, "b1")), 0)
    store.write_batch(batch(("b", 2, "b2"), ("c", 1, "c1")), 1)
    store.write_batch(batch(("b", 2, "b2"), ("c", 1, "c1")), 1)  # the batch is repeated
    want = [("a", 2, "a2"), ("b", 2, "b2"), ("c", 1, "c1")]
    assert rows(store.read()) == want
    store.compact()
    assert rows(store.read()) == want
    store.write_batch(batch(("a", 1, "late"), ("c", 3, None)).withColumn("deleted", F.col("id") == "c"), 2)
    assert rows(store.read()) == [("a", 2, "a2"), ("b", 2, "b2")]
    store.compact()
    assert rows(store.read()) == [("a", 2, "a2"), ("b", 2, "b2")]


def test_dim_tables(spark, tmp_path):
    store = keyed.DimTables(spark, str(tmp_path / "d"))
    batch = lambda *r: spark.createDataFrame(list(r), keyed.DIM_CHANGE)
    store.write_batch(batch(("1", {"a": "x", "b": "y"}, "insert", 1, 0, "t"), ("2", {"a": "q"}, "insert", 1, 0, "u")), 0)
    store.write_batch(batch(("1", {"a": None, "b": "z"}, "update", 2, 0, "t"), ("2", {}, "delete", 2, 0, "u")), 1)
    assert rows(store.dim("t", ["a", "b"])) == [("1", "x", "z")]
    assert store.read("u").count() == 0
    store.compact()
    store.write_batch(batch(("1", {"b": "new"}, "update", 3, 0, "t"), ("2", {"b": "again"}, "insert", 3, 0, "u")), 2)
    assert rows(store.dim("t", ["a", "b"])) == [("1", "x", "new")]
    assert rows(store.dim("u", ["a", "b"])) == [("2", None, "again")]
    resets = spark.createDataFrame([("t", 2)], "sink_table string, reset_at bigint")
    assert rows(store.dim("t", ["a", "b"], resets)) == [("1", None, "new")]


def test_dim_tables_keep_versions_through_compaction(spark, tmp_path):
    """Late changes, resets and changes of one second read the same before and after."""
    batch = lambda *r: spark.createDataFrame(list(r), keyed.DIM_CHANGE)
    parts = [batch(("1", {"a": "new"}, "insert", 200, 1, "t"), ("2", {"a": "x", "b": "y"}, "insert", 100, 2, "t"),
                   ("3", {"a": "9"}, "insert", 100, 3, "t"), ("4", {"a": "kept"}, "insert", 300, 4, "t")),
             batch(("2", {}, "delete", 200, 5, "t"), ("2", {"a": "back"}, "insert", 200, 6, "t"), ("3", {"a": "1"}, "update", 100, 7, "t")),
             batch(("1", {"a": "late", "b": "other"}, "insert", 100, 0, "t"), ("2", {"b": "late"}, "update", 150, 0, "t"))]
    resets = spark.createDataFrame([("t", 250)], "sink_table string, reset_at bigint")
    read = []
    for compacted in (False, True):
        store = keyed.DimTables(spark, str(tmp_path / str(compacted)))
        for n, part in enumerate(parts):
            store.write_batch(part, n)
            if compacted:
                store.compact()
        read.append((rows(store.dim("t", ["a", "b"])), rows(store.dim("t", ["a", "b"], resets))))
    assert read[0] == read[1] == ([("1", "new", "other"), ("2", "back", None), ("3", "1", None), ("4", "kept", None)], [("4", "kept", None)])


def test_pages_of_a_hot_device_reach_many_tasks(spark):
    """What is left of one device after merging is bounded by windows, not by its rows."""
    start = ms("2024-01-01T00:00:00")
    df = spark.range(20_000).select(
        F.lit("hot").alias("mid"), F.timestamp_millis(F.lit(start) + F.col("id") % 60_000).alias("row_time"),
        F.lit(1).alias("pv_ct"))
    merged = visitors.unique_per_window(df, "mid", "uv_ct", measures=["pv_ct"])
    assert merged.count() == 2
    assert tuple(merged.agg(F.sum("uv_ct"), F.sum("pv_ct")).first()) == (1, 20_000)


def envelopes(spark, path, *batches):
    """One file per batch of (table, type, ts, data, old)."""
    path.mkdir()
    for n, batch in enumerate(batches):
        piece = path / f"part-{n}.txt"
        piece.write_text("\n".join(json.dumps({"database": "shop", "table": t, "type": k, "ts": ts, "data": d, "old": o})
                                   for t, k, ts, d, o in batch) + "\n")
        os.utime(piece, (1_700_000_000 + n, 1_700_000_000 + n))
    return topics.change_envelope(topics.raw_text(spark, topics.Topic("db", str(path), per_trigger=1)))


def test_order_lines_from_a_stream(spark, tmp_path):
    line = lambda i, ts: ("order_detail", "insert", ts, {"id": i, "order_id": "o", "sku_id": "s"}, None)
    order = ("order_info", "insert", 1001, {"id": "o", "user_id": "u", "province_id": "p"}, None)
    activity = ("order_detail_activity", "insert", 1004, {"order_detail_id": "1", "activity_id": "a"}, None)
    coupon = ("order_detail_coupon", "insert", 1002, {"order_detail_id": "2", "coupon_id": "c"}, None)
    late = ("order_detail_coupon", "insert", 1009, {"order_detail_id": "1", "coupon_id": "too late"}, None)
    close = lambda ts: [(t, "insert", ts, {"id": "z", "order_id": "z", "order_detail_id": "z"}, None) for t in
                        ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")]
    changes = envelopes(spark, tmp_path / "in", [line("1", 1000), order, line("2", 1000), line("3", 1000)],
                        [activity, coupon, late], close(5000), close(9000), close(9001))
    got = finish(spark, trade.order_detail_stream(changes), tmp_path)
    assert rows(got.where("id <> 'z'"), "id", "user_id", "activity_id", "coupon_id", "ts") == [
        ("1", "u", "a", None, 1000), ("2", "u", None, "c", 1000), ("3", "u", None, None, 1000)]


def test_dim_sync_from_a_stream_follows_the_config(spark, tmp_path):
    config = "op string, before struct<source_table:string,sink_table:string,sink_columns:string,sink_family:string,sink_row_key:string>, " \
             "after struct<source_table:string,sink_table:string,sink_columns:string,sink_family:string,sink_row_key:string>, ts_ms bigint"
    events = [("r", None, ("sku", "dim_sku", "id,name", "info", "id"), 1)]
    store = keyed.DimTables(spark, str(tmp_path / "dims"))
    changes = envelopes(
        spark, tmp_path / "in",
        [("sku", "bootstrap-insert", 1, {"id": "1", "name": "n", "weight": "5"}, None), ("other", "insert", 1, {"id": "1"}, None)],
        [("sku", "update", 2, {"id": "1", "name": "n2"}, {"name": "n"}), ("sku", "insert", 2, {"id": "2", "name": "m"}, None),
         ("sku", "bootstrap-complete", 2, {}, None)],
        [("sku", "delete", 3, {"id": "2", "name": "m"}, None)])
    write = base.dim_sync_batch(store, lambda: spark.createDataFrame(events, config), "shop")
    each_batch(changes, write).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert rows(store.dim("dim_sku", ["name", "weight"])) == [("1", "n2", None)]


def test_a_batch_is_kept_in_files_while_it_runs(spark, tmp_path):
    """Rows kept by Spark would go to disk unpacked; a window's only directory is read without merging."""
    table = stores.OpenWindows(spark, str(tmp_path), [T.StructField("k", T.StringType())], [T.StructField("n", T.LongType())])
    kept, out = [], []

    def partials(rows, _n):
        kept.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        return rows.select(table.start("row_time").alias("_start"), "k", F.lit(1).cast("bigint").alias("n"))

    def write(closed, _n):
        out.append(("Exchange" in closed._jdf.queryExecution().executedPlan().toString(), {(r.k, r.n) for r in closed.collect()}))

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    each = stores.windowed(table, partials, lambda c: c, write)
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    each(spark.createDataFrame([("a", at(1)), ("a", at(2)), (None, at(3)), ("b", at(12))], "k string, row_time timestamp"), 0)
    each(spark.createDataFrame([("b", at(13)), ("c", at(25))], "k string, row_time timestamp"), 1)
    assert out == [(False, {("a", 2), (None, 1)}), (True, {("b", 2)})]
    assert kept == [before, before] and not list(tmp_path.glob("rows/delta/batch*"))


def test_pages_that_search_nothing_close_keyword_windows(spark, tmp_path):
    """As the watermark of the stream form does, which stands before the filter of searches."""
    search = {"last_page_id": "search", "item_type": "keyword"}
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    some_pages = [({**search, "item": "Red shoe red"}, at(1)), ({**search, "item": "12"}, at(2)), ({"page_id": "home"}, at(16)), (None, at(17))]
    pages_ = spark.createDataFrame(some_pages, "page map<string,string>, row_time timestamp")
    for all_pages, want in ((True, {("red", 2), ("shoe", 1), (None, 1)}), (False, set())):
        path = f"{tmp_path}/{all_pages}"
        tables.keywords_batches(spark, path, out.plain_batch(f"{path}/out"), all_pages=all_pages)(pages_, 0)
        assert {(r.keyword, r.keyword_count) for r in spark.read.parquet(f"{path}/out").collect()} == want


def test_sides_of_a_join_wait_for_each_other(spark, tmp_path):
    """Rows that come in several batches, in any order, meet once; folding lets go of those too old to meet."""
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    pick = random.Random(5)
    columns = "_side int, k string, a bigint, b bigint, row_time timestamp"
    data = [(pick.randint(0, 1), pick.choice(["x", "y", None]), i, i, at(pick.randint(0, 60))) for i in range(40)]
    data = [(s, k, a if s == 0 else None, b if s == 1 else None, t) for s, k, a, b, t in data]
    sides = [T.StructType([f for f in spark.createDataFrame([], columns).schema.fields if f.name in names])
             for names in (("k", "a", "row_time"), ("k", "b", "row_time"))]
    near = lambda left, right: joins.within(left, right, ["k"], 10).select("k", "a", "b")
    want = sorted((k, a, b) for s, k, a, _, t in data for u, m, _, b, v in data
                  if (s, u) == (0, 1) and k is not None and k == m and abs((t - v).total_seconds()) <= 10)
    store, got = stores.JoinedSides(spark, str(tmp_path), sides, 10), []
    for n, some_rows in enumerate((data[:15], [], data[15:30], data[30:])):
        for _ in range(2):  # the batch is repeated
            store.add(spark.createDataFrame(some_rows, columns), n)
            found = [tuple(r) for r in store.joined(n, near).collect()]
        got += found
    assert want and sorted(got) == want
    store.compact()
    assert {r.row_time for r in store.raw().collect()} == {t for *_, t in data if t >= max(t for *_, t in data) - dt.timedelta(seconds=10)}
