"""Tables beside the jobs: one commit for many topics, corrected joins, tables created anew, config snapshots."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.operators import changelog
from tradepulse.plans import base, live
from tradepulse.sinks import fanout, keyed, topics as out
from tradepulse.sources import tables, topics
from tradepulse.streaming.jobs import Job, each_batch
from tradepulse.streaming.views import OrderDetails, WideDimension

# -- one commit for several topics ----------------------------------------------------------


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_a_batch_that_dies_between_topics_is_seen_by_nobody(spark, tmp_path):
    store = fanout.FanOut(spark, str(tmp_path), ["a", "b", "c", "d", "e"])
    store.write_batch({n: texts(spark, f"{n}0") for n in "abcde"}, 0)

    class Dies(dict):
        def __getitem__(self, name):
            if name == "c":
                raise RuntimeError("lost after two of five")
            return super().__getitem__(name)

    with pytest.raises(RuntimeError):
        store.write_batch(Dies({n: texts(spark, f"{n}1", "half") for n in "abde"}), 1)
    assert store.committed() == [0]
    assert {n: rows(store.read(n)) for n in "abcde"} == {n: [(f"{n}0",)] for n in "abcde"}
    for _ in range(2):  # the retry, and a repetition after the commit
        store.write_batch({n: texts(spark, f"{n}1") for n in "abcde"}, 1)
        assert {n: rows(store.read(n)) for n in "abcde"} == {n: [(f"{n}0",), (f"{n}1",)] for n in "abcde"}
    assert rows(store.read("a", [1, 7])) == [("a1",)]


def test_followers_take_committed_batches_once(spark, tmp_path):
    store, seen = fanout.FanOut(spark, str(tmp_path / "t"), ["a", "b"]), []
    for n in range(2):
        store.write_batch({"a": texts(spark, f"a{n}"), "b": texts(spark, f"b{n}")}, n)
        texts(spark, "half").write.text(f"{tmp_path}/t/a/batch_id={n + 5}")  # no commit tells of it
        follow = store.following("a", lambda r, _n: seen.append(rows(r)))
        Job("f", lambda _s: store.commits(), lambda r: r, lambda r: each_batch(r, follow), f"{tmp_path}/cp").run(spark)  # noqa: B023
    assert seen == [[("a0",)], [("a1",)]]


def test_written_batches_may_be_repeated(spark, tmp_path):
    for n, v in ((0, "x"), (1, "y"), (1, "y")):
        out.write_text(texts(spark, v), f"{tmp_path}/text", n)
        out.write_routed(texts(spark, v).withColumn("sink_table", F.lit("s")), f"{tmp_path}/routed", n)
    assert rows(spark.read.text(f"{tmp_path}/text"), "value") == rows(spark.read.text(f"{tmp_path}/routed"), "value") == [("x",), ("y",)]


def test_folded_deltas_go_with_the_second_fold(spark, tmp_path):
    """The directories of a table stay few; what the last base was made of stays for its readers."""
    store = keyed.UpsertTable(spark, str(tmp_path), ["id"], ["ts"], S.fact_schema(["id", "ts"]))
    for n in range(6):
        store.write_batch(spark.createDataFrame([(f"k{n}", n), ("all", n)], "id string, ts bigint"), n)
        if n in (1, 3, 5):
            store.compact()
    assert store._committed("base") == [3, 5] and store._committed("delta") == [4, 5]
    assert rows(store.read()) == [("all", 5), *[(f"k{n}", n) for n in range(6)]]


# -- corrected joins ---------------------------------------------------------------------------

def change(spark, *items):
    values = [(t, k, ts, pos, d) for pos, (t, k, ts, d) in enumerate(items)]
    df = spark.createDataFrame(values, "table string, type string, ts bigint, pos bigint, data map<string,string>")
    return df.withColumn("old", F.lit(None).cast("map<string,string>"))


def line(i, ts, order="o", sku="s"):
    return ("order_detail", "insert", ts, {"id": i, "order_id": order, "sku_id": sku})


def test_order_lines_come_early_and_are_corrected(spark, tmp_path):
    view = OrderDetails(spark, str(tmp_path), compact_every=2)
    order = ("order_info", "insert", 1, {"id": "o", "user_id": "u", "province_id": "p"})
    late = ("order_detail_activity", "insert", 3600, {"order_detail_id": "1", "activity_id": "a", "activity_rule_id": "r"})
    shown = lambda: rows(view.read(), "id", "sku_id", "user_id", "activity_id")
    log = lambda n: rows(view.changelog(n), "id", "activity_id", "deleted")
    view.write_batch(change(spark, line("1", 5), line("2", 5, "unknown")), 0)
    assert shown() == []  # no order yet
    view.write_batch(change(spark, order), 1)
    assert shown() == [("1", "s", "u", None)] and log(1) == [("1", None, False)]
    for _ in range(2):  # the batch is repeated
        view.write_batch(change(spark, late), 2)
        assert shown() == [("1", "s", "u", "a")] and log(2) == [("1", "a", False)]
    # an older version of the line comes late and changes nothing; a newer one moves it to an order nobody knows
    view.write_batch(change(spark, line("1", 4, sku="old")), 3)
    assert shown() == [("1", "s", "u", "a")]
    view.write_batch(change(spark, line("1", 9, "unknown")), 4)
    assert shown() == [] and log(4) == [("1", None, True)]
    view.write_batch(change(spark, ("order_info", "insert", 1, {"id": "unknown", "user_id": "v", "province_id": "p"})), 5)
    assert shown() == [("1", "s", "v", "a"), ("2", "s", "v", None)]


def test_versions_of_one_second_in_order_of_arrival(spark):
    """The larger value came first; what came last counts."""
    from tradepulse.plans import trade

    changes = change(spark, ("order_detail", "insert", 7, {"id": "1", "order_id": "o", "sku_id": "s", "order_price": "90"}),
                     ("order_info", "insert", 7, {"id": "o", "user_id": "u9", "province_id": "p"}), ("order_info", "insert", 7, {"id": "o", "user_id": "u1", "province_id": "p"}),
                     ("order_detail", "insert", 7, {"id": "1", "order_id": "o", "sku_id": "s", "order_price": "10"}))
    assert rows(trade.order_detail(changes), "id", "order_price", "user_id") == [("1", "10", "u1")]


# -- tables dropped and created anew -----------------------------------------------------------

CFG = "struct<source_table:string,sink_table:string,sink_columns:string,sink_family:string,sink_row_key:string>"
EVENT = f"op string, before {CFG}, after {CFG}, ts_ms bigint"
SKU = ("sku", "dim_sku", "id,name", "info", "id")


def puts(spark, *items):
    df = spark.createDataFrame([("shop", "sku", "insert", ts, {"id": i, "name": n}, {}, pos) for pos, (i, n, ts) in enumerate(items)],
                               "database string, table string, type string, ts bigint, data map<string,string>, old map<string,string>, pos bigint")
    return df


@pytest.mark.parametrize("compacted", [False, True])
def test_a_dropped_table_starts_empty(spark, tmp_path, compacted):
    events = [("c", None, SKU, 1_000), ("d", SKU, None, 20_500), ("c", None, SKU, 30_000)]
    config = lambda: spark.createDataFrame(events, EVENT)
    store = keyed.DimTables(spark, str(tmp_path))
    write = base.dim_sync_batch(store, config, "shop")
    parts = [puts(spark, ("1", "before", 10), ("2", "gone", 20)), puts(spark, ("3", "no table", 25), ("1", "after", 30)), puts(spark, ("4", "late, before the drop", 15))]
    for n, part in enumerate(parts):
        write(part, n)
        if compacted:
            store.compact()
    assert rows(store.dim("dim_sku", ["name"])) == [("1", "after")]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert rows(base.dim_sync(whole, config(), "shop").select("row_key", F.col("data")["name"])) == [("1", "after")]


def test_a_reset_after_compaction_still_counts(spark, tmp_path):
    store = keyed.DimTables(spark, str(tmp_path))
    put = lambda *r: spark.createDataFrame(list(r), keyed.DIM_CHANGE)
    store.write_batch(put(("1", {"a": "old"}, "insert", 5, 0, "t"), ("1", {"a": "other"}, "insert", 5, 0, "u")), 0)
    store.compact()
    store.write_batch(put((None, None, changelog.RESET, 6, 0, "t"), ("2", {"a": "same moment"}, "insert", 6, 0, "t")), 1)
    assert rows(store.dim("t", ["a"])) == [("2", "same moment")] and rows(store.dim("u", ["a"])) == [("1", "other")]
    store.compact()
    store.write_batch(put(("3", {"a": "late"}, "insert", 5, 0, "t")), 2)
    assert rows(store.dim("t", ["a"])) == [("2", "same moment")]


# -- the wide article dimension ------------------------------------------------------------------

def test_wide_dimension_follows_changes_of_any_level(spark, tmp_path):
    dims = keyed.DimTables(spark, str(tmp_path / "dims"))
    wide = WideDimension(dims, str(tmp_path / "wide"))
    put = lambda table, key, version=1, kind="insert", **cells: (key, {"id": key, **cells}, kind, version, 0, table)
    batches = [
        [put("dim_sku_info", "1", category3_id="c3", tm_id="tm", spu_id="sp", sku_name="one"), put("dim_sku_info", "2", category3_id="c3x", sku_name="two"),
         put("dim_base_category3", "c3", name="three", category2_id="c2"), put("dim_base_category3", "c3x", name="threex", category2_id="c2x"),
         put("dim_base_category2", "c2", name="two", category1_id="c1"), put("dim_base_category1", "c1", name="one"), put("dim_spu_info", "sp", spu_name="spu")],
        [put("dim_base_category1", "c1", 2, name="new name"), put("dim_base_trademark", "tm", 2, tm_name="brand")],
        [put("dim_base_category3", "c3x", 3, category2_id="c2")],
        [put("dim_sku_info", "1", 4, "delete")],
        [(None, None, changelog.RESET, 5, 0, "dim_base_category2")],
    ]
    names = ["sku_id", "category2_name", "category1_name", "trademark_name", "spu_name"]
    want = [[("1", "two", "one", None, "spu"), ("2", None, None, None, None)], [("1", "two", "new name", "brand", "spu"), ("2", None, None, None, None)],
            [("1", "two", "new name", "brand", "spu"), ("2", "two", "new name", None, None)], [("2", "two", "new name", None, None)], [("2", None, None, None, None)]]
    for n, batch in enumerate(batches):
        for _ in range(2):  # each batch is repeated
            dims.write_batch(spark.createDataFrame(batch, keyed.DIM_CHANGE), n)
            wide.update(n)
            assert rows(wide.read(), *names) == want[n], n
    assert wide.table._scan("delta", [2]).count() == 1  # only what a batch concerns is worked out


# -- config snapshot -----------------------------------------------------------------------------

def test_snapshot_and_changes_without_gap_or_repeat(spark):
    other = ("other", "dim_other", "id", "info", "id")
    events = spark.createDataFrame([("c", None, SKU, 10), ("u", SKU, ("sku", "dim_sku", "id", "info", "id"), 20), ("d", other, None, 30)], EVENT)
    snapshot = spark.createDataFrame([SKU[:2] + ("id",) + SKU[3:], other], S.DIM_CONFIG)
    got = tables.snapshot_then_changes(snapshot, events, 20)
    assert rows(got.select("op", "ts_ms", F.coalesce("after.source_table", "before.source_table"))) == [
        ("d", 30, "other"), ("r", 20, "other"), ("r", 20, "sku")]


def test_what_the_snapshot_holds_is_not_applied_again(spark):
    """A delete that the snapshot knows of does not end the config it was followed by."""
    events = spark.createDataFrame([("d", SKU, None, 5_000), ("c", None, SKU, 6_000), ("d", SKU, None, 60_000)], EVENT)
    snapshot = spark.createDataFrame([SKU], S.DIM_CONFIG)
    feed = puts(spark, ("1", "early", 2), ("2", "between", 5), ("3", "later", 50), ("4", "ended", 60))
    got = base.dim_changes(feed, events, "shop", snapshot=snapshot, position=7_000).where("type <> 'reset'")
    assert rows(got, "row_key") == [("1",), ("2",), ("3",)]
    assert rows(base.dim_changes(feed, events, "shop").where("type <> 'reset'"), "row_key") == [("3",)]


# -- the jobs ------------------------------------------------------------------------------------

def test_there_are_eighteen_jobs(spark, tmp_path):
    empty = lambda: None
    shop = live.Shop(str(tmp_path), topics.Topic("log", "log"), topics.Topic("db", "db"), "shop", empty, empty, empty, empty, dict)
    jobs = {name: build(spark, shop) for name, build in live.JOBS.items()}
    assert len(jobs) == 18 and all(isinstance(j, Job) for j in jobs.values())
    assert len({j.checkpoint for j in jobs.values()}) == 18


def test_order_lines_leave_nothing_behind_but_their_tables(spark, tmp_path):
    """What a batch parses is kept in files while it runs, not by Spark, and sides without changes are not written."""
    view = OrderDetails(spark, str(tmp_path))
    order = ("order_info", "insert", 1, {"id": "o", "user_id": "u", "province_id": "p"})
    other = ("order_info", "update", 2, {"id": "o", "user_id": "v", "province_id": "p"})
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    held = []
    land = view._landed
    view._landed = lambda changes, n: held.append(land(changes, n)) or held[-1]
    view.write_batch(change(spark, line("1", 5), line(None, 5), order, other), 0)
    view.write_batch(change(spark, line("1", 6, sku="t"), other), 1)
    assert rows(view.read(), "id", "sku_id", "user_id") == [("1", "t", "u")]
    assert len(held) == 2 and spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    assert not list(tmp_path.glob("fresh/*")) and view.sides["orders"]._committed("delta") == [0]
    assert view.sides["coupons"]._committed("delta") == [] and list(tmp_path.glob("result/delta/*/*.zstd.parquet"))
