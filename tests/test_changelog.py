import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradepulse.operators import changelog, routing

CHANGE = "table string, type string, data map<string,string>, old map<string,string>, ts bigint"


def changes(spark, *items):
    return spark.createDataFrame([("t", *i, n) for n, i in enumerate(items)], CHANGE)


def test_transition_needs_a_touched_field(spark):
    df = changes(spark, ("update", {"s": "9", "id": "1"}, {"s": "8"}), ("update", {"s": "9", "id": "2"}, {"x": "1"}),
                 ("update", {"s": "7", "id": "3"}, {"s": "8"}), ("insert", {"s": "9", "id": "4"}, None),
                 ("update", {"s": "9", "id": "5"}, None))
    assert rows(changelog.transition(df, "t", "s", "9", ["id"])) == [("1",)]
    assert rows(changelog.transition(df, "t", "s", "9", ["id"], require_change=False)) == [("1",), ("2",), ("5",)]


def test_increments(spark):
    df = changes(spark, ("insert", {"n": "3"}, None), ("update", {"n": "5"}, {"n": "2"}), ("update", {"n": "2"}, {"n": "5"}),
                 ("update", {"n": "2"}, {"n": "2"}), ("update", {"n": "2"}, {"x": "1"}), ("update", {"n": "many"}, {"n": "1"}),
                 ("delete", {"n": "3"}, None), ("insert", {"n": "many"}, None))
    assert rows(changelog.increments(df, "t", "n", ["n"], keep=["ts"])) == [("3", 0), ("3", 1), ("many", 7)]


def test_latest_by_key_is_total(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None)], "id string, v int, c string")
    assert rows(changelog.latest_by_key(df, ["id"], ["v"])) == [("a", 2, "z"), ("b", 1, None)]


PUTS = [(1, "k", "put", "a1", "b1"), (2, "k", "put", None, "b2"),
        (3, "g", "put", "a", "b"), (4, "g", "delete", None, None),
        (5, "r", "put", "a", "b"), (6, "r", "delete", None, None), (7, "r", "put", None, "new")]


def test_fold_cells(spark):
    df = spark.createDataFrame(PUTS, "v int, k string, type string, a string, b string")
    assert rows(changelog.fold_cells(df, ["k"], ["a", "b"], "v")) == [("k", "a1", "b2"), ("r", None, "new")]


def folded_by_hand(items):
    table = {}
    for _v, k, kind, *cells in sorted(items):
        if kind == "delete":
            table.pop(k, None)
        else:
            row = table.setdefault(k, [None, None])
            for i, c in enumerate(cells):
                row[i] = c if c is not None else row[i]
    return {k: tuple(v) for k, v in table.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_folds_agree_with_the_walk(spark, seed):
    rnd = random.Random(seed)
    items = [(v, rnd.choice("abcd"), rnd.choice(["put", "put", "put", "delete"]), rnd.choice([None, f"x{v}"]),
              rnd.choice([None, f"y{v}"])) for v in range(80)]
    want = folded_by_hand(items)
    df = spark.createDataFrame(items, "v int, k string, type string, a string, b string")
    got = {r.k: (r.a, r.b) for r in changelog.fold_cells(df, ["k"], ["a", "b"], "v").collect()}
    want = {k: v for k, v in want.items() if v != (None, None)}  # no cells, no row
    assert got == want
    maps = df.withColumn("data", F.create_map(F.lit("a"), "a", F.lit("b"), "b"))
    as_map = {r.k: (r.data.get("a"), r.data.get("b")) for r in changelog.fold_cell_maps(maps, ["k"], "v").collect()}
    assert as_map == want


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_deltas_do_not_depend_on_the_slices(spark, width):
    rnd = random.Random(width)
    items = [(rnd.choice(["hot", "hot", "hot", "a", "b"]), n, rnd.choice([None, str(rnd.randint(0, 500))])) for n in range(200)]
    df = spark.createDataFrame(items, "id string, n int, amount string")
    got = changelog.version_deltas(df, ["id"], ["n"], ["amount"], F.floor(F.col("n") / width))
    state, want = {}, []
    for key, n, amount in items:
        now = int(amount or 0)
        want.append((key, n, now - state.get(key, 0)))
        state[key] = now
    assert sorted((r.id, r.n, int(r.amount)) for r in got.collect()) == sorted(want)
    total = {r.id: int(r.s) for r in got.groupBy("id").agg(F.sum("amount").alias("s")).collect()}
    assert total == state


CONFIG = "op string, before struct<source_table:string,sink_table:string,sink_family:string,sink_columns:string>, " \
         "after struct<source_table:string,sink_table:string,sink_family:string,sink_columns:string>, ts_ms bigint"


def cfg(table, columns="id"):
    return (table, f"sink_{table}", "info", columns)


EVENTS = [("r", None, cfg("a"), 1), ("c", None, cfg("b"), 2), ("u", cfg("a"), cfg("a", "id,x"), 3),
          ("d", cfg("b"), None, 4), ("c", None, cfg("old"), 5), ("u", cfg("old"), cfg("moved"), 6)]


def test_current_config(spark):
    steps = changelog.config_steps(spark.createDataFrame(EVENTS, CONFIG), ["source_table"], "ts_ms")
    now = changelog.current_config(steps, ["source_table"], "ts_ms")
    assert rows(now, "source_table", "sink_columns") == [("a", "id,x"), ("moved", "id")]
    life = routing.table_lifecycle(steps, "ts_ms")
    assert rows(life, "sink_table", "state") == [("sink_a", "reset"), ("sink_b", "dropped"), ("sink_moved", "reset"),
                                                 ("sink_old", "dropped")]


def test_snapshot_lies_before_every_change(spark):
    steps = changelog.config_steps(spark.createDataFrame(EVENTS, CONFIG), ["source_table"], "ts_ms")
    snapshot = spark.createDataFrame([cfg("b", "stale"), cfg("only", "kept")],
                                     "source_table string, sink_table string, sink_family string, sink_columns string")
    both = steps.unionByName(changelog.snapshot_steps(snapshot, "ts_ms"))
    now = changelog.current_config(both, ["source_table"], "ts_ms")
    assert rows(now, "source_table", "sink_columns") == [("a", "id,x"), ("moved", "id"), ("only", "kept")]
    assert rows(routing.table_resets(steps, "ts_ms")) == [("sink_a", 3), ("sink_b", 4), ("sink_moved", 6), ("sink_old", 6)]


def test_config_in_force_at_the_time_of_the_row(spark):
    steps = changelog.config_steps(spark.createDataFrame(EVENTS, CONFIG), ["source_table"], "ts_ms")
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("a", 3), ("b", 3), ("b", 4), ("old", 5), ("old", 6),
                                ("moved", 6), ("unknown", 9)], "table string, ts bigint")
    got = routing.in_force(df, steps, ["source_table"], ["table"], "ts_ms", "ts")
    assert rows(got, "table", "ts", "cfg_sink_columns") == [
        ("a", 1, "id"), ("a", 2, "id"), ("a", 3, "id,x"), ("b", 3, "id"), ("moved", 6, "id"), ("old", 5, "id")]


def test_projection_and_destination(spark):
    df = spark.createDataFrame([({"id": "1", "x": "2", "y": "3"}, "id,y,absent", "dest")],
                               "data map<string,string>, cfg_sink_columns string, cfg_sink_table string")
    row = routing.tag_destination(routing.project_fields(df)).first()
    assert (row.sink_table, json.loads(row.value)) == ("dest", {"id": "1", "y": "3"})


def test_changes_of_one_second_apply_in_order_of_arrival(spark):
    """Status 9, then 1; a row deleted and put again; in each case the order contradicts the values."""
    df = spark.createDataFrame([("s", 100, 1, "insert", {"a": "9"}), ("s", 100, 2, "update", {"a": "1"}), ("d", 100, 1, "insert", {"a": "old"}),
                                ("d", 200, 3, "delete", {}), ("d", 200, 4, "insert", {"a": "new"}), ("g", 200, 5, "insert", {"a": "x"}), ("g", 200, 6, "delete", {})],
                               "k string, ts bigint, pos bigint, type string, data map<string,string>")
    want = [("d", "new"), ("s", "1")]
    assert rows(changelog.fold_cell_maps(df, ["k"], ["ts", "pos"]).select("k", F.col("data")["a"])) == want
    flat = df.withColumn("a", F.col("data")["a"])
    assert rows(changelog.fold_cells(flat, ["k"], ["a"], ["ts", "pos"])) == want
    assert rows(changelog.latest_by_key(flat.drop("data").where("k = 's'"), ["k"], ["ts", "pos"]), "a") == [("1",)]
    pruned = changelog.prune_cell_maps(df, ["k"], ["ts", "pos"])
    assert rows(changelog.fold_cell_maps(pruned, ["k"], ["ts", "pos"]).select("k", F.col("data")["a"])) == want


def test_lower_amount_of_the_same_second_counts_last(spark):
    from tradepulse.plans import windows as tables

    df = spark.createDataFrame([("l", "s", "100", "1", "100", "0", "0", 1000, 1), ("l", "s", "80", "1", "80", "0", "0", 1000, 2)],
                               "id string, sku_id string, order_price string, sku_num string, split_total_amount string, "
                               "split_activity_amount string, split_coupon_amount string, ts bigint, pos bigint")
    assert float(tables.sku_order_deltas(df).agg(F.sum("order_amount")).first()[0]) == 80.0


def test_config_in_force_with_epoch_times_slices_and_snapshot(spark):
    """Seconds against milliseconds, a config carried over many slices, and what held before the first change."""
    start = 1_704_067_200
    steps = spark.createDataFrame([("c", (start + 10) * 1000, "t", "one"), ("u", (start + 100_000) * 1000, "t", "two"), ("d", (start + 200_000) * 1000, "t", None),
                                   ("c", (start + 5) * 1000, "other", "x")], "op string, ts_ms bigint, source_table string, sink_columns string")
    df = spark.createDataFrame([("t", start + at) for at in (0, 9, 10, 11, 99_999, 100_000, 150_000, 199_999, 200_000, 900_000)] + [("no", start)], "table string, ts bigint")
    at = F.col("ts") * 1000
    got = routing.in_force(df, steps, ["source_table"], ["table"], "ts_ms", at)
    assert rows(got.select(F.col("ts") - start, "cfg_sink_columns")) == sorted(
        [(10, "one"), (11, "one"), (99_999, "one"), (100_000, "two"), (150_000, "two"), (199_999, "two")], key=lambda t: tuple(map(str, t)))
    before = steps.unionByName(changelog.snapshot_steps(spark.createDataFrame([("t", "zero")], "source_table string, sink_columns string"), "ts_ms"))
    early = routing.in_force(df, before, ["source_table"], ["table"], "ts_ms", at).where(F.col("ts") < start + 10)
    assert rows(early, "cfg_sink_columns") == [("zero",), ("zero",)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_index_and_slices_find_the_same_config(spark, seed):
    """Binary search in a broadcast history beside slices of time and a walk through both."""
    rnd = random.Random(seed)
    steps = [(rnd.choice("cud"), rnd.randrange(400), rnd.choice("abc"), f"v{n}") for n in range(60)]
    asked = [(rnd.choice(["a", "b", "c", "no", None]), rnd.choice([rnd.randrange(-20, 450), None]), n) for n in range(300)]
    told = spark.createDataFrame([*steps, ("c", None, "a", "no time"), ("c", 5, None, "no key")], "op string, ts_ms bigint, source_table string, v string")
    df = spark.createDataFrame(asked, "table string, ts bigint, n int")
    want = []
    for table, ts, n in asked:
        known = [(t, op != "d", v) for op, t, key, v in steps if key == table and ts is not None and t <= ts]
        if known and max(known, key=lambda s: s[:2])[1]:
            last = max(known, key=lambda s: s[:2])[:2]
            want.append((n, max((ts_, v) for t, alive, v in known for ts_ in [t] if (t, alive) == last)[1]))
    for more in ({}, {"index_bytes": 0, "slice_by": 7}):
        got = routing.in_force(df, told, ["source_table"], ["table"], "ts_ms", "ts", **more)
        assert sorted((r.n, r.cfg_v) for r in got.collect()) == sorted(want), more


def test_changes_stay_where_they_are(spark):
    """Beside a small history no row of the change side is shuffled or sorted."""
    steps = spark.createDataFrame([("c", 1, "t", "one")], "op string, ts_ms bigint, source_table string, v string")
    df = spark.range(1000).select(F.lit("t").alias("table"), F.col("id").alias("ts"), F.lit("payload").alias("load"))
    plan = routing.in_force(df, steps, ["source_table"], ["table"], "ts_ms", "ts")._jdf.queryExecution().executedPlan().toString()
    head = plan[:plan.index("BroadcastExchange")] + plan[plan.index("Range"):] if plan.index("Range") > plan.index("BroadcastExchange") else plan[:plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in head and "Window" not in plan
