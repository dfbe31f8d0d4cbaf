import datetime as dt
import random

from conftest import rows

from tradepulse import functions as fx
from tradepulse.operators import joins, shape, windows


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def test_interval_bounds_are_inclusive(spark):
    anchors = spark.createDataFrame([("k", at(10_000))], "k string, a timestamp")
    points = spark.createDataFrame([("k", at(10_000 + d)) for d in (-901, -900, 0, 5, 6)] + [("other", at(10_000))],
                                   "k string, p timestamp")
    got = joins.interval_join(points, anchors, ["k"], "p", "a", 900, 5)
    assert [r.p for r in got.orderBy("p").collect()] == [at(9_100), at(10_000), at(10_005)]
    assert got.columns == ["k", "p", "a"]


def test_interval_join_agrees_with_all_pairs(spark):
    rnd = random.Random(3)
    a = [(rnd.choice("xyz"), at(rnd.randint(0, 9000)), i) for i in range(80)]
    p = [(rnd.choice("xyz"), at(rnd.randint(0, 9000)), i) for i in range(80)]
    got = joins.interval_join(spark.createDataFrame(p, "k string, p timestamp, pi int"),
                              spark.createDataFrame(a, "k string, a timestamp, ai int"), ["k"], "p", "a", 300, 40)
    want = sorted((x[2], y[2]) for x in p for y in a if x[0] == y[0]
                  and y[1] - dt.timedelta(seconds=300) <= x[1] <= y[1] + dt.timedelta(seconds=40))
    assert sorted((r.pi, r.ai) for r in got.collect()) == want


def test_order_lines_do_not_multiply(spark):
    d = spark.createDataFrame([("1", "o", 1, "old"), ("1", "o", 2, "new"), ("2", "o", 1, "x"), ("3", "none", 1, "x")],
                              "id string, order_id string, ts bigint, sku_id string")
    o = spark.createDataFrame([("o", "u", "p", 1), ("o", "u2", "p2", 2)], "id string, user_id string, province_id string, ts bigint")
    a = spark.createDataFrame([("1", "a1", "r", 1), ("1", "a2", "r", 3)], "id string, activity_id string, activity_rule_id string, ts bigint")
    c = spark.createDataFrame([("2", "c", 1)], "id string, coupon_id string, ts bigint")
    got = joins.order_lines(d, o, a, c)
    assert rows(got, "id", "sku_id", "user_id", "activity_id", "coupon_id", "ts") == [
        ("1", "new", "u2", "a2", None, 2), ("2", "x", "u2", None, "c", 1)]


def test_chain_misses_at_every_hop(spark):
    def dim(cols, *items):
        return spark.createDataFrame(list(items), ", ".join(f"{c} string" for c in cols.split()))

    dims = {
        "dim_sku_info": dim("id category3_id tm_id spu_id sku_name", ("1", "c3", "tm", "sp", "n"), ("2", "gone", "gone", "gone", "n2"),
                            ("3", "c3x", None, None, "n3")),
        "dim_spu_info": dim("id spu_name", ("sp", "spu")),
        "dim_base_category3": dim("id name category2_id", ("c3", "three", "c2"), ("c3x", "threex", "gone")),
        "dim_base_category2": dim("id name category1_id", ("c2", "two", "gone")),
        "dim_base_category1": dim("id name", ("c1", "one")),
        "dim_base_trademark": dim("id tm_name", ("tm", "brand")),
    }
    got = joins.dim_chain(dim("sku_id", ("1",), ("2",), ("3",), ("4",)), dims)
    assert rows(got, "sku_id", "sku_name", "spu_name", "category3_name", "category2_name", "category1_name", "trademark_name") == [
        ("1", "n", "spu", "three", "two", None, "brand"), ("2", "n2", None, None, None, None, None),
        ("3", "n3", None, "threex", None, None, None), ("4", None, None, None, None, None, None)]


def test_inner_and_left_lookup(spark):
    facts = spark.createDataFrame([("1",), ("2",)], "code string")
    dim = spark.createDataFrame([("1", ("one",))], "rowkey string, info struct<dic_name:string>")
    take = {"name": "info.dic_name"}
    assert rows(joins.lookup(facts, dim, "code", "rowkey", take, "inner")) == [("1", "one")]
    assert rows(joins.lookup(facts, dim, "code", "rowkey", take)) == [("1", "one"), ("2", None)]


def test_cached_dims_are_read_again_after_their_time(spark):
    loads = []

    def load(session, name):
        loads.append(name)
        return session.createDataFrame([(len(loads),)], "n int")

    dims = joins.CachedDims(spark, load, ttl=60)
    assert [dims.get("d").first().n, dims.get("d").first().n] == [1, 1]
    dims.invalidate("d")
    assert dims.get("d").first().n == 2
    assert joins.CachedDims(spark, load, ttl=0).get("d").first().n == 3


def test_orders_count_once_per_window(spark):
    df = spark.createDataFrame([("p", "o1", at(1), 1.0), ("p", "o1", at(2), 2.0), ("p", "o2", at(3), 1.0), ("p", "o1", at(11), None)],
                               "province_id string, order_id string, row_time timestamp, order_amount double")
    got = windows.province_orders(df.withColumn("order_amount", fx.money("order_amount")))
    assert [(r.stt[-2:], r.order_count, r.order_amount and float(r.order_amount)) for r in got.orderBy("stt").collect()] == [
        ("00", 2, 4.0), ("10", 1, None)]


def test_keywords(spark):
    df = spark.createDataFrame([("Rote SCHUHE, rote Öfen 42",), ("123",), (None,)], "t string")
    got = df.select(fx.keywords("t").alias("k"))
    assert sorted(str(r.k) for r in got.collect()) == ["None", "None", "rote", "rote", "schuhe", "öfen"]


def test_kw_split_from_sql(spark):
    fx.text.register_kw_split(spark)
    spark.createDataFrame([("Red shoe",), ("7",)], "t string").createOrReplaceTempView("searches")
    got = spark.sql("SELECT t, keyword FROM searches LEFT JOIN LATERAL kw_split(t) ON true")
    assert rows(got) == [("7", None), ("Red shoe", "red"), ("Red shoe", "shoe")]


def test_snake_lines_hide_fields(spark):
    df = spark.createDataFrame([("p", 3, "secret")], "provinceId string, orderCount bigint, orderIdSet string")
    assert rows(shape.json_lines(df, hidden=["orderIdSet"])) == [('{"province_id":"p","order_count":3}',)]
    assert shape.to_camel(spark.createDataFrame([(1,)], "sink_row_key int")).columns == ["sinkRowKey"]
