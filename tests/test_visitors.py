"""The closed forms against a walk through the rows, as a stateful job would do it."""

import datetime as dt
import random

import pytest
from conftest import ms, rows
from pyspark.sql import functions as F

from tradepulse.operators import parse, visitors
from tradepulse.plans import windows as tables

PAGE = "common map<string,string>, page map<string,string>, ts bigint"


def day(t):
    return t // 86_400_000


def pages(spark, items):
    return spark.createDataFrame(
        [({"mid": m, "uid": m, "is_new": n, "vc": "1", "ch": "2", "ar": "3"},
          {"page_id": p, "last_page_id": l, "during_time": "10"}, t) for m, n, p, l, t in items], PAGE)


def some(seed, n=300):
    rnd = random.Random(seed)
    start = ms("2024-01-01T00:00:00")
    times = rnd.sample(range(12 * 86_400), n)
    items = [(rnd.choice(["hot", "hot", "a", "b", "c"]), rnd.choice(["0", "1", "1", "2"]),
              rnd.choice(["home", "good_detail", "cart"]), rnd.choice([None, "login", "home"]), start + 1000 * t) for t in times]
    return items


def fixed_by_hand(items):
    state, out = {}, []
    for m, n, _p, _l, t in sorted(items, key=lambda i: i[4]):
        if n == "1":
            state.setdefault(m, day(t))
            out.append((m, t, "0" if state[m] != day(t) else "1"))
        else:
            if n == "0":
                state.setdefault(m, day(t) - 1)
            out.append((m, t, n))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_new_flag(spark, seed):
    items = some(seed)
    got = visitors.repair_new_flag(pages(spark, items)).select(F.col("common")["mid"], "ts", F.col("common")["is_new"])
    assert sorted(map(tuple, got.collect())) == fixed_by_hand(items)


def test_new_flag_edges(spark):
    a, b, c = ms("2024-01-01T10:00:00"), ms("2024-01-01T12:00:00"), ms("2024-01-02T09:00:00")
    items = [("x", "1", "p", None, a), ("x", "1", "p", None, b), ("x", "1", "p", None, c),
             ("y", "0", "p", None, a), ("y", "1", "p", None, b), ("z", "2", "p", None, a), ("z", "1", "p", None, c)]
    got = visitors.repair_new_flag(pages(spark, items)).select(F.col("common")["mid"], "ts", F.col("common")["is_new"])
    assert sorted(map(tuple, got.collect())) == sorted([
        ("x", a, "1"), ("x", b, "1"), ("x", c, "0"), ("y", a, "0"), ("y", b, "0"), ("z", a, "2"), ("z", c, "1")])


@pytest.mark.parametrize("seed", [4, 5])
def test_daily_first_and_traffic_agree(spark, seed):
    items = some(seed)
    flat = visitors.page_columns(pages(spark, items))
    got = visitors.flag_daily_first(flat, ["mid"], ["ts"], "uv_ct")
    last, want = {}, []
    for m, _n, _p, _l, t in sorted(items, key=lambda i: i[4]):
        want.append((m, t, int(last.get(m) != day(t))))
        last[m] = day(t)
    assert sorted(map(tuple, got.select("mid", "ts", "uv_ct").collect())) == sorted(want)
    table = tables.traffic(pages(spark, items), "1 hour")
    sums = table.agg(F.sum("uv_ct"), F.sum("pv_ct"), F.sum("sv_ct"), F.sum("dur_sum")).first()
    assert tuple(sums) == (sum(w[2] for w in want), len(items), sum(i[3] is None for i in items), 10 * len(items))
    assert table.where("uv_ct > pv_ct").count() == 0


def test_order_of_rows_does_not_matter(spark):
    items = some(6)
    shuffled = items[:]
    random.Random(0).shuffle(shuffled)
    assert rows(tables.traffic(pages(spark, items))) == rows(tables.traffic(pages(spark, shuffled)))


def test_two_pages_count_apart(spark):
    items = some(7)
    got = visitors.home_detail_uniques(visitors.page_columns(parse.home_and_detail(pages(spark, items))))
    want = {(m, p == "home", day(t)) for m, _n, p, _l, t in items if p in ("home", "good_detail")}
    assert got.agg(F.sum("home_uv_ct"), F.sum("good_detail_uv_ct")).first() == (
        sum(h for _m, h, _d in want), sum(not h for _m, h, _d in want))


def test_returning_needs_more_than_seven_days_after_midnight(spark):
    first = ms("2024-01-01T15:00:00")
    limit = ms("2024-01-08T00:00:00")
    items = [("exact", "0", "p", None, first), ("exact", "0", "p", None, limit),
             ("late", "0", "p", "login", first), ("late", "0", "p", "login", limit + 1),
             ("other", "0", "p", "home", first)]
    visits = visitors.page_columns(parse.login_visits(pages(spark, items)))
    got = visitors.returning_users(visits).select("uid", F.unix_millis("row_time"), "back_ct", "uu_ct")
    assert sorted(map(tuple, got.collect())) == [("exact", first, 0, 1), ("exact", limit, 0, 1),
                                                 ("late", first, 0, 1), ("late", limit + 1, 1, 1)]


def test_window_edges(spark):
    at = [dt.datetime(2024, 1, 1, 0, 0, 9, 999000), dt.datetime(2024, 1, 1, 0, 0, 10), dt.datetime(2024, 1, 1, 0, 0, 19)]
    carts = spark.createDataFrame([("u", int(t.replace(tzinfo=dt.timezone.utc).timestamp()), "1") for t in at],
                                  "user_id string, ts bigint, id string")
    assert rows(tables.cart_users(carts)) == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", "20240101", 1),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", "20240101", 0)]
