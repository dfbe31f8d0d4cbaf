"""Window tables. Each has a batch form and a stream form.

Keyword and register windows need no state but their windows and run on streams as they are. The
others are ``foreachBatch`` functions (``*_batches``) over the tables that :mod:`tradepulse.streaming.stores`
keeps below ``path``; closed windows go to ``write``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse import functions as fx
from tradepulse.operators import changelog, joins, parse, visitors, windows
from tradepulse.operators.windows import LATENESS, SKU_AMOUNTS, WINDOW
from tradepulse.schemas import MONEY
from tradepulse.streaming import stores
from tradepulse.streaming.stores import Write

TRAFFIC_DIMS = ["vc", "ch", "ar", "is_new"]
TRAFFIC_SUMS = ["sv_ct", "pv_ct", "dur_sum"]


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


def _strings(*names: str) -> list[T.StructField]:
    return _fields(T.StringType(), *names)


def _counts(*names: str) -> list[T.StructField]:
    return _fields(T.LongType(), *names)


def _zero(*names: str) -> list[Column]:
    return [F.lit(0).cast("bigint").alias(n) for n in names]


def _one(name: str) -> Column:
    return F.lit(1).cast("bigint").alias(name)


def _stamped(closed: DataFrame) -> DataFrame:
    return windows.stamp(closed, "_w")


def traffic(pages: DataFrame, size: str = WINDOW) -> DataFrame:
    """Unique visitors, sessions, views and duration by version, channel, area, new flag."""
    views = visitors.visit_metrics(visitors.page_columns(parse.page_views(pages)))
    merged = visitors.unique_per_window(views, "mid", "uv_ct", TRAFFIC_DIMS, TRAFFIC_SUMS, size=size)
    return windows.traffic(merged, size)


def traffic_batches(spark: SparkSession, path: str, write: Write, size: str = WINDOW, compact_every: int = 100) -> Write:
    """The first row of a device's day brings its visitor into the window and dims it belongs to."""
    table = stores.OpenWindows(spark, f"{path}/windows", _strings(*TRAFFIC_DIMS), _counts("uv_ct", *TRAFFIC_SUMS), size, LATENESS["traffic"])
    seen = stores.SeenDays(spark, f"{path}/seen", _strings("mid"))

    def rows(pages: DataFrame) -> DataFrame:
        views = visitors.visit_metrics(visitors.page_columns(parse.page_views(pages)))
        return views.select("mid", *TRAFFIC_DIMS, *TRAFFIC_SUMS, "row_time")

    def partials(views: DataFrame, batch_id: int) -> DataFrame:
        start = table.start("row_time").alias("_start")
        fresh = seen.add(visitors.day_firsts(views, ["mid"], TRAFFIC_DIMS), batch_id)
        return (views.select(start, *TRAFFIC_DIMS, *_zero("uv_ct"), *TRAFFIC_SUMS)
                .unionByName(fresh.select(start, *TRAFFIC_DIMS, _one("uv_ct"), *_zero(*TRAFFIC_SUMS))))

    return stores.windowed(table, partials, _stamped, write, [seen], rows, compact_every=compact_every)


def home_detail(pages: DataFrame, size: str = WINDOW) -> DataFrame:
    """Daily unique visitors of the home page and of the article page."""
    views = visitors.page_columns(parse.home_and_detail(pages))
    return windows.home_detail(visitors.home_detail_uniques(views), size)


def home_detail_batches(spark: SparkSession, path: str, write: Write, size: str = WINDOW, compact_every: int = 100) -> Write:
    table = stores.OpenWindows(spark, f"{path}/windows", [], _counts("home_uv_ct", "good_detail_uv_ct"), size, LATENESS["window"])
    seen = stores.SeenDays(spark, f"{path}/seen", [*_strings("mid"), T.StructField("is_home", T.BooleanType())])

    def rows(pages: DataFrame) -> DataFrame:
        return visitors.page_columns(parse.home_and_detail(pages)).select("mid", (F.col("page_id") == "home").alias("is_home"), "row_time")

    def partials(views: DataFrame, batch_id: int) -> DataFrame:
        fresh = seen.add(visitors.day_firsts(views, ["mid", "is_home"]), batch_id)
        home = F.col("is_home").cast("bigint")
        return fresh.select(table.start("row_time").alias("_start"), home.alias("home_uv_ct"), (1 - home).alias("good_detail_uv_ct"))

    return stores.windowed(table, partials, _stamped, write, [seen], rows, compact_every=compact_every)


def keywords(pages: DataFrame, size: str = WINDOW) -> DataFrame:
    """Search words per window; works on batch and stream alike."""
    texts = parse.search_keywords(pages)
    words = texts.select("row_time", fx.keywords("keywords").alias("keyword"))
    return windows.keyword_counts(words, size)


def keywords_batches(spark: SparkSession, path: str, write: Write, size: str = WINDOW, compact_every: int = 100, all_pages: bool = False) -> Write:
    """With ``all_pages`` any page tells how late it is, as the stream form of :func:`keywords` has it, else searches only."""
    table = stores.OpenWindows(spark, f"{path}/windows", _strings("keyword"), _counts("keyword_count"), size, LATENESS["window"])

    def rows(pages: DataFrame) -> DataFrame:
        words = parse.search_keywords(pages).select("row_time", fx.keywords("keywords").alias("keyword"), F.lit(True).alias("searched"))
        if not all_pages:
            return words
        searched = F.coalesce(parse.is_search(), F.lit(False))
        found = pages.select("row_time", F.when(searched, fx.tokens(F.col("page")["item"])).alias("found"), searched.alias("searched"))
        return found.select("row_time", F.explode_outer("found").alias("keyword"), "searched")

    def partials(words: DataFrame, _batch_id: int) -> DataFrame:
        return words.where("searched").select(table.start("row_time").alias("_start"), "keyword", _one("keyword_count"))

    return stores.windowed(table, partials, _stamped, write, (), rows, compact_every=compact_every)


def logins(pages: DataFrame, size: str = WINDOW) -> DataFrame:
    """Daily unique users and users back after more than a week."""
    visits = visitors.page_columns(parse.login_visits(pages))
    return windows.logins(visitors.returning_users(visits), size)


def logins_batches(spark: SparkSession, path: str, write: Write, size: str = WINDOW, away_days: int = 7,
                   compact_every: int = 100) -> Write:
    """The day before a user's new one is the last of the batch's or of those known, whichever is later."""
    table = stores.OpenWindows(spark, f"{path}/windows", [], _counts("back_ct", "uu_ct"), size, LATENESS["window"])
    seen = stores.SeenDays(spark, f"{path}/seen", _strings("uid"), keep_last=True)

    def rows(pages: DataFrame) -> DataFrame:
        return visitors.page_columns(parse.login_visits(pages)).select("uid", "row_time")

    def partials(visits: DataFrame, batch_id: int) -> DataFrame:
        fresh = seen.add(visitors.day_firsts(visits, ["uid"]), batch_id)
        back = visitors.returned(fresh.join(seen.last_day(batch_id), "uid", "left"), "uid", away_days, "_last")
        return back.select(table.start("row_time").alias("_start"), "back_ct", "uu_ct")

    return stores.windowed(table, partials, _stamped, write, [seen], rows, compact_every=compact_every)


def registers(rows: DataFrame, size: str = WINDOW) -> DataFrame:
    return windows.registers(parse.registrations(rows), size)


def registers_stream(rows: DataFrame, size: str = WINDOW) -> DataFrame:
    timed = parse.registrations(rows).withWatermark("row_time", LATENESS["window"])
    return windows.registers(timed, size)


def cart_users(carts: DataFrame, size: str = WINDOW) -> DataFrame:
    """Daily unique users that put something into their cart; windows without any show 0."""
    rows = parse.cart_facts(carts)
    merged = visitors.unique_per_window(rows, "user_id", "cart_add_uu_ct", size=size)
    return windows.cart_users(merged, size)


def cart_users_batches(spark: SparkSession, path: str, write: Write, size: str = WINDOW, compact_every: int = 100) -> Write:
    table = stores.OpenWindows(spark, f"{path}/windows", [], _counts("cart_add_uu_ct"), size, LATENESS["cart"])
    seen = stores.SeenDays(spark, f"{path}/seen", _strings("user_id"))

    def rows(carts: DataFrame) -> DataFrame:
        return parse.cart_facts(carts).select("user_id", "row_time")

    def partials(carts: DataFrame, batch_id: int) -> DataFrame:
        start = table.start("row_time").alias("_start")
        fresh = seen.add(visitors.day_firsts(carts, ["user_id"]), batch_id)
        return carts.select(start, *_zero("cart_add_uu_ct")).unionByName(fresh.select(start, _one("cart_add_uu_ct")))

    return stores.windowed(table, partials, _stamped, write, [seen], rows, compact_every=compact_every)


def place(details: DataFrame) -> list[str]:
    """The place in the topic, where the source has one: it settles versions of one second."""
    return ["pos"] if "pos" in details.columns else []


def sku_amounts(details: DataFrame) -> DataFrame:
    """The four amounts of an order line; the original one is price times number."""
    price, number = fx.money("order_price"), fx.money("sku_num")
    return parse.sku_order_facts(details).select(
        "id", "sku_id", "row_time", *place(details),
        (price * number).cast("decimal(16,2)").alias("original_amount"),
        fx.money("split_activity_amount").alias("activity_reduce_amount"),
        fx.money("split_coupon_amount").alias("coupon_reduce_amount"),
        fx.money("split_total_amount").alias("order_amount"))


def by_time(time: str = "row_time", size: str = WINDOW) -> Column:
    """Slice of a key's versions: the window they fall into."""
    return F.window(time, size).start


def sku_order_deltas(details: DataFrame, size: str = WINDOW, keep: str | None = None) -> DataFrame:
    return changelog.version_deltas(sku_amounts(details), ["id"], ["row_time", *place(details), *SKU_AMOUNTS, "sku_id"],
                                    SKU_AMOUNTS, by_time(size=size), keep)


def sku_orders(details: DataFrame, articles: DataFrame, size: str = WINDOW) -> DataFrame:
    """Net amounts per article, with spu, categories and trademark looked up afterwards in the wide dimension."""
    return joins.dim_wide(windows.sku_orders(sku_order_deltas(details, size), size), articles)


def _versions(spark: SparkSession, path: str, amounts: Sequence[str], keep: str | None) -> stores.Versions:
    order = [T.StructField("row_time", T.TimestampType()), T.StructField("pos", T.LongType())]
    return stores.Versions(spark, f"{path}/versions", T.StructField("id", T.StringType()), order, _fields(MONEY, *amounts), keep)


def _placed(rows: DataFrame) -> DataFrame:
    return rows if "pos" in rows.columns else rows.withColumn("pos", F.lit(0).cast("bigint"))


def sku_deltas_batches(spark: SparkSession, path: str, write: Write, size: str = WINDOW, keep: str | None = "30 seconds") -> Write:
    """Order lines with their amounts less those of the version before, batch by batch."""
    versions = _versions(spark, path, SKU_AMOUNTS, keep)

    def each(batch: DataFrame, batch_id: int) -> None:
        write(versions.deltas(_placed(sku_amounts(batch)), batch_id, by_time(size=size), ["sku_id"]), batch_id)

    return each


def sku_orders_batches(spark: SparkSession, path: str, write: Write, articles: Callable[[], DataFrame], size: str = WINDOW,
                       keep: str | None = "30 seconds", compact_every: int = 100) -> Write:
    """Net amounts per article; the wide dimension is looked up when a window closes."""
    table = stores.OpenWindows(spark, f"{path}/windows", _strings("sku_id"), _fields(T.DecimalType(18, 2), *SKU_AMOUNTS), size, LATENESS["window"])
    versions = _versions(spark, path, SKU_AMOUNTS, keep)

    def partials(lines: DataFrame, batch_id: int) -> DataFrame:
        deltas = versions.deltas(lines, batch_id, by_time(size=size), ["sku_id"])
        return deltas.select(table.start("row_time").alias("_start"), "sku_id", *SKU_AMOUNTS)

    return stores.windowed(table, partials, lambda closed: joins.dim_wide(_stamped(closed), articles()), write, [versions],
                           lambda details: _placed(sku_amounts(details)), compact_every=compact_every)


def province_amounts(details: DataFrame) -> DataFrame:
    return parse.province_order_facts(details).select(
        "id", "order_id", "province_id", "row_time", *place(details),
        fx.money("split_total_amount").alias("order_amount"))


def province_order_deltas(details: DataFrame, size: str = WINDOW) -> DataFrame:
    return changelog.version_deltas(province_amounts(details), ["id"], ["row_time", *place(details), "order_amount", "order_id", "province_id"],
                                    ["order_amount"], by_time(size=size))


def province_orders(details: DataFrame, provinces: DataFrame, size: str = WINDOW) -> DataFrame:
    """Net amount and number of orders per province, with its name."""
    counted = windows.province_orders(province_order_deltas(details, size), size)
    return joins.lookup(counted, provinces, "province_id", "id", {"province_name": "name"})


def province_orders_batches(spark: SparkSession, path: str, write: Write, provinces: Callable[[], DataFrame], size: str = WINDOW,
                            keep: str | None = "30 seconds", compact_every: int = 100) -> Write:
    """Open windows hold a row an order, so that orders are counted exactly when they close."""
    table = stores.OpenWindows(spark, f"{path}/windows", _strings("province_id", "order_id"), _fields(T.DecimalType(18, 2), "order_amount"),
                               size, LATENESS["window"])
    versions = _versions(spark, path, ["order_amount"], keep)

    def partials(lines: DataFrame, batch_id: int) -> DataFrame:
        deltas = versions.deltas(lines, batch_id, by_time(size=size), ["order_id", "province_id"])
        return deltas.select(table.start("row_time").alias("_start"), "province_id", "order_id", "order_amount")

    def finish(closed: DataFrame) -> DataFrame:
        counted = closed.groupBy("_w", "province_id").agg(F.count("*").alias("order_count"), windows.total_money("order_amount"))
        return joins.lookup(_stamped(counted), provinces(), "province_id", "id", {"province_name": "name"})

    return stores.windowed(table, partials, finish, write, [versions], lambda details: _placed(province_amounts(details)),
                           compact_every=compact_every)
