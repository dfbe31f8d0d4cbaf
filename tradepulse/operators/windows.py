"""Tumbling event-time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepulse import functions as fx

# Window size and allowed lateness per feed.
WINDOW = "10 seconds"
LATENESS = {"log": "0 seconds", "cart": "1 second", "traffic": "3 seconds",
            "window": "5 seconds", "sql": "15 seconds"}


def tumble(rows: DataFrame, aggs: Sequence[Column], keys: Sequence[str] = (),
           time: str = "row_time", size: str = WINDOW) -> DataFrame:
    """Group by window and keys, then stamp ``stt``, ``edt`` and ``cur_date``.

    Without keys this is the global window. Partial aggregation leaves one row per window
    and map task, so the global window needs no single-task stage.
    """
    grouped = rows.groupBy(F.window(time, size).alias("_w"), *keys).agg(*aggs)
    return stamp(grouped, "_w")


def stamp(rows: DataFrame, window: str) -> DataFrame:
    start, end = F.col(f"{window}.start"), F.col(f"{window}.end")
    rest = [c for c in rows.columns if c != window]
    return rows.select(fx.datetime_text(start).alias("stt"), fx.datetime_text(end).alias("edt"),
                       fx.partition_text(start).alias("cur_date"), *rest)


def total(name: str) -> Column:
    return F.sum(name).cast("bigint").alias(name)


def total_money(name: str) -> Column:
    return F.sum(name).cast("decimal(18,2)").alias(name)


def traffic(rows: DataFrame, size: str = WINDOW) -> DataFrame:
    return tumble(rows, [total(m) for m in ("uv_ct", "sv_ct", "pv_ct", "dur_sum")],
                  ["vc", "ch", "ar", "is_new"], size=size)


def home_detail(rows: DataFrame, size: str = WINDOW) -> DataFrame:
    return tumble(rows, [total("home_uv_ct"), total("good_detail_uv_ct")], size=size)


def logins(rows: DataFrame, size: str = WINDOW) -> DataFrame:
    return tumble(rows, [total("back_ct"), total("uu_ct")], size=size)


def registers(rows: DataFrame, size: str = WINDOW) -> DataFrame:
    return tumble(rows, [total("register_ct")], size=size)


def cart_users(rows: DataFrame, size: str = WINDOW) -> DataFrame:
    return tumble(rows, [total("cart_add_uu_ct")], size=size)


SKU_AMOUNTS = ["original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount"]


def sku_orders(rows: DataFrame, size: str = WINDOW) -> DataFrame:
    return tumble(rows, [total_money(a) for a in SKU_AMOUNTS], ["sku_id"], size=size)


def province_orders(rows: DataFrame, size: str = WINDOW) -> DataFrame:
    """Order amount and exact number of distinct orders per province.

    Lines are first merged per order and only then counted per province. No set of order
    ids is ever held in one group, and both steps run on streams too.
    """
    per_order = (rows.groupBy(F.window("row_time", size).alias("_w"), "province_id", "order_id")
                 .agg(F.sum("order_amount").alias("order_amount")))
    timed = per_order.select(F.window_time("_w").alias("_at"), "province_id", "order_amount")
    return tumble(timed, [F.count("*").alias("order_count"), total_money("order_amount")],
                  ["province_id"], time="_at", size=size)


def keyword_counts(rows: DataFrame, size: str = WINDOW) -> DataFrame:
    return tumble(rows, [F.count("*").alias("keyword_count")], ["keyword"], size=size)
