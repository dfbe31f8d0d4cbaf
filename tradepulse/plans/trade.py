"""Trade and interaction facts from row changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tradepulse import schemas as S
from tradepulse.operators import changelog, joins

# Status codes of the shop.
CANCELLED, REFUNDING, REFUNDED = "1003", "1005", "1006"
PAID, REFUND_DONE = "1602", "0705"


def cart_add(changes: DataFrame) -> DataFrame:
    """Articles put into carts: new ones and raised quantities."""
    return changelog.increments(changes, "cart_info", "sku_num",
                                [c for c in S.CART_ADD if c != "ts"], keep=["ts"])


def comments(changes: DataFrame) -> DataFrame:
    return changelog.extract(changes, "comment_info", [
        "id", "user_id", "nick_name", "sku_id", "spu_id", "order_id", "appraise",
        "comment_txt", "create_time", "operate_time"])


def comment_info(changes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the name of their rating; ratings without a name are dropped."""
    named = joins.lookup(comments(changes), dictionary, "appraise", "rowkey",
                         {"appraise_name": "info.dic_name"}, "inner")
    return named.withColumnRenamed("appraise", "appraise_code").select(*S.COMMENT_INFO)


#: A version's time, and its place in the topic that settles the versions of one second.
VERSION = ("ts", "pos")


def order_lines(changes: DataFrame, keep: Sequence[str] = ("ts",)) -> DataFrame:
    return changelog.extract(changes, "order_detail", [
        "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time",
        "split_total_amount", "split_activity_amount", "split_coupon_amount"], keep=keep)


def new_orders(changes: DataFrame, keep: Sequence[str] = ("ts",)) -> DataFrame:
    return changelog.extract(changes, "order_info", ["id", "user_id", "province_id"], keep=keep)


def line_activities(changes: DataFrame, keep: Sequence[str] = ("ts",)) -> DataFrame:
    return changelog.extract(changes, "order_detail_activity", {
        "id": "order_detail_id", "activity_id": "activity_id",
        "activity_rule_id": "activity_rule_id"}, keep=keep)


def line_coupons(changes: DataFrame, keep: Sequence[str] = ("ts",)) -> DataFrame:
    return changelog.extract(changes, "order_detail_coupon", {
        "id": "order_detail_id", "coupon_id": "coupon_id"}, keep=keep)


def order_detail(changes: DataFrame) -> DataFrame:
    """Order lines with order, activity and coupon; one row per line."""
    return joins.order_lines(*order_sides(changes)).select(*S.ORDER_DETAIL)


#: The tables that an order line is put together from.
ORDER_TABLES = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")


def order_sides(changes: DataFrame) -> list[DataFrame]:
    """Versions of lines, orders, activities and coupons."""
    return [side(changes, VERSION) for side in (order_lines, new_orders, line_activities, line_coupons)]


def order_detail_stream(changes: DataFrame, seconds: int = 5) -> DataFrame:
    """The same from a stream, where the parts of a line arrive within ``seconds``.

    Spark emits a line once, when the watermark rules out a later activity or coupon; it
    writes no retractions. :class:`tradepulse.streaming.views.OrderDetails` writes lines early and
    corrects them.
    """
    timed = ["row_time"]
    lines = order_lines(changes, ["ts", "row_time"])
    orders = new_orders(changes, timed).withColumnRenamed("id", "order_id")
    lines = joins.within(lines, orders, ["order_id"], seconds)
    lines = joins.within(lines, line_activities(changes, timed), ["id"], seconds, "left")
    lines = joins.within(lines, line_coupons(changes, timed), ["id"], seconds, "left")
    return lines.select(*S.ORDER_DETAIL)


def cancelled_orders(changes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return changelog.transition(changes, "order_info", "order_status", CANCELLED,
                                {"order_id": "id", "user_id": "user_id",
                                 "province_id": "province_id"}, keep=keep, require_change=False)


def order_cancel(details: DataFrame, changes: DataFrame, seconds: int | None = None) -> DataFrame:
    """Lines of cancelled orders, with user and province of the cancellation.

    On streams ``seconds`` bounds the time from line to cancellation (a quarter of an hour
    and a little, say 905) and ``details`` needs ``row_time``.
    """
    lines = details.drop("user_id", "province_id")
    cancelled = cancelled_orders(changes, ["row_time"] if seconds else [])
    return joins.within(lines, cancelled, ["order_id"], seconds).select(*S.ORDER_DETAIL)


def payments(changes: DataFrame) -> DataFrame:
    return changelog.transition(
        changes, "payment_info", "payment_status", PAID,
        {"order_id": "order_id", "user_id": "user_id", "payment_type_code": "payment_type",
         "payment_time": "callback_time"}, keep=["ts", "pos", "row_time"])


def pay_success(details: DataFrame, changes: DataFrame, dictionary: DataFrame,
                before: int = 5, after: int = 15 * 60, keep: Sequence[str] = ()) -> DataFrame:
    """Paid order lines: paid from ``before`` seconds ahead of the line to ``after`` behind.

    ``details`` needs ``row_time``. The payments, fewer than the lines, are the side that is
    copied to time slots: a line belongs to a payment if it is at most ``after`` older and
    at most ``before`` younger. ``keep`` names more columns to carry: ``pay_pos`` and ``pos``, the places
    of payment and line in their topics.
    """
    lines = details.drop("user_id", "ts").withColumnRenamed("row_time", "line_time")
    pays = payments(changes).withColumnRenamed("row_time", "pay_time").withColumnRenamed("pos", "pay_pos")
    paid = joins.interval_join(lines, pays, ["order_id"], "line_time", "pay_time", after, before)
    named = joins.lookup(paid, dictionary, "payment_type_code", "rowkey",
                         {"payment_type_name": "info.dic_name"}, "left")
    return named.select(*S.PAYMENT_SUCCESS, *keep)


#: The order of paid lines: by payment, then by version of the line.
PAID_VERSION = ("ts", "pay_pos", "pos")


def pay_success_latest(details: DataFrame, changes: DataFrame, dictionary: DataFrame,
                       before: int = 5, after: int = 15 * 60) -> DataFrame:
    """What the upsert table keyed by line holds in the end: the last payment with the last version of the line."""
    paid = pay_success(details, changes, dictionary, before, after, PAID_VERSION[1:])
    return changelog.latest_by_key(paid, ["id"], PAID_VERSION).drop(*PAID_VERSION[1:])


def refund_requests(changes: DataFrame, keep: Sequence[str] = ("ts",)) -> DataFrame:
    return changelog.extract(changes, "order_refund_info", [
        "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
        "refund_reason_type", "refund_reason_txt", "create_time"], keep=keep)


def order_refund(changes: DataFrame, dictionary: DataFrame, seconds: int | None = None) -> DataFrame:
    """Refund requests of orders that went into refunding, with the refund type's name."""
    timed = ["row_time"] if seconds else []
    refunding = changelog.transition(changes, "order_info", "order_status", REFUNDING,
                                     {"order_id": "id", "province_id": "province_id"}, keep=timed)
    joined = joins.within(refund_requests(changes, ["ts", *timed]), refunding, ["order_id"], seconds)
    return joins.lookup(joined, dictionary, "refund_type", "rowkey",
                        {"rowkey": "rowkey", "dic_name": "info.dic_name"}, "inner"
                        ).select(*S.ORDER_REFUND)


#: The tables that a paid refund is put together from.
REFUND_TABLES = ("refund_payment", "order_refund_info", "order_info")


def refund_sides(changes: DataFrame, timed: Sequence[str] = ()) -> list[DataFrame]:
    """Refund payments, finished refunds and refunded orders."""
    paid = changelog.transition(changes, "refund_payment", "refund_status", PAID, [
        "id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"],
        keep=["ts", *timed])
    done = changelog.transition(changes, "order_refund_info", "refund_status", REFUND_DONE,
                                ["order_id", "sku_id", "refund_num"], keep=timed)
    orders = changelog.transition(changes, "order_info", "order_status", REFUNDED,
                                  {"order_id": "id", "user_id": "user_id",
                                   "province_id": "province_id"}, keep=timed)
    return [paid, done, orders]


def refund_parts(paid: DataFrame, done: DataFrame, orders: DataFrame, seconds: int | None = None) -> DataFrame:
    return joins.within(joins.within(paid, done, ["order_id", "sku_id"], seconds),
                        orders, ["order_id"], seconds)


def refunds_paid(changes: DataFrame, seconds: int | None = None) -> DataFrame:
    """Refund payments joined with their finished refund and refunded order."""
    return refund_parts(*refund_sides(changes, ["row_time"] if seconds else []), seconds)


def refund_pay_success(changes: DataFrame, dictionary: DataFrame,
                       seconds: int | None = None) -> DataFrame:
    return named_refunds(refunds_paid(changes, seconds), dictionary)


def named_refunds(refunds: DataFrame, dictionary: DataFrame) -> DataFrame:
    return joins.lookup(refunds, dictionary, "payment_type", "rowkey",
                        {"payment_type_name": "info.dic_name"}, "inner").select(*S.REFUND_PAY)
